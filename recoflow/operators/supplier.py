"""Normalisation of raw supplier payloads into records and dead letters.

A payload row has supplier_id, supplier_code, erp_type, raw_payload, page_token, next_page_token,
pulled_at and, for ordered writes, a sequence column. One bad item fails its whole payload.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from recoflow.functions.codes import canonical_status
from recoflow.functions.text import BLANK_CHARS, TRIMMED_CHARS, snippet, text_or_empty
from recoflow.operators.events import moment

TRANSFORM_ERROR = "TRANSFORM_ERROR"

SYSTEMS = ["KINGDEE", "YONYOU", "GENERIC"]

# Cell positions of a KINGDEE row and the fields read from object rows.
KINGDEE_CELLS = {"sourceRecordId": 0, "supplierName": 1, "sourceBusinessCode": 2, "supplierStatus": 3,
                 "sourceModifiedAt": 4}
OBJECT_FIELDS = ["id", "recordId", "code", "name", "status", "taxNo", "tax_no", "modifyDate", "modifiedAt",
                 "updatedAt"]

_ROOT = "struct<code:string,data:string,records:string,_corrupt_record:string>"
_OBJECT = "struct<" + ",".join(f"{name}:string" for name in OBJECT_FIELDS) + ">"
_SPACE = "concat(' ', char(9), char(10), char(13))"
_BLANKS = "'" + "".join(f"\\u{ord(c):04x}" for c in BLANK_CHARS) + "'"
_TRIMMED = "'" + "".join(f"\\u{ord(c):04x}" for c in TRIMMED_CHARS) + "'"


# The checks run inside arrays, so they are SQL texts that take the name of a lambda variable.

def _opens(text: str, bracket: str) -> str:
    return f"coalesce(substr(btrim({text}, {_SPACE}), 1, 1) = '{bracket}', false)"


def _blank(text: str) -> str:
    return f"coalesce(btrim({text}, {_BLANKS}) = '', true)"


def _first(*texts: str) -> str:
    """First of several texts that is not blank."""
    return f"get(filter(array({', '.join(texts)}), t -> NOT {_blank('t')}), 0)"


def _clean(text: str) -> str:
    return f"coalesce(btrim({text}, {_TRIMMED}), '')"


def _fields(pairs: dict[str, str]) -> str:
    return "array(" + ", ".join(f"struct('{name}' AS name, {value} AS value)" for name, value in pairs.items()) + ")"


def _scalar() -> str:
    """Whether a payload is valid JSON but neither an object nor an array."""
    return (f"(NOT {_opens('raw_payload', '{')} AND NOT {_opens('raw_payload', '[')} "
            "AND coalesce(json_array_length(concat('[', raw_payload, ']')) = 1, false))")


def _root_error() -> str:
    """What is wrong with a payload before its rows are looked at."""
    listed, keyed = _opens("raw_payload", "["), _opens("raw_payload", "{")
    scalar = _scalar()
    broken = f"(NOT {keyed} OR _root._corrupt_record IS NOT NULL)"
    code = "coalesce(try_cast(try_cast(_root.code AS double) AS int), -1)"
    return f"""
        CASE _system
        WHEN 'KINGDEE' THEN CASE
          WHEN {keyed} OR {scalar} THEN 'Expected JSON array as root'
          WHEN NOT {listed} OR _rows IS NULL THEN 'Failed to parse raw payload JSON' END
        WHEN 'YONYOU' THEN CASE
          WHEN {listed} OR {scalar} THEN 'YONYOU root must be JSON object'
          WHEN {broken} THEN 'Failed to parse YONYOU raw payload JSON'
          WHEN {code} <> 0 THEN concat('YONYOU response code is not success: ', {code})
          WHEN NOT {_opens("_root.data", "{")} THEN 'YONYOU data node is missing or invalid'
          WHEN NOT {_opens("_data.rows", "[")} THEN 'YONYOU rows node is missing or invalid' END
        WHEN 'GENERIC' THEN CASE
          WHEN {listed} OR {scalar} THEN 'GENERIC root must be JSON object'
          WHEN {broken} THEN 'Failed to parse GENERIC raw payload JSON'
          WHEN NOT {_opens("_root.records", "[")} THEN 'GENERIC records node is missing or invalid' END
        ELSE concat('No parser found for ERP type: ', coalesce(erp_type, 'null')) END"""


def _read_rows() -> str:
    """Per row: its text, whether it has the right shape, required values by name, optional values."""
    kingdee = {name: f"get(r.cells, {place})" for name, place in KINGDEE_CELLS.items()}
    yonyou = {name: f"r.v.{name}" for name in ("code", "name", "status")}
    generic = {
        "id/recordId/code": _first("r.v.id", "r.v.recordId", "r.v.code"), "name": _first("r.v.name"),
        "status": _first("r.v.status"), "code/id/recordId": _first("r.v.code", "r.v.id", "r.v.recordId"),
    }
    return f"""
        transform(_texts, r -> struct(
          r.raw AS raw,
          r.raw IS NOT NULL AND IF(_system = 'KINGDEE', {_opens("r.raw", "[")}, {_opens("r.raw", "{")}) AS shaped,
          CASE _system WHEN 'KINGDEE' THEN {_fields(kingdee)} WHEN 'YONYOU' THEN {_fields(yonyou)}
            ELSE {_fields(generic)} END AS required,
          CASE _system WHEN 'KINGDEE' THEN '' WHEN 'YONYOU' THEN {_clean("r.v.taxNo")}
            ELSE {_clean(_first("r.v.taxNo", "r.v.tax_no"))} END AS tax_no,
          CASE _system WHEN 'KINGDEE' THEN '' WHEN 'YONYOU' THEN {_clean("r.v.modifyDate")}
            ELSE {_clean(_first("r.v.modifyDate", "r.v.modifiedAt", "r.v.updatedAt"))} END AS modified))"""


def _row_errors() -> str:
    """Complaint per row, null for a good one: wrong shape, else the first required value not filled."""
    return f"""
        transform(_read, (row, i) -> CASE
          WHEN NOT row.shaped AND _system = 'KINGDEE' THEN concat('Invalid row: ', coalesce(row.raw, 'null'))
          WHEN NOT row.shaped THEN concat(_system, ' row must be object, rowIndex=', i)
          ELSE get(transform(filter(row.required, f -> {_blank("f.value")}), f -> concat(
            _system, CASE WHEN _system = 'GENERIC' THEN ' field is missing or blank: '
              WHEN f.value IS NULL THEN ' field is missing: ' ELSE ' field is blank: ' END,
            f.name, ', rowIndex=', i)), 0) END)"""


def _items() -> str:
    """Parsed values of the rows. Positions refer to the order of the required values."""

    def value(kingdee: int, yonyou: int, generic: int) -> str:
        at = f"CASE _system WHEN 'KINGDEE' THEN {kingdee} WHEN 'YONYOU' THEN {yonyou} ELSE {generic} END"
        return f"get(row.required, {at}).value"

    return f"""
        transform(_read, row -> struct(
          {value(0, 0, 0)} AS source_record_id, {value(2, 0, 3)} AS source_business_code,
          {value(1, 1, 1)} AS supplier_name, {value(3, 2, 2)} AS source_supplier_status, row.tax_no AS tax_no,
          IF(_system = 'KINGDEE', {_clean("get(row.required, 4).value")}, row.modified) AS source_modified_at,
          row.raw AS raw_item_json))"""


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Add ``error`` (null when the payload is good) and ``items`` (parsed items, null when it is bad).

    KINGDEE: array of arrays, values by position. YONYOU: object with code 0 and data.rows. GENERIC:
    object with records, each value from the first candidate name that is filled. The type is matched
    in any case and all types are handled in one pass, reading every text once.
    """
    record_error = f"""
        CASE WHEN coalesce(size(_rows), 0) <= 0 THEN NULL
          WHEN supplier_id IS NULL OR supplier_id <= 0 THEN 'supplierId must be positive'
          WHEN {_blank("supplier_code")} THEN 'supplierCode must not be blank'
          WHEN pulled_at IS NULL THEN 'pulledAt must not be null' END"""
    text = "CASE _system WHEN 'KINGDEE' THEN raw_payload WHEN 'YONYOU' THEN _data.rows ELSE _root.records END"
    return (
        payloads
        .selectExpr("*", "upper(erp_type) AS _system",
                    f"IF(upper(erp_type) IN ('YONYOU', 'GENERIC'), from_json(raw_payload, '{_ROOT}'), NULL) AS _root")
        .selectExpr("*", "IF(_system = 'YONYOU', from_json(_root.data, 'struct<rows:string>'), NULL) AS _data")
        .selectExpr("*", f"from_json({text}, 'array<string>') AS _rows")
        .selectExpr("*", f"""transform(_rows, raw -> struct(raw AS raw,
            IF(_system = 'KINGDEE', from_json(raw, 'array<string>'), NULL) AS cells,
            IF(_system = 'KINGDEE', NULL, from_json(raw, '{_OBJECT}')) AS v)) AS _texts""")
        .selectExpr("*", f"{_read_rows()} AS _read")
        .selectExpr("*", f"""coalesce({_root_error()}, get(filter({_row_errors()}, e -> e IS NOT NULL), 0),
            {record_error}) AS error""")
        .selectExpr("*", f"IF(error IS NULL, {_items()}, NULL) AS items")
        .drop("_system", "_root", "_data", "_rows", "_texts", "_read")
    )


def records(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalised records of the good payloads; ``keep`` names extra payload columns to carry along.

    ``item_index`` is the position inside the payload. Bad payloads have no items; they are dropped
    after the explode, because a filter on ``error`` would be pushed down and parse every text again.
    """
    exploded = parsed.select(
        *keep, "supplier_id", "supplier_code", "erp_type", text_or_empty(F.col("page_token")).alias("page_token"),
        text_or_empty(F.col("next_page_token")).alias("next_page_token"), "pulled_at",
        F.posexplode_outer("items").alias("item_index", "item"),
    ).filter(F.col("item_index").isNotNull())
    status = canonical_status(F.col("erp_type"), F.col("item.source_supplier_status"))
    return exploded.select(
        *keep, "item_index", "supplier_id", "supplier_code", "erp_type", "item.source_record_id",
        "item.source_business_code", "item.supplier_name", "item.source_supplier_status",
        status.alias("supplier_status"), "item.tax_no", text_or_empty(F.col("item.source_modified_at"))
        .alias("source_modified_at"), "page_token", "next_page_token", "pulled_at", "item.raw_item_json",
    )


def dead_letters(parsed: DataFrame, failed_at: datetime | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Dead letters of the bad payloads with text cut to 512 characters.

    The error goes through an explode for the same reason as in ``records``.
    """
    at = failed_at if isinstance(failed_at, Column) else moment(failed_at)
    errors = F.explode_outer(F.array(snippet(F.col("error")))).alias("error_message")
    return parsed.select(
        *keep, "supplier_id", "supplier_code", "erp_type", snippet(F.col("raw_payload")).alias("raw_snippet"),
        F.lit(TRANSFORM_ERROR).alias("error_type"), errors, at.alias("failed_at"),
    ).filter(F.col("error_message").isNotNull())


def payload_results(parsed: DataFrame, outcomes: DataFrame, sequence: str) -> DataFrame:
    """Per payload: success, parsed, upserted and stale counts, error text."""
    counts = outcomes.groupBy(sequence).agg(
        F.count_if(F.col("outcome") == "UPSERTED").alias("upserted_count"),
        F.count_if(F.col("outcome") == "STALE_SKIPPED").alias("stale_skipped_count"),
    )
    good = F.col("error").isNull()
    zero = F.lit(0).cast("bigint")
    return parsed.join(counts, sequence, "left").select(
        sequence, "supplier_id", good.alias("success"),
        F.when(good, F.size("items")).otherwise(0).cast("bigint").alias("parsed_count"),
        F.coalesce("upserted_count", zero).alias("upserted_count"),
        F.coalesce("stale_skipped_count", zero).alias("stale_skipped_count"),
        F.col("error").alias("error_message"),
    )
