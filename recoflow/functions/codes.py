"""Code tables and the small scalar rules of the supplier and order jobs."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from recoflow.functions.text import is_blank, labelled, trimmed

# Aliases accepted for write modes and filter operators.
WRITE_MODE_ALIASES = {
    "APPEND": ["APPEND", "INSERT", "INSERT_ONLY", "CREATE", "CREATE_ONLY", "LOAD", "LOAD_APPEND", "APPEND_ONLY"],
    "UPSERT": ["UPSERT", "MERGE", "UPDATE_OR_INSERT", "UPDATE_INSERT", "INSERT_OR_UPDATE"],
    "REPLACE": ["REPLACE", "OVERWRITE", "TRUNCATE_INSERT", "TRUNCATE_AND_LOAD", "REBUILD"],
}
FILTER_OPERATOR_ALIASES = {
    "EQ": ["EQ", "EQUAL", "EQUALS", "="],
    "NE": ["NE", "NOT_EQUAL", "NOT_EQUALS", "!=", "<>"],
    "GT": ["GT", "GREATER_THAN", "AFTER", ">"],
    "GTE": ["GTE", "GE", "GREATER_THAN_OR_EQUAL", ">="],
    "LT": ["LT", "LESS_THAN", "BEFORE", "<"],
    "LTE": ["LTE", "LE", "LESS_THAN_OR_EQUAL", "<="],
    "LIKE": ["LIKE", "CONTAINS", "MATCHES"],
    "IN": ["IN", "IN_LIST"],
    "IS_NULL": ["IS_NULL", "NULL", "ISNULL"],
    "NOT_NULL": ["NOT_NULL", "IS_NOT_NULL", "NOTNULL", "ISNOTNULL"],
}

# Supplier status codes per source system.
SUPPLIER_STATUS_CODES = {
    "KINGDEE": {
        "ACTIVE": ["A", "ENABLE", "ENABLED", "ACTIVE"],
        "INACTIVE": ["B", "DISABLE", "DISABLED", "INACTIVE"],
    },
    "YONYOU": {
        "ACTIVE": ["Y", "YES", "ENABLE", "ENABLED", "ACTIVE", "1"],
        "INACTIVE": ["N", "NO", "DISABLE", "DISABLED", "INACTIVE", "0"],
    },
    "GENERIC": {
        "ACTIVE": ["ACTIVE", "ENABLE", "ENABLED", "VALID"],
        "INACTIVE": ["INACTIVE", "DISABLE", "DISABLED", "INVALID"],
    },
}
ERP_CODE_PREFIXES = {"KD_": "KINGDEE", "YY_": "YONYOU"}
DEFAULT_ERP_TYPE = "GENERIC"

# Exchange rates into CNY and the order states.
RATES_TO_CNY = {"CNY": Decimal("1"), "USD": Decimal("7.20"), "EUR": Decimal("7.85"), "JPY": Decimal("0.048")}
ORDER_STATUSES = ["CREATED", "PAID", "SHIPPED", "COMPLETED", "CANCELLED"]

# Labels of the profile text.
GENDER_LABELS = {"MALE": "男", "FEMALE": "女"}
UNKNOWN_LABEL = "未知"
BEHAVIOR_LABELS = {"VIEW": "浏览", "CLICK": "点击", "ADD_TO_CART": "加购", "PURCHASE": "购买", "RATE": "评分"}


def canonical_alias(text: str | None, aliases: dict[str, list[str]]) -> str | None:
    """Resolve an alias in any case; unknown words come back upper-cased, blank ones unchanged."""
    if text is None or not text.strip():
        return text
    word = text.strip().upper()
    return next((name for name, words in aliases.items() if word in words), word)


def canonical_status(erp_type: Column, source_status: Column) -> Column:
    """ACTIVE / INACTIVE / UNKNOWN from a source system's own code."""
    system, code = F.upper(trimmed(erp_type)), F.upper(trimmed(source_status))
    result = F.when(F.lit(False), F.lit(""))
    for name, table in SUPPLIER_STATUS_CODES.items():
        for status, codes in table.items():
            result = result.when((system == name) & code.isin(codes), F.lit(status))
    return result.otherwise(F.lit("UNKNOWN"))


def erp_type_of(supplier_code: Column) -> Column:
    result = F.when(F.lit(False), F.lit(""))
    for prefix, name in ERP_CODE_PREFIXES.items():
        result = result.when(supplier_code.startswith(prefix), F.lit(name))
    return result.otherwise(F.lit(DEFAULT_ERP_TYPE))


def rate_to_cny(currency: Column) -> Column:
    """Exchange rate, null for currencies without one."""
    rates = {code: rate.quantize(Decimal("0.001")) for code, rate in RATES_TO_CNY.items()}
    return labelled(currency, rates).cast("decimal(8,3)")


def amount_in_cny(amount: Column, currency: Column) -> Column:
    """Amount × rate at scale 2, half up."""
    return F.round(amount.cast("decimal(18,2)") * rate_to_cny(currency), 2).cast("decimal(18,2)")


def backoff_seconds(retry_count: Column, base: int, cap: int) -> Column:
    """Exponential delay: base · 2^n with n limited to 0 … 30, never above the cap."""
    exponent = F.least(F.greatest(retry_count.cast("int"), F.lit(0)), F.lit(30))
    power = F.pow(F.lit(2.0), exponent).cast("bigint")
    return F.least(F.lit(base).cast("bigint") * power, F.lit(cap).cast("bigint"))


def cursor_date(cursor: Column) -> Column:
    """Date part of ``date|offset``: text before the last bar, all of it without a bar."""
    return (
        F.when(is_blank(cursor), F.lit(None).cast("string"))
        .when(F.contains(cursor, F.lit("|")), F.regexp_extract(cursor, r"(?s)^(.*)\|[^|]*$", 1))
        .otherwise(cursor)
    )


def cursor_offset(cursor: Column, first: int) -> Column:
    """Offset after the last bar; ``first`` when absent or not a number.

    ``first`` is 0 for row offsets and 1 for page numbers, which are never below 1.
    """
    tail = F.when(~is_blank(cursor) & F.contains(cursor, F.lit("|")), F.substring_index(cursor, "|", -1))
    number = F.when(tail.rlike(r"^[+-]?[0-9]+$"), tail.try_cast("int"))
    offset = F.coalesce(number, F.lit(first))
    return F.greatest(offset, F.lit(1)) if first == 1 else offset


def encode_cursor(date: Column, offset: Column) -> Column:
    return F.concat(F.coalesce(date, F.lit("")), F.lit("|"), offset.cast("string"))
