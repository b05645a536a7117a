"""Rule-driven ingestion: a validated request becomes a lazy DataFrame."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recoflow.functions import transforms
from recoflow.functions.codes import FILTER_OPERATOR_ALIASES, WRITE_MODE_ALIASES, canonical_alias
from recoflow.operators.merge import dedup_last

# Limits and words of a request.
MAX_ROWS_LIMIT = 50_000
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$.]*")
TARGET_NAME = re.compile(r"[A-Za-z0-9_.-]+")
FORBIDDEN_WORDS = ["INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "TRUNCATE", "CREATE", "GRANT", "REVOKE"]
OPERATORS = list(FILTER_OPERATOR_ALIASES)
WRITE_MODES = list(WRITE_MODE_ALIASES)
SAMPLE_ROWS = 20


def _clean(text: str | None) -> str | None:
    return (text or "").strip() or None


def _identifier(text: str | None, name: str) -> str:
    if text is None:
        raise ValueError(f"{name} must not be blank")
    if not IDENTIFIER.fullmatch(text):
        raise ValueError(f"{name} contains illegal identifier: {text}")
    return text


def validate_select_only(sql: str) -> None:
    """Accept SELECT statements without writing words.

    The words are looked for anywhere in the text, so a column called ``updated_at`` is refused too.
    """
    upper = sql.lstrip().upper()
    if not upper.startswith("SELECT"):
        raise ValueError("Only SELECT statements are allowed")
    for word in FORBIDDEN_WORDS:
        if word in upper:
            raise ValueError(f"SQL contains forbidden keyword: {word}")


@dataclass(frozen=True)
class FieldMapping:
    """Source column and its name in the result (by default the part after the last dot)."""

    source: str | None
    target: str | None = None
    enabled: bool = True

    def __post_init__(self):
        source = _clean(self.source)
        default = None if source is None else source.rsplit(".", 1)[-1]
        object.__setattr__(self, "source", source)
        object.__setattr__(self, "target", _clean(self.target) or default)

    def validate(self) -> None:
        _identifier(self.source, "fieldMappings.sourceField")
        _identifier(self.target, "fieldMappings.targetField")


@dataclass(frozen=True)
class FilterRule:
    """One condition; ``logic`` links it to the conditions before."""

    field: str | None
    operator: str | None = "EQ"
    value: str | None = None
    logic: str | None = "AND"
    enabled: bool = True

    def __post_init__(self):
        object.__setattr__(self, "field", _clean(self.field))
        object.__setattr__(self, "operator", canonical_alias(_clean(self.operator) or "EQ", FILTER_OPERATOR_ALIASES))
        object.__setattr__(self, "value", _clean(self.value))
        object.__setattr__(self, "logic", (_clean(self.logic) or "AND").upper())

    def validate(self) -> None:
        _identifier(self.field, "filters.field")
        if self.logic not in ("AND", "OR"):
            raise ValueError("filters.logic must be AND or OR")
        if self.operator not in OPERATORS:
            raise ValueError(f"Unsupported filter operator: {self.operator}")
        if self.operator not in ("IS_NULL", "NOT_NULL") and self.value is None:
            raise ValueError(f"filters.value is required for operator {self.operator}")


@dataclass(frozen=True)
class TransformRule:
    """One transform; the result replaces the column or goes to ``target``."""

    field: str | None
    type: str | None = "TRIM"
    argument: str | None = None
    target: str | None = None
    enabled: bool = True

    def __post_init__(self):
        name = _clean(self.field)
        object.__setattr__(self, "field", name)
        object.__setattr__(self, "target", _clean(self.target) or name)
        object.__setattr__(self, "type", (_clean(self.type) or "TRIM").upper())
        object.__setattr__(self, "argument", _clean(self.argument))

    def validate(self) -> None:
        _identifier(self.field, "transformRules.field")
        _identifier(self.target, "transformRules.targetField")
        transforms.validate(self.type, self.argument)


@dataclass(frozen=True)
class Target:
    """Where the result goes. ``incremental_field`` only serves as a fallback sort field."""

    name: str | None = None
    write_mode: str | None = "APPEND"
    primary_key: str | None = None
    incremental_field: str | None = None

    def __post_init__(self):
        for attribute in ("name", "primary_key", "incremental_field"):
            object.__setattr__(self, attribute, _clean(getattr(self, attribute)))
        mode = canonical_alias(_clean(self.write_mode) or "APPEND", WRITE_MODE_ALIASES)
        object.__setattr__(self, "write_mode", mode)

    def validate(self) -> None:
        if self.name is not None and not TARGET_NAME.fullmatch(self.name):
            raise ValueError(f"target.targetName contains illegal characters: {self.name}")
        if self.write_mode not in WRITE_MODES:
            raise ValueError(f"target.writeMode must be one of {WRITE_MODES}")
        for attribute in ("primary_key", "incremental_field"):
            if getattr(self, attribute) is not None:
                _identifier(getattr(self, attribute), f"target.{attribute}")


@dataclass(frozen=True)
class IngestionRequest:
    """A table scan built from rules, or a custom SELECT. ``max_rows=None`` reads everything."""

    source_table: str | None = None
    query: str | None = None
    mappings: Sequence[FieldMapping] = ()
    filters: Sequence[FilterRule] = ()
    transforms: Sequence[TransformRule] = ()
    target: Target = field(default_factory=Target)
    sort_field: str | None = None
    sort_direction: str | None = "DESC"
    max_rows: int | None = None

    def __post_init__(self):
        for attribute in ("source_table", "query", "sort_field"):
            object.__setattr__(self, attribute, _clean(getattr(self, attribute)))
        object.__setattr__(self, "sort_direction", (_clean(self.sort_direction) or "DESC").upper())

    @property
    def is_custom(self) -> bool:
        return self.query is not None

    @property
    def resolved_sort_field(self) -> str | None:
        return self.sort_field or self.target.incremental_field

    def enabled(self) -> IngestionRequest:
        """The request without its disabled rules."""
        return replace(self, **{name: [rule for rule in getattr(self, name) if rule.enabled]
                                for name in ("mappings", "filters", "transforms")})

    def validate(self) -> None:
        if self.max_rows is not None and not 1 <= self.max_rows <= MAX_ROWS_LIMIT:
            raise ValueError(f"maxRows must be between 1 and {MAX_ROWS_LIMIT}")
        active = self.enabled()
        if self.is_custom:
            validate_select_only(self.query)
        else:
            _identifier(self.source_table, "sourceTable")
            if not active.mappings:
                raise ValueError("At least one enabled field mapping is required")
            if self.sort_field is not None:
                _identifier(self.sort_field, "sortField")
            if self.sort_direction not in ("ASC", "DESC"):
                raise ValueError("sortDirection must be ASC or DESC")
        for rule in [*active.mappings, *active.filters, *active.transforms]:
            rule.validate()
        targets = [m.target for m in active.mappings]
        if not self.is_custom and len(set(targets)) != len(targets):
            raise ValueError("fieldMappings.targetField must be unique")
        self.target.validate()


def _literal(value: str, dtype: T.DataType) -> Column:
    """Filter value, which arrives as text, in the type of its column."""
    if isinstance(dtype, T.NumericType):
        try:
            number = Decimal(value)
        except InvalidOperation as error:
            raise ValueError(f"filter value must be numeric: {value}") from error
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return F.lit(float(number))
        return F.lit(int(number)) if number == number.to_integral_value() else F.lit(number)
    return F.lit(value) if isinstance(dtype, T.StringType) else F.lit(value).cast(dtype)


def _predicate(rule: FilterRule, schema: T.StructType) -> Column:
    name = rule.field.rsplit(".", 1)[-1]
    column, dtype = F.col(name), schema[name].dataType
    if rule.operator == "IS_NULL":
        return column.isNull()
    if rule.operator == "NOT_NULL":
        return column.isNotNull()
    if rule.operator == "LIKE":
        return F.ilike(column.cast("string"), F.lit(rule.value))
    if rule.operator == "IN":
        return column.isin(*[_literal(part.strip(), dtype) for part in rule.value.split(",")])
    other = _literal(rule.value, dtype)
    return {"EQ": column == other, "NE": column != other, "GT": column > other, "GTE": column >= other,
            "LT": column < other, "LTE": column <= other}[rule.operator]


def filter_condition(rules: Sequence[FilterRule], schema: T.StructType) -> Column | None:
    """AND / OR chain without parentheses: AND binds tighter, the first rule's link does not matter."""
    groups: list[Column] = []
    for position, rule in enumerate(rules):
        predicate = _predicate(rule, schema)
        if position == 0 or rule.logic == "OR":
            groups.append(predicate)
        else:
            groups[-1] = groups[-1] & predicate
    result = None
    for group in groups:
        result = group if result is None else result | group
    return result


def rule_filter(df: DataFrame, rules: Sequence[FilterRule]) -> DataFrame:
    condition = filter_condition([rule for rule in rules if rule.enabled], df.schema)
    return df if condition is None else df.filter(condition)


def field_mapping(df: DataFrame, mappings: Sequence[FieldMapping], lenient: bool = False,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Project and rename. With ``lenient`` a missing source column reads as null."""

    def source(mapping: FieldMapping) -> Column:
        name = mapping.source.rsplit(".", 1)[-1]
        if lenient and name not in df.columns:
            return F.lit(None).cast("string")
        return F.col(name)

    return df.select(*[source(m).alias(m.target) for m in mappings if m.enabled], *keep)


def transform_chain(df: DataFrame, rules: Sequence[TransformRule], mappings: Sequence[FieldMapping] = ()) -> DataFrame:
    """Apply transforms in order.

    A rule's field is a current column, else the target of its mapping; a missing one reads as null.
    """
    targets = {m.source: m.target for m in mappings if m.enabled}
    for rule in rules:
        if not rule.enabled:
            continue
        name = rule.field if rule.field in df.columns else targets.get(rule.field, rule.field)
        value = F.col(name) if name in df.columns else F.lit(None).cast("string")
        kind = df.schema[name].dataType if name in df.columns else None
        df = df.withColumn(rule.target, transforms.find(rule.type).apply(value, rule.argument, kind))
    return df


def _sorted(df: DataFrame, request: IngestionRequest, tie_breaker: Sequence[str]) -> DataFrame:
    name = request.resolved_sort_field
    if name is None:
        return df
    name = name.rsplit(".", 1)[-1]
    order = F.desc(name) if request.sort_direction == "DESC" else F.asc(name)
    return df.orderBy(order, *tie_breaker)


def ingest(
    spark: SparkSession, request: IngestionRequest, source: DataFrame | None = None, sequence: Sequence[str] = ()
) -> DataFrame:
    """Run a request: source, filters, sort, row cap, mapping, transforms, de-duplication.

    ``source`` replaces the catalog table. ``sequence`` names source columns that identify a row;
    they break ties of the sort, and for UPSERT they tell which of several rows with the same key
    comes last. A custom query takes neither filters nor sort of the request.
    """
    request.validate()
    active = request.enabled()
    dedup = active.target.write_mode == "UPSERT" and active.target.primary_key is not None
    if active.is_custom:
        df = spark.sql(active.query)
    else:
        df = rule_filter(spark.table(active.source_table) if source is None else source, active.filters)
    order = "_sequence"
    if dedup:
        if not sequence:
            raise ValueError("UPSERT needs the columns that order the input")
        df = df.withColumn(order, _arrival(df, active, sequence))
    if not active.is_custom:
        df = _sorted(df, active, sequence)
    if active.max_rows is not None:
        df = df.limit(active.max_rows)
    keep = [order] if dedup else []
    if active.mappings:
        df = field_mapping(df, active.mappings, lenient=active.is_custom, keep=keep)
    df = transform_chain(df, active.transforms, active.mappings)
    return dedup_last(df, active.target.primary_key, F.col(order)).drop(order) if dedup else df


def _arrival(df: DataFrame, request: IngestionRequest, sequence: Sequence[str]) -> Column:
    """Order value that grows with the position of a row in the (sorted) input."""
    name = None if request.is_custom else request.resolved_sort_field
    if name is None:
        return F.struct(*sequence)
    column = F.col(name.rsplit(".", 1)[-1])
    if request.sort_direction == "ASC":
        return F.struct(column, *sequence)
    dtype = df.schema[name.rsplit(".", 1)[-1]].dataType
    if isinstance(dtype, T.NumericType):
        return F.struct((-column).alias("rank"), *sequence)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        zero = F.lit("1970-01-01").cast(dtype)
        return F.struct((-F.timestamp_diff("MICROSECOND", zero, column)).alias("rank"), *sequence)
    if isinstance(dtype, T.DateType):
        return F.struct((-F.unix_date(column)).alias("rank"), *sequence)
    raise ValueError("a descending UPSERT needs a numeric or time sort field")


def ingestion_summary(df: DataFrame, sample_order: Sequence[str], metadata: dict[str, str] | None = None,
                      sample_size: int = SAMPLE_ROWS) -> DataFrame:
    """One row: total records, column names, first rows as JSON texts, metadata.

    The count is an aggregate and the sample a top-k, so neither moves the data to one place.
    """
    total = df.agg(F.count(F.lit(1)).alias("total_records"))
    sample = df.orderBy(*sample_order).limit(sample_size).select(
        F.struct(*sample_order).alias("o"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"))
    rows = sample.agg(F.sort_array(F.collect_list(F.struct("o", "row")))["row"].alias("rows"))
    pairs = [F.lit(text) for pair in (metadata or {}).items() for text in pair]
    return total.select(
        "total_records", F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        rows.scalar().alias("sample_rows"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("metadata"),
    )
