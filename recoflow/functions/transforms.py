"""Closed registry of column transforms used by rule-driven ingestion."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recoflow.functions.text import trimmed

NUMBER = "decimal(26,8)"
DIVIDE_SCALE = 8


def _argument_number(argument: str | None, code: str) -> Decimal:
    if argument is None or not argument.strip():
        raise ValueError(f"transformRules.argument is required for type {code}")
    try:
        return Decimal(argument.strip())
    except InvalidOperation as error:
        raise ValueError(f"transformRules.argument must be numeric for type {code}: {argument}") from error


def _plain(number: Decimal) -> Decimal:
    """Same value without an exponent, so that it makes a plain decimal literal."""
    return Decimal(format(number, "f"))


def _text_argument(argument: str | None, code: str) -> str:
    if argument is None or not argument.strip():
        raise ValueError(f"transformRules.argument is required for type {code}")
    return argument


def _divisor(argument: str | None, code: str) -> Decimal:
    number = _argument_number(argument, code)
    if number == 0:
        raise ValueError("transformRules.argument cannot be zero for DIVIDE")
    return number


def _round_scale(argument: str | None, code: str) -> int:
    if argument is None or not argument.strip():
        return 0
    try:
        return int(argument.strip())
    except ValueError as error:
        raise ValueError(f"ROUND transform argument must be an integer scale: {argument}") from error


def to_number(value: Column) -> Column:
    """Exact decimal of a number or numeric text; other text stops the query with an error."""
    text = trimmed(value.cast("string"))
    number = text.try_cast(NUMBER)
    complaint = F.raise_error(F.concat(F.lit("Numeric transform requires a numeric field value but got: "), text))
    return F.when(value.isNull(), F.lit(None).cast(NUMBER)).otherwise(F.coalesce(number, complaint.cast(NUMBER)))


def canonical_number(value: Column) -> Column:
    """Number as text without trailing zeros: 249900, 24.5."""
    text = value.cast("string")
    stripped = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(F.contains(text, F.lit(".")), stripped).otherwise(text)


def _divide(value: Column, divisor: Decimal) -> Column:
    """Quotient at scale 8, half up.

    Spark's quotient is itself rounded, so a value just under a tie may end up above it; the
    remainder shows that and takes the last digit back.
    """
    number, by = to_number(value), F.lit(_plain(divisor))
    quotient = F.round(number / by, DIVIDE_SCALE).cast(NUMBER)
    unit = Decimal(1).scaleb(-DIVIDE_SCALE)
    overshoot = F.abs(number - quotient * by) > F.lit(_plain(abs(divisor) * unit / 2))
    step = F.when(quotient > 0, F.lit(unit)).otherwise(F.lit(-unit))
    return F.when(overshoot, (quotient - step).cast(NUMBER)).otherwise(quotient)


def _round(value: Column, scale: int) -> Column:
    return F.round(to_number(value), scale).cast(NUMBER)


def _replace_null(value: Column, argument: str, kind: T.DataType | None) -> Column:
    """A number column stays one where the argument is such a number; any other column becomes text."""
    try:
        number = Decimal(argument.strip()) if isinstance(kind, T.NumericType) else None
    except InvalidOperation:
        number = None
    fits = number is not None and (not isinstance(kind, T.IntegralType) or number == number.to_integral_value())
    if not fits:
        return F.coalesce(_as_text(value), F.lit(argument))
    return F.coalesce(value, F.lit(_plain(number)).try_cast(kind))


def _as_text(value: Column) -> Column:
    return value.cast("string")


@dataclass(frozen=True)
class Transform:
    """One registered transform: how its argument is read and how the column is built."""

    code: str
    description: str
    argument_mode: str
    build: Callable[[Column, object], Column]
    parse: Callable[[str | None, str], object] = lambda argument, code: None

    def apply(self, value: Column, argument: str | None, kind: T.DataType | None = None) -> Column:
        """The transformed column; ``kind`` is its type, where known."""
        parsed = self.parse(argument, self.code)
        return _replace_null(value, parsed, kind) if self.code == "REPLACE_NULL" else self.build(value, parsed)


REGISTRY: dict[str, Transform] = {
    t.code: t
    for t in [
        Transform("TRIM", "Trim surrounding whitespace.", "NONE", lambda v, _: trimmed(_as_text(v))),
        Transform("UPPERCASE", "Convert text to upper case.", "NONE", lambda v, _: F.upper(_as_text(v))),
        Transform("LOWERCASE", "Convert text to lower case.", "NONE", lambda v, _: F.lower(_as_text(v))),
        Transform("PREFIX", "Put the argument before the trimmed text.", "REQUIRED",
                  lambda v, a: F.concat(F.lit(a), trimmed(_as_text(v))), _text_argument),
        Transform("SUFFIX", "Put the argument after the trimmed text.", "REQUIRED",
                  lambda v, a: F.concat(trimmed(_as_text(v)), F.lit(a)), _text_argument),
        Transform("REPLACE_NULL", "Replace nulls by the argument.", "REQUIRED",
                  lambda v, a: F.coalesce(_as_text(v), F.lit(a)), _text_argument),
        Transform("ADD", "Add the argument.", "REQUIRED",
                  lambda v, a: (to_number(v) + F.lit(_plain(a))).cast(NUMBER), _argument_number),
        Transform("SUBTRACT", "Subtract the argument.", "REQUIRED",
                  lambda v, a: (to_number(v) - F.lit(_plain(a))).cast(NUMBER), _argument_number),
        Transform("MULTIPLY", "Multiply by the argument.", "REQUIRED",
                  lambda v, a: (to_number(v) * F.lit(_plain(a))).cast(NUMBER), _argument_number),
        Transform("DIVIDE", "Divide by the argument at scale 8, half up.", "REQUIRED", _divide, _divisor),
        Transform("ROUND", "Round half up to the given scale, 0 by default.", "OPTIONAL", _round, _round_scale),
    ]
}


def find(code: str | None) -> Transform:
    name = (code or "").strip().upper()
    if name not in REGISTRY:
        raise ValueError(f"Unsupported transform type: {code}")
    return REGISTRY[name]


def validate(code: str | None, argument: str | None) -> None:
    transform = find(code)
    transform.parse(argument, transform.code)


def capabilities(spark: SparkSession) -> DataFrame:
    """The registry as a table: code, argument mode, description."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("code", "argument_mode", "description")])
    return spark.createDataFrame([(t.code, t.argument_mode, t.description) for t in REGISTRY.values()], schema)
