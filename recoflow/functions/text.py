"""Text helpers shared by ingestion, normalisation and profile texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters removed by a trim (everything up to U+0020) and those that count as blank.
TRIMMED_CHARS = "".join(chr(code) for code in range(0x21))
BLANK_CHARS = "".join(
    chr(code)
    for code in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x1680, *range(0x2000, 0x2007),
                 *range(0x2008, 0x200B), 0x2028, 0x2029, 0x205F, 0x3000]
)
SECRET_MASK = "******"
TRUNCATION_MARK = "...[truncated]"


def trimmed(value: Column) -> Column:
    """Trim control characters and spaces; Spark's own ``trim`` strips spaces only."""
    return F.btrim(value, F.lit(TRIMMED_CHARS))


def is_blank(value: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(F.btrim(value, F.lit(BLANK_CHARS)) == "", F.lit(True))


def nullable_text(value: Column) -> Column:
    """Trimmed text; null when nothing is left."""
    return F.nullif(trimmed(value), F.lit(""))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(trimmed(value), F.lit(""))


def default_if_blank(value: Column, default: Column | str) -> Column:
    """Trimmed text, or the default when nothing is left."""
    return F.coalesce(nullable_text(value), default if isinstance(default, Column) else F.lit(default))


def value_or_default(value: Column, default: str) -> Column:
    """The text as it is, or the default when it is blank."""
    return F.when(is_blank(value), F.lit(default)).otherwise(value)


def first_filled(*values: Column) -> Column:
    """The first of several texts that is not blank, else null."""
    return F.coalesce(*[F.when(~is_blank(v), v) for v in values])


def mask_secret(value: Column) -> Column:
    return F.when(~is_blank(value), F.lit(SECRET_MASK))


def snippet(value: Column, length: int = 512) -> Column:
    return F.substring(value, 1, length)


def capped_payload(value: Column, max_bytes: int = 4096) -> Column:
    """Payload cut to ``max_bytes`` bytes plus a mark; null becomes empty text.

    A character cut in half turns into U+FFFD.
    """
    head = F.make_valid_utf8(F.substring(F.encode(value, "UTF-8"), 1, max_bytes).cast("string"))
    return (
        F.when(value.isNull(), F.lit(""))
        .when(F.octet_length(value) <= max_bytes, value)
        .otherwise(F.concat(head, F.lit(TRUNCATION_MARK)))
    )


def labelled(value: Column, table: dict[str, object], default: Column | str | None = None) -> Column:
    """Replace codes by labels from a fixed table; ``default`` for anything else."""
    result = None
    for code, label in table.items():
        result = F.when(value == code, F.lit(label)) if result is None else result.when(value == code, F.lit(label))
    return result.otherwise(default if isinstance(default, Column) else F.lit(default))
