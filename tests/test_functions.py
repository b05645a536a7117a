"""Scalar functions: texts, codes, scores, transforms, addresses."""

import pytest
from pyspark.sql import functions as F

from recoflow.functions import codes, network, scoring, text, transforms


def one(spark, column, **values):
    """Value of an expression over a single row."""
    source = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return source.select(column).first()[0]


def test_trim_takes_control_characters(spark):
    assert one(spark, text.trimmed(F.lit("\t a b \x01\n"))) == "a b"
    assert one(spark, text.nullable_text(F.lit(" \t "))) is None
    assert one(spark, text.default_if_blank(F.lit("  "), "d")) == "d"
    assert one(spark, text.value_or_default(F.lit(" x "), "d")) == " x "
    assert one(spark, text.first_filled(F.lit(None).cast("string"), F.lit("　"), F.lit(" y"))) == " y"


def test_secrets_and_snippets(spark):
    assert one(spark, text.mask_secret(F.lit("pw"))) == "******"
    assert one(spark, text.mask_secret(F.lit("  "))) is None
    assert one(spark, text.snippet(F.lit("abcdef"), 4)) == "abcd"


def test_payload_cap_counts_bytes(spark):
    assert one(spark, text.capped_payload(F.lit("abcd"), 4)) == "abcd"
    assert one(spark, text.capped_payload(F.lit("abcde"), 4)) == "abcd...[truncated]"
    assert one(spark, text.capped_payload(F.lit("ab价"), 4)) == "ab�...[truncated]"
    assert one(spark, text.capped_payload(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize("alias, name", [("insert", "APPEND"), ("MERGE", "UPSERT"), ("overwrite", "REPLACE"),
                                         ("other", "OTHER"), (None, None), (" ", " ")])
def test_write_mode_aliases(alias, name):
    assert codes.canonical_alias(alias, codes.WRITE_MODE_ALIASES) == name


@pytest.mark.parametrize("alias, name", [("IS_NOT_NULL", "NOT_NULL"), ("equals", "EQ"), ("AFTER", "GT"),
                                         ("contains", "LIKE"), ("<>", "NE")])
def test_operator_aliases(alias, name):
    assert codes.canonical_alias(alias, codes.FILTER_OPERATOR_ALIASES) == name


@pytest.mark.parametrize("system, code, status", [
    ("kingdee", " enable ", "ACTIVE"), ("KINGDEE", "B", "INACTIVE"), ("KINGDEE", "1", "UNKNOWN"),
    ("YONYOU", "1", "ACTIVE"), ("YONYOU", "no", "INACTIVE"), ("GENERIC", "valid", "ACTIVE"),
    ("GENERIC", "A", "UNKNOWN"), ("SAP", "ACTIVE", "UNKNOWN")])
def test_supplier_status(spark, system, code, status):
    assert one(spark, codes.canonical_status(F.lit(system), F.lit(code))) == status


def test_system_of_code(spark):
    found = [one(spark, codes.erp_type_of(F.lit(c))) for c in ("KD_1", "YY_1", "kd_1", "X")]
    assert found == ["KINGDEE", "YONYOU", "GENERIC", "GENERIC"]


def test_backoff_is_capped(spark):
    delays = [one(spark, codes.backoff_seconds(F.lit(n), 30, 3600)) for n in (-1, 0, 3, 7, 99)]
    assert delays == [30, 30, 240, 3600, 3600]


@pytest.mark.parametrize("cursor, first, date, offset", [
    ("2026-01-01 10:00:00|40", 0, "2026-01-01 10:00:00", 40), ("a|b|7", 0, "a|b", 7), ("2026-01-01", 1, "2026-01-01", 1),
    ("2026-01-01|x", 0, "2026-01-01", 0), ("2026-01-01|x", 1, "2026-01-01", 1), ("d|-3", 1, "d", 1), ("d|-3", 0, "d", -3),
    ("  ", 1, None, 1), (None, 0, None, 0), ("d|99999999999", 0, "d", 0)])
def test_cursors(spark, cursor, first, date, offset):
    value = F.lit(cursor).cast("string")
    assert one(spark, codes.cursor_date(value)) == date
    assert one(spark, codes.cursor_offset(value, first)) == offset


def test_cursor_round_trip(spark):
    assert one(spark, codes.encode_cursor(F.lit(None).cast("string"), F.lit(3))) == "|3"


@pytest.mark.parametrize("amount, currency, cny", [("99.50", "USD", "716.40"), ("10.00", "JPY", "0.48"),
                                                   ("0.10", "JPY", "0.00"), ("5.00", "GBP", None)])
def test_amounts_in_cny(spark, amount, currency, cny):
    value = one(spark, codes.amount_in_cny(F.lit(amount).cast("decimal(18,2)"), F.lit(currency)))
    assert (None if value is None else str(value)) == cny


@pytest.mark.parametrize("kind, rating, score, weight", [
    ("VIEW", None, 1.0, 1.0), ("PURCHASE", None, 5.0, 5.0), ("RATE", None, 0.0, 4.0), ("RATE", 5.0, 4.0, 4.0),
    ("RATE", 3.0, 2.0, 2.0), ("RATE", 9.0, 4.0, 8.0), ("PURCHASE", 3.0, 5.0, 2.5), ("OTHER", 2.0, 0.0, None),
    ("RATE", 0.0, 0.0, 4.0)])
def test_scores(spark, kind, rating, score, weight):
    k, r = F.lit(kind), F.lit(rating).cast("double")
    assert one(spark, scoring.preference_score(k, r)) == score
    assert one(spark, scoring.event_weight(k, r)) == weight


def test_rating_and_type_checks(spark):
    assert [one(spark, scoring.is_valid_rating(F.lit(v))) for v in (1.0, 5.0, 0.99, 5.01, float("nan"))] == [
        True, True, False, False, False]
    assert one(spark, scoring.parsed_behavior_type(F.lit("view"))) == "VIEW"
    assert one(spark, scoring.parsed_behavior_type(F.lit(" view"))) is None


@pytest.mark.parametrize("code, value, argument, result", [
    ("MULTIPLY", "2499.00", "100", "249900"), ("MULTIPLY", "24.99", "100", "2499"), ("ROUND", "2499.50", "0", "2500"),
    ("ROUND", "24.99", None, "25"), ("ROUND", "-2.5", None, "-3"), ("ADD", " 1.10 ", "2", "3.1"),
    ("SUBTRACT", "1", "2.5", "-1.5"), ("DIVIDE", "1", "3", "0.33333333"), ("DIVIDE", "2", "3", "0.66666667"),
    ("DIVIDE", "0.00000001", "2.00000001", "0"), ("DIVIDE", "-1", "3", "-0.33333333"), ("DIVIDE", "10", "4", "2.5"),
    ("ROUND", "1250", "-2", "1300"), ("MULTIPLY", "1e3", "2", "2000")])
def test_number_transforms(spark, code, value, argument, result):
    column = transforms.find(code).apply(F.lit(value), argument)
    assert one(spark, transforms.canonical_number(column)) == result


@pytest.mark.parametrize("code, value, argument, result", [
    ("TRIM", "\t a ", None, "a"), ("uppercase", " ab", None, " AB"), ("LOWERCASE", "AB", None, "ab"),
    ("PREFIX", " a ", "x-", "x-a"), ("SUFFIX", " a ", "-x", "a-x"), ("REPLACE_NULL", None, "n", "n"),
    ("REPLACE_NULL", "v", "n", "v"), ("TRIM", None, None, None), ("PREFIX", None, "x", None)])
def test_text_transforms(spark, code, value, argument, result):
    assert one(spark, transforms.find(code).apply(F.lit(value).cast("string"), argument)) == result


def test_null_stays_null_in_number_transforms(spark):
    assert one(spark, transforms.find("ADD").apply(F.lit(None).cast("string"), "1")) is None


def test_text_in_a_number_transform_stops_the_query(spark):
    with pytest.raises(Exception, match="requires a numeric field value but got: abc"):
        one(spark, transforms.find("ADD").apply(F.lit("abc"), "1"))


@pytest.mark.parametrize("code, argument, message", [
    ("MULTIPLY", "abc", "must be numeric"), ("MULTIPLY", None, "transformRules.argument is required for type MULTIPLY"),
    ("DIVIDE", "0", "cannot be zero"), ("ROUND", "1.5", "integer scale"), ("PREFIX", " ", "required"),
    ("NOPE", None, "Unsupported transform type"), (None, None, "Unsupported transform type")])
def test_transform_arguments_are_checked(code, argument, message):
    with pytest.raises(ValueError, match=message):
        transforms.validate(code, argument)


def test_capabilities(spark):
    rows = {r.code: r.argument_mode for r in transforms.capabilities(spark).collect()}
    assert len(rows) == 11 and rows["TRIM"] == "NONE" and rows["ROUND"] == "OPTIONAL" and rows["ADD"] == "REQUIRED"


@pytest.mark.parametrize("address, public", [
    ("8.8.8.8", True), ("127.0.0.1", False), ("10.9.9.9", False), ("172.15.0.1", True), ("172.31.255.255", False),
    ("192.168.1.1", False), ("169.254.1.1", False), ("224.0.0.1", False), ("0.0.0.0", False), ("0.0.0.1", True)])
def test_public_addresses(spark, address, public):
    assert one(spark, network.is_public(F.lit(address))) is public


def test_blocks(spark):
    inside = [one(spark, network.in_block(F.lit(a), "192.168.4.0/22")) for a in ("192.168.7.255", "192.168.8.0", "db")]
    assert inside == [True, False, False]
    assert one(spark, network.in_block(F.lit("1.2.3.4"), "0.0.0.0/0")) is True
