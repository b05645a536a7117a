"""Payload parsing, newer-wins merge and pull outcomes."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recoflow.operators import merge, pulls, supplier

AT = datetime(2026, 4, 9, 1)
COLUMNS = ("seq bigint, supplier_id bigint, supplier_code string, erp_type string, raw_payload string, "
           "page_token string, next_page_token string, pulled_at timestamp_ntz")


def parse(spark, system, payload, supplier_id=1, code="C", at=AT):
    df = spark.createDataFrame([(1, supplier_id, code, system, payload, None, " p ", at)], COLUMNS)
    parsed = supplier.parse_payloads(df)
    return parsed.first().error, supplier.records(parsed).orderBy("item_index").collect()


def test_kingdee(spark):
    cells = [["k7", "Blue Kiln", "bk", "A", "t1"], ["k8", "Ölmühle \"Süd\"", "om", "zz", "t2"]]
    error, rows = parse(spark, "kingdee", json.dumps(cells, ensure_ascii=False))
    assert error is None and [json.loads(r.raw_item_json) for r in rows] == cells
    assert [(r.source_record_id, r.supplier_name, r.source_business_code, r.source_supplier_status) for r in rows] == [
        ("k7", "Blue Kiln", "bk", "A"), ("k8", "Ölmühle \"Süd\"", "om", "zz")]
    assert [(r.supplier_status, r.source_modified_at, r.tax_no) for r in rows][0] == ("ACTIVE", "t1", "")
    assert {(r.page_token, r.next_page_token) for r in rows} == {("", "p")}


def test_yonyou(spark):
    error, rows = parse(spark, "YONYOU", '{"code":0,"data":{"rows":[{"code":"A1","name":"N","status":"Y","taxNo":" t "},'
                                         '{"code":"A2","name":"M","status":"0","modifyDate":"2026"}]}}')
    assert error is None
    assert [(r.source_record_id, r.source_business_code, r.supplier_status, r.tax_no, r.source_modified_at)
            for r in rows] == [("A1", "A1", "ACTIVE", "t", ""), ("A2", "A2", "INACTIVE", "", "2026")]


def test_generic(spark):
    names = ["valid", "INVALID"]
    payload = json.dumps({"note": 1, "records": [{"status": n, "name": f"n{i}", "id": 40 + i} for i, n in enumerate(names)]})
    error, rows = parse(spark, "GENERIC", payload)
    assert error is None and [(r.source_record_id, r.source_business_code) for r in rows] == [("40", "40"), ("41", "41")]
    assert [r.supplier_status for r in rows] == ["ACTIVE", "INACTIVE"]


@pytest.mark.parametrize("scalar", ["123", "-1.5e3", ' "x\\"y" ', "true", "null"])
def test_a_scalar_is_a_wrong_root(spark, scalar):
    assert parse(spark, "KINGDEE", scalar)[0] == "Expected JSON array as root"
    assert parse(spark, "YONYOU", scalar)[0] == "YONYOU root must be JSON object"
    assert parse(spark, "GENERIC", scalar)[0] == "GENERIC root must be JSON object"


def test_generic_alternates(spark):
    _, rows = parse(spark, "GENERIC", '{"records":[{"id":" ","recordId":"r","code":"c","name":"n","status":"valid",'
                                      '"tax_no":"t","updatedAt":"u"}]}')
    r = rows[0]
    assert (r.source_record_id, r.source_business_code, r.tax_no, r.source_modified_at) == ("r", "c", "t", "u")


@pytest.mark.parametrize("system, payload, message", [
    ("YONYOU", '{"code":500,"message":"mock error"}', "YONYOU response code is not success: 500"),
    ("YONYOU", '{"message":"x"}', "YONYOU response code is not success: -1"),
    ("YONYOU", '{"code":0}', "YONYOU data node is missing or invalid"),
    ("YONYOU", '{"code":0,"data":{"rows":1}}', "YONYOU rows node is missing or invalid"),
    ("YONYOU", '{"code":0,"data":{"rows":[{"code":"a","name":" ","status":"1"}]}}',
     "YONYOU field is blank: name, rowIndex=0"),
    ("YONYOU", '{"code":0,"data":{"rows":[[1]]}}', "YONYOU row must be object, rowIndex=0"),
    ("YONYOU", '{"code":0,', "Failed to parse YONYOU raw payload JSON"),
    ("KINGDEE", '{"code":0}', "Expected JSON array as root"), ("KINGDEE", 'oops', "Failed to parse raw payload JSON"),
    ("KINGDEE", '[["a","b","c","A","m"],["a","b","c"]]', "KINGDEE field is missing: supplierStatus, rowIndex=1"),
    ("KINGDEE", '[["a",null,"c","A","m"]]', "KINGDEE field is missing: supplierName, rowIndex=0"),
    ("KINGDEE", '[{"a":1}]', 'Invalid row: {"a":1}'),
    ("GENERIC", '[1]', "GENERIC root must be JSON object"),
    ("GENERIC", '{"records":[{"name":"n","status":"s"}]}',
     "GENERIC field is missing or blank: id/recordId/code, rowIndex=0"),
    ("GENERIC", '{"records":[null]}', "GENERIC row must be object, rowIndex=0"),
    ("SAP", "[]", "No parser found for ERP type: SAP"), ("GENERIC", None, "Failed to parse GENERIC raw payload JSON")])
def test_bad_payloads(spark, system, payload, message):
    error, rows = parse(spark, system, payload)
    assert error == message and rows == []


def test_one_bad_row_fails_the_payload_and_an_empty_one_is_fine(spark):
    assert parse(spark, "KINGDEE", "[]") == (None, [])
    error, rows = parse(spark, "GENERIC", '{"records":[{"id":1,"name":"n","status":"A"}]}', supplier_id=0)
    assert error == "supplierId must be positive" and rows == []


def test_dead_letter_is_cut(spark):
    df = spark.createDataFrame([(1, 1, "C", "KINGDEE", "{" + "x" * 600, None, None, AT)], COLUMNS)
    letter = supplier.dead_letters(supplier.parse_payloads(df), AT).first()
    assert len(letter.raw_snippet) == 512 and letter.error_type == "TRANSFORM_ERROR"


RECORD = "seq bigint, k int, name string, pulled_at timestamp_ntz"


def hour(n):
    return datetime(2024, 1, 1, n)


@pytest.mark.parametrize("with_stored", [False, True])
def test_newer_wins_equals_a_loop(spark, with_stored):
    rng = random.Random(5)
    rows = [(seq, rng.randrange(6), f"v{seq}", hour(rng.randrange(1, 9))) for seq in range(60)]
    kept = {k: (f"s{k}", hour(5), datetime(2024, 1, 5), datetime(2024, 1, 6)) for k in range(0, 9, 2)} if with_stored else {}
    stored = spark.createDataFrame([(k, *v) for k, v in kept.items()], "k int, name string, pulled_at timestamp_ntz, "
                                   "created_at timestamp_ntz, updated_at timestamp_ntz") if with_stored else None
    state, skipped, now = dict(kept), 0, datetime(2024, 2, 1)
    for _, k, name, at in rows:
        if k in state and at < state[k][1]:
            skipped += 1
        else:
            state[k] = (name, at, state[k][2] if k in state else now, now)
    df = spark.createDataFrame(rows, RECORD)
    merged = merge.newer_wins(df, ["k"], "pulled_at", "seq", F.lit("2024-02-01").cast("timestamp_ntz"), stored)
    assert {r.k: (r.name, r.pulled_at, r.created_at, r.updated_at) for r in merged.collect()} == state
    outcomes = merge.write_outcomes(df, ["k"], "pulled_at", "seq", stored)
    assert tuple(merge.outcome_summary(outcomes).first()) == (len(rows) - skipped, skipped)


def test_upsert_and_dedup_last(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    incoming = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert sorted(map(tuple, merge.upsert(stored, incoming, ["k"], F.col("v")).collect())) == [
        (1, "a"), (2, "y"), (3, "z")]
    rows = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (3, 5, "c"), (4, None, "d")], "s int, k int, v string")
    assert sorted(r.v for r in merge.dedup_last(rows, "k", F.col("s")).collect()) == ["a", "c", "d"]


@pytest.mark.parametrize("n", [1, 2, 99, 100, 101, 2500])
def test_p99_is_the_element_at_floor(spark, n):
    values = [((i * 37) % 5000) ** 2 * 50 for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert pulls.order_statistic(df, "v", 0.99, "p").first().p == sorted(values)[int(n * 0.99)]


def test_empty_pull_report(spark):
    audit = spark.createDataFrame([], "outcome string, duration_ms bigint")
    assert tuple(pulls.pull_report(audit, 1000).first()) == (0, 0, 0, 0, 0.0, 0, 0, 0.0)
