"""Rule-driven ingestion: validation, filters, mapping, transforms, de-duplication, summary."""

import pytest
from pyspark.sql import functions as F

from recoflow.operators import ingest as ing

SCHEMA = "id int, name string, price decimal(10,2), note string, ts timestamp_ntz"


@pytest.fixture(scope="module")
def items(spark):
    return spark.sql("""
        SELECT * FROM VALUES
          (1, 'Apple', CAST(24.99 AS DECIMAL(10,2)), CAST(NULL AS STRING), TIMESTAMP_NTZ '2024-01-01 10:00:00'),
          (2, 'banana', CAST(2499.00 AS DECIMAL(10,2)), 'n', TIMESTAMP_NTZ '2024-01-02 10:00:00'),
          (3, 'CHERRY', CAST(5.00 AS DECIMAL(10,2)), 'm', TIMESTAMP_NTZ '2024-01-03 10:00:00'),
          (CAST(NULL AS INT), 'date', CAST(1.00 AS DECIMAL(10,2)), 'k', TIMESTAMP_NTZ '2024-01-04 10:00:00')
        AS t(id, name, price, note, ts)""")


def ids(df):
    return [r[0] for r in df.select("name").orderBy("name").collect()]


@pytest.mark.parametrize("sql, message", [
    ("INSERT INTO t VALUES (1)", "Only SELECT"), ("delete from t", "Only SELECT"),
    ("SELECT 1; DROP TABLE t", "forbidden keyword: DROP"), ("SELECT updated_at FROM t", "forbidden keyword: UPDATE")])
def test_only_selects_pass(sql, message):
    with pytest.raises(ValueError, match=message):
        ing.IngestionRequest(query=sql).validate()


def test_defaults_and_limits():
    request = ing.IngestionRequest(query="  SELECT * FROM suppliers LIMIT 10")
    request.validate()
    assert request.max_rows is None and request.sort_direction == "DESC"
    for rows in (0, 50_001):
        with pytest.raises(ValueError, match="maxRows"):
            ing.IngestionRequest(query="SELECT 1", max_rows=rows).validate()


@pytest.mark.parametrize("request_, message", [
    (ing.IngestionRequest(source_table="t"), "At least one enabled field mapping"),
    (ing.IngestionRequest(source_table="t; x", mappings=[ing.FieldMapping("a")]), "sourceTable contains illegal"),
    (ing.IngestionRequest(source_table="t", mappings=[ing.FieldMapping("a.x"), ing.FieldMapping("b.x")]), "unique"),
    (ing.IngestionRequest(source_table="t", mappings=[ing.FieldMapping("a")], filters=[ing.FilterRule("a", "EQ")]),
     "filters.value is required"),
    (ing.IngestionRequest(source_table="t", mappings=[ing.FieldMapping("a")], filters=[ing.FilterRule("a", "XX", "1")]),
     "Unsupported filter operator"),
    (ing.IngestionRequest(source_table="t", mappings=[ing.FieldMapping("a")], sort_direction="up"), "sortDirection"),
    (ing.IngestionRequest(source_table="t", mappings=[ing.FieldMapping("a")], target=ing.Target("a b")), "targetName"),
    (ing.IngestionRequest(source_table="t", mappings=[ing.FieldMapping("a")], target=ing.Target(write_mode="x")),
     "writeMode"),
    (ing.IngestionRequest(source_table="t", mappings=[ing.FieldMapping("a")],
                          transforms=[ing.TransformRule("a", "MULTIPLY")]), "argument is required")])
def test_bad_requests(request_, message):
    with pytest.raises(ValueError, match=message):
        request_.validate()


def test_disabled_rules_are_not_checked():
    ing.IngestionRequest(
        source_table="t", mappings=[ing.FieldMapping("a"), ing.FieldMapping(None, enabled=False)],
        filters=[ing.FilterRule(None, "XX", enabled=False)]).validate()


def test_mapping_defaults():
    assert ing.FieldMapping(" s.price ").target == "price"
    assert ing.TransformRule("a").target == "a" and ing.TransformRule("a", None).type == "TRIM"


@pytest.mark.parametrize("rules, names", [
    ([("name", "LIKE", "%AN%")], ["banana"]),
    ([("price", "GT", "24.99")], ["banana"]),
    ([("price", "GTE", "24.99")], ["Apple", "banana"]),
    ([("id", "IN", "1, 3 ,9")], ["Apple", "CHERRY"]),
    ([("id", "NE", "1")], ["CHERRY", "banana"]),
    ([("note", "IS_NULL", None)], ["Apple"]),
    ([("ts", "<", "2024-01-02 12:00:00")], ["Apple", "banana"]),
    ([("id", "LT", "2.5")], ["Apple", "banana"]),
    # The first link is ignored; a OR b AND c is a OR (b AND c).
    ([("id", "EQ", "1", "OR"), ("id", "EQ", "2", "OR"), ("price", "LT", "10", "AND")], ["Apple"]),
    ([("id", "EQ", "1"), ("price", "LT", "10", "AND"), ("id", "EQ", "3", "OR")], ["CHERRY"])])
def test_filters(items, rules, names):
    assert ids(ing.rule_filter(items, [ing.FilterRule(*rule) for rule in rules])) == names


def test_filters_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    request = ing.IngestionRequest(source_table="orders", mappings=[ing.FieldMapping("o_orderkey")],
                                   filters=[ing.FilterRule("o_custkey", "LT", "10")], max_rows=None)
    plan = ing.ingest(spark, request, orders)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_custkey,10)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_rule_field_falls_back_to_its_mapping(spark, items):
    request = ing.IngestionRequest(
        source_table="items", mappings=[ing.FieldMapping("price", "price_cents"), ing.FieldMapping("name")],
        transforms=[ing.TransformRule("price", "MULTIPLY", "100", target="price_cents")], sort_field="ts", max_rows=2)
    rows = ing.ingest(spark, request, items, ["name"]).collect()
    assert [(r.name, int(r.price_cents)) for r in rows] == [("date", 100), ("CHERRY", 500)]


def test_custom_query(spark, items):
    items.createOrReplaceTempView("ingest_items")
    request = ing.IngestionRequest(
        query="SELECT id, name FROM ingest_items", mappings=[ing.FieldMapping("name"), ing.FieldMapping("gone")],
        filters=[ing.FilterRule("id", "EQ", "1")], sort_field="id")
    df = ing.ingest(spark, request)
    assert df.columns == ["name", "gone"] and df.count() == 4 and df.filter("gone IS NOT NULL").isEmpty()


def test_upsert_keeps_the_last_row_per_key_and_all_without_one(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, None, "c"), (4, None, "d"), (5, 2, "e")],
                                 "seq int, key int, v string")
    request = ing.IngestionRequest(
        source_table="t", mappings=[ing.FieldMapping("key"), ing.FieldMapping("v")],
        target=ing.Target(write_mode="merge", primary_key="key", incremental_field="seq"), sort_direction="ASC")
    assert sorted(r.v for r in ing.ingest(spark, request, rows, ["seq"]).collect()) == ["b", "c", "d", "e"]
    descending = ing.IngestionRequest(
        source_table="t", mappings=[ing.FieldMapping("key"), ing.FieldMapping("v")],
        target=ing.Target(write_mode="UPSERT", primary_key="key", incremental_field="seq"), max_rows=None)
    assert sorted(r.v for r in ing.ingest(spark, descending, rows, ["seq"]).collect()) == ["a", "c", "d", "e"]


def test_summary(items):
    row = ing.ingestion_summary(items, ["ts"], {"mode": "RULE_BUILDER"}, sample_size=2).first()
    assert row.total_records == 4 and row.columns == items.columns and len(row.sample_rows) == 2
    assert '"note":null' in row.sample_rows[0] and row.metadata == {"mode": "RULE_BUILDER"}
    assert ing.ingestion_summary(items.filter(F.lit(False)), ["ts"]).first().total_records == 0
