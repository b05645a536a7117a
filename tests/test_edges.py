"""Rows that are null, badly formed or only equal in part: none is lost, merged or fatal."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recoflow.functions import transforms
from recoflow.operators import events, ingest as ing, orders, quality, skew
from recoflow.sources import readers, sinks
from recoflow.streaming import orders as order_stream
from recoflow.session import one_process
from test_orders import message

START = datetime(2024, 1, 1)
PLACED = "seq bigint, topic string, value string, partition int"


def test_offsets_repeat_in_every_partition(spark):
    bad = [(7, "t", "junk", 0), (7, "t", "more junk", 1)]
    good = [(*message(9), 0), (*message(9), 1)]
    decoded = orders.decode_orders(spark.createDataFrame(bad + good, PLACED))
    outcomes = sorted(r.outcome for r in orders.classify(decoded).collect())
    assert outcomes == ["DEAD_LETTER", "DEAD_LETTER", "DUPLICATE", "PROCESSED"]
    firsts = orders.first_events(decoded)
    letters = orders.order_dead_letters(firsts).collect()
    assert {(r.partition, r.full_payload) for r in letters} == {(0, "junk"), (1, "more junk")}
    assert {r.outcome: r.events for r in orders.outcome_counts(firsts).collect()} == {
        "DEAD_LETTER": 2, "PROCESSED": 1, "DUPLICATE": 1}


def test_arrival_goes_by_time_then_place(spark):
    rows = [(*message(1, "a", amount=1), 1, START), (*message(8, "b", amount=2), 0, START - timedelta(seconds=1))]
    df = spark.createDataFrame(rows, PLACED + ", timestamp timestamp")
    assert [float(r.amount) for r in orders.order_etl(df, START).orders.collect()] == [1.0]


def test_a_null_topic_is_a_topic(spark):
    rows = [(s, None, v) for s, _, v in (message(1), message(2))]
    decoded = orders.decode_orders(spark.createDataFrame(rows, "seq bigint, topic string, value string"))
    assert [r.outcome for r in orders.classify(decoded).orderBy("seq").collect()] == ["PROCESSED", "DUPLICATE"]
    firsts = orders.first_events(decoded)
    assert [(r.outcome, r.copies) for r in firsts.collect()] == [("PROCESSED", 2)]
    marks = orders.new_marks(firsts)
    assert [r.outcome for r in orders.first_events(decoded, marks).collect()] == ["DUPLICATE"]
    assert {r.outcome for r in orders.classify(decoded, marks).collect()} == {"DUPLICATE"}


@pytest.mark.parametrize("max_rows", [3, 1_000_000])
def test_rows_without_a_time(spark, max_rows):
    times = [START + timedelta(minutes=i) for i in range(8)] + [None] * 4
    rows = [(i, 1, 1, "VIEW", None, at) for i, at in enumerate(times)]
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, item_id bigint, behavior_type string, "
                                     "rating double, event_time timestamp_ntz")
    kept = events.dedup_within_gap(df, timedelta(minutes=5), max_rows=max_rows).collect()
    assert sorted(r.event_id for r in kept) == [0, 5]
    asked = df.select(F.col("event_id").alias("seq"), F.col("user_id").alias("client"), F.col("event_time").alias("at"))
    capped = quality.request_cap(asked, ["client"], 3, timedelta(hours=1), max_rows=max_rows).collect()
    assert sorted(r.seq for r in capped if r.accepted) == [0, 1, 2] and len(capped) == 12


@pytest.mark.parametrize("descending", [False, True])
def test_null_order_values_rank_alike_cut_or_not(spark, descending):
    rows = [(1, i) for i in range(100)] + [(1, None)] * 5
    df = spark.createDataFrame(rows, "k int, o bigint")

    def ranks(max_rows):
        ranked = skew.rank_within(df, ["k"], "o", "p", F.lit(12), descending=descending, max_rows=max_rows)
        return [r.o for r in ranked.orderBy("p").collect()]

    assert ranks(20) == ranks(1_000_000)


def test_an_upsert_keeps_rows_of_a_null_partition(spark, tmp_path):
    schema = "id int, v string, p string, q int"
    path = str(tmp_path / "t")
    sinks.upsert_table(path, spark.createDataFrame([(1, "a", None, 1), (2, "b", None, 1), (3, "c", "07", 1)], schema), ["id"], ["p"])
    sinks.upsert_table(path, spark.createDataFrame([(2, "B", None, 1), (4, "d", "07", 1)], schema), ["id"], ["p"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    two = str(tmp_path / "u")
    sinks.upsert_table(two, spark.createDataFrame([(1, "a", None, 1), (2, "b", None, None)], schema), ["id"], ["p", "q"])
    sinks.upsert_table(two, spark.createDataFrame([(5, "e", None, 1), (6, "f", None, None)], schema), ["id"], ["p", "q"])
    assert sorted(r.id for r in spark.read.parquet(two).collect()) == [1, 2, 5, 6]


def test_many_touched_partitions_include_the_null_one(spark):
    stored = spark.createDataFrame([(1, None), (2, 5), (3, 5000)], "id int, p int")
    batch = spark.range(1500).selectExpr("CAST(IF(id = 0, NULL, id) AS INT) AS p")
    assert sorted(r.id for r in sinks.touched_partitions(stored, batch, ["p"]).collect()) == [1, 2]


def test_quoted_cells(spark):
    lines = spark.createDataFrame([(0, 'id,"full, name",'), (1, '1,"ACME, ""Inc.""",x'), (2, "2"), (3, " ")],
                                  "line_no int, text string")
    sheet = readers.parse_sheet(lines).orderBy("line_no")
    assert sheet.columns == ["line_no", "id", "full, name", "column_2"]
    assert [tuple(r)[1:] for r in sheet.collect()] == [("1", 'ACME, "Inc."', "x"), ("2", "", "")]


def test_caps_only_on_request(spark):
    dump = spark.createDataFrame([(f"k{i:03}", "list", None, None, ["x"] * 150) for i in range(130)],
                                 "key string, type string, text string, fields map<string,string>, items array<string>")
    assert readers.key_value_dump(dump).count() == 130
    first = readers.key_value_dump(dump, max_keys=2, max_items=3).orderBy("key").collect()
    assert [(r.key, r.value) for r in first] == [("k000", '["x","x","x"]'), ("k001", '["x","x","x"]')]


def test_rows_without_id_or_time_pass_the_ttl(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(
        ['{"topic":"t","occurred_at":"2024-01-01T00:00:00"}'] * 3 + ['{"topic":"t","event_id":"a"}'] * 2
        + ['{"topic":"t","event_id":"a","occurred_at":"2024-01-01T00:00:00"}'] * 2))
    schema = "topic string, event_id string, occurred_at timestamp_ntz"
    stream = order_stream.within_ttl(readers.file_stream(spark, str(tmp_path / "in"), schema))
    query = (stream.writeStream.format("memory").queryName("ttl_edges").outputMode("append")
             .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "chk")).start())
    query.awaitTermination(60)
    assert spark.table("ttl_edges").count() == 6


def test_replaced_nulls_keep_the_type_of_a_number(spark):
    df = spark.createDataFrame([(1, None), (None, "v")], "n int, s string")
    for argument, kind, values in (("0", "int", [0, 1]), ("none", "string", ["1", "none"]), ("0.5", "string", ["0.5", "1"])):
        done = ing.transform_chain(df, [ing.TransformRule("n", "REPLACE_NULL", argument)])
        assert dict(done.dtypes)["n"] == kind and sorted(r.n for r in done.collect()) == values
    assert transforms.find("replace_null").code == "REPLACE_NULL"


@pytest.mark.parametrize("master, alone", [
    ("local", True), ("local[8]", True), ("local[*, 2]", True), ("local-cluster[2,1,1024]", False), ("spark://h:7077", False)])
def test_a_local_folder_only_serves_one_process(master, alone):
    assert one_process(master) is alone
