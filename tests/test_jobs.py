"""Streams, tables, readers and the training job."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recoflow.operators import preference, recall, windows
from recoflow.plans import tables, training
from recoflow.sources import readers, sinks
from recoflow.streaming import behavior, orders as order_stream, suppliers

START = datetime(2024, 1, 1)


def event(i, seconds, user=1, item=2, kind="VIEW", rating=None):
    at = (START + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"value": json.dumps({"eventId": f"e{i}", "userId": user, "itemId": item, "behaviorType": kind,
                                 "rating": rating, "timestamp": at})}


def write_lines(path, rows):
    """A file source reads files in the order of their times, one second per file number here."""
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows))
    os.utime(path, (1_700_000_000 + int(path.stem),) * 2)


def test_decoding_drops_junk_and_survives_bad_times(spark):
    rows = [event(1, 0)["value"], "junk", json.dumps({"eventId": "x"}),
            json.dumps({"eventId": "y", "userId": 1, "timestamp": "yesterday"})]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    got = {r.event_id: r.event_time for r in readers.decode_events(df).collect()}
    assert got == {"e1": START, "y": None}
    assert sorted(r.reason for r in readers.unreadable_events(df).collect()) == ["BAD_TIME", "NO_USER", "NO_USER"]


def test_streams_equal_their_batch_twins(spark, tmp_path):
    rows = [event(i, i * 7, user=i % 3 + 1, item=i % 5 + 1, kind=["VIEW", "CLICK", "PURCHASE", "RATE"][i % 4],
                  rating=3.5 if i % 4 == 3 else None) for i in range(200)]
    source = tmp_path / "in"
    for part in range(4):
        write_lines(source / f"{part}.json", rows[part * 50:(part + 1) * 50])
    stream = readers.decode_events(readers.file_stream(spark, str(source), "value string", max_files=1))
    paths = behavior.StreamPaths(*[str(tmp_path / n) for n in ("agg", "delta", "msg", "chk")])
    queries = behavior.start_behavior_queries(
        stream, paths, lambda messages: sinks.message_files(messages, paths.messages), available_now=True)
    for query in queries:
        query.awaitTermination(120)
        assert query.exception() is None
    batch = readers.decode_events(spark.read.schema("value string").json(str(source)))
    columns = ["window_start", "window_end", "user_id", "behavior_type", "event_count", "avg_rating"]
    got = spark.read.parquet(paths.aggregates).select(columns)
    assert sorted(got.collect()) == sorted(windows.behavior_aggregate(batch).select(columns).collect())
    # Deltas are written when their window is closed: all but the last ones.
    columns = ["window_start", "user_id", "item_id", "score_delta", "interaction_delta"]
    closed = {tuple(r) for r in spark.read.parquet(paths.deltas).select(columns).collect()}
    all_deltas = {tuple(r) for r in windows.preference_delta(batch).select(columns).collect()}
    open_ = {r for r in all_deltas if r[0] >= START + timedelta(seconds=199 * 7 - 90)}
    assert all_deltas - open_ <= closed <= all_deltas
    message = json.loads(spark.read.json(paths.messages).first().value)
    assert message["items"][0]["rank"] == 1 and "generatedAt" in message


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    # The watermark moves at the end of a batch and rejects rows from the batch after the next one on.
    for name, rows in (("1", [event(1, 0)]), ("2", [event(2, 600)]), ("3", [event(3, 601)]), ("4", [event(4, 5)])):
        write_lines(source / f"{name}.json", rows)
    stream = readers.decode_events(readers.file_stream(spark, str(source), "value string", max_files=1))
    paths = behavior.StreamPaths(*[str(tmp_path / n) for n in ("agg", "delta", "msg", "chk")])
    for query in behavior.start_behavior_queries(stream, paths, lambda m: None, available_now=True):
        query.awaitTermination(120)
    counts = {r.window_start: r.event_count for r in spark.read.parquet(paths.aggregates).collect()}
    assert counts == {START: 1, START + timedelta(seconds=600): 2}


def test_order_stream_has_exactly_once_effect(spark, tmp_path):
    def order(seq, event_id, order_id, amount, currency="USD"):
        return {"seq": seq, "topic": "t", "value": json.dumps({
            "eventId": {"value": event_id}, "orderId": order_id, "userId": 1, "status": "PAID", "amount": amount,
            "currency": currency, "occurredAt": "2024-01-01T00:00:00Z"})}

    source = tmp_path / "in"
    write_lines(source / "1.json", [order(1, "a", "O1", 10), order(2, "b", "O2", 10), order(3, "a", "O1", 99)])
    write_lines(source / "2.json", [order(4, "a", "O1", 77), order(5, "c", "O1", 20), order(6, "d", "O3", 1, "GBP")])
    write_lines(source / "3.json", [order(7, "d", "O3", 1, "GBP")])
    messages = readers.file_stream(spark, str(source), "seq bigint, topic string, value string", max_files=1)
    paths = order_stream.OrderPaths(*[str(tmp_path / n) for n in ("orders", "marks", "dead", "chk")])
    query = order_stream.start_order_stream(messages, paths, available_now=True, buckets=2)
    query.awaitTermination(120)
    assert query.exception() is None
    got = {r.order_id: float(r.amount_cny) for r in spark.read.parquet(paths.orders).collect()}
    assert got == {"O1": 144.0, "O2": 72.0}
    assert spark.read.parquet(paths.dead_letters).count() == 1
    assert sorted(r.event_id for r in spark.read.parquet(paths.marks).collect()) == ["a", "b", "c", "d"]
    # A replayed batch changes nothing.
    replay = order_stream.order_sink(paths, buckets=2)
    replay(spark.read.schema("seq bigint, topic string, value string").json(str(source / "3.json")), 2)
    assert spark.read.parquet(paths.dead_letters).count() == 1


def test_supplier_stream_keeps_the_newest(spark, tmp_path):
    def pull(seq, name, hour, payload=None):
        body = {"supplierId": 31, "supplierCode": "kiln", "erpType": "KINGDEE",
                "rawPayload": payload or json.dumps([["k7", name, "bk", "A", "m"]]),
                "pulledAt": f"2024-01-01T0{hour}:00:00Z", "recordCount": 1}
        return {"seq": seq, "value": json.dumps(body)}

    source = tmp_path / "in"
    write_lines(source / "1.json", [pull(1, "one", 1), pull(2, "two", 3), pull(3, "x", 4, "{}")])
    write_lines(source / "2.json", [pull(4, "late", 2)])
    messages = readers.file_stream(spark, str(source), "seq bigint, value string", max_files=1)
    paths = suppliers.SupplierPaths(*[str(tmp_path / n) for n in ("records", "dead", "chk")])
    query = suppliers.start_supplier_stream(messages, paths, available_now=True, buckets=2)
    query.awaitTermination(120)
    assert query.exception() is None
    assert [r.supplier_name for r in spark.read.parquet(paths.records).collect()] == ["two"]
    assert [r.error_message for r in spark.read.parquet(paths.dead_letters).collect()] == ["Expected JSON array as root"]


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, p int")
    sinks.upsert_table(path, first, ["k"], ["p"])
    before = {f.name for f in (tmp_path / "t" / "p=1").iterdir()}
    second = spark.createDataFrame([(2, "x", 2), (3, "c", 2)], "k int, v string, p int")
    for _ in range(2):
        sinks.upsert_table(path, second, ["k"], ["p"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "x"), (3, "c")]
    assert {f.name for f in (tmp_path / "t" / "p=1").iterdir()} == before


@pytest.mark.parametrize("mode, expected", [("APPEND", [(1, "a"), (1, "b"), (2, "c")]),
                                            ("UPSERT", [(1, "b"), (2, "c")]), ("REPLACE", [(1, "b"), (2, "c")])])
def test_write_modes(spark, tmp_path, mode, expected):
    path = str(tmp_path / "t")
    sinks.write_by_mode(spark.createDataFrame([(1, "a")], "k int, v string"), path, mode, "k")
    sinks.write_by_mode(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), path, mode, "k")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == expected


def test_train_and_publish_switches_and_cleans_up(spark, sf_dir, tmp_path):
    matrix = tables.preference_matrix(spark, sf_dir)
    settings = training.AlsSettings(rank=4, max_iter=2, top_k=5, blocks=2)
    recall_path, registry_path = str(tmp_path / "recall"), str(tmp_path / "registry")
    versions = []
    for day in (1, 2, 3):
        now = datetime(2024, 2, day)
        result = training.train_and_publish(matrix, recall_path, registry_path, now, settings=settings)
        assert result.previous_version == (versions[-1] if versions else None)
        versions.append(result.model_version)
        assert result.steps[-1] == "SUCCEEDED" and result.recall_rows == result.user_count * 5
    registry = training.read_registry(spark, registry_path)
    assert recall.active_version(registry) == versions[2]
    assert recall.known_versions(registry) == [versions[2], versions[1]]
    assert training.clean_up_recall(spark, recall_path, registry_path) == result.recall_rows
    left = spark.read.parquet(recall_path)
    assert {r.model_version for r in left.select("model_version").distinct().collect()} == set(versions[1:])
    with pytest.raises(LookupError):
        recall.active_version(registry, "other")
    with pytest.raises(ValueError, match="No training data"):
        training.train_and_publish(matrix.limit(0), recall_path, registry_path, now, settings=settings)


def test_dense_ids(spark):
    rows = spark.range(0, 100).select((F.col("id") * 10**12).alias("user_id"))
    got = {r.user_id: r.dense_id for r in training.dense_ids(rows.unionByName(rows), "user_id").collect()}
    assert got == {i * 10**12: i for i in range(100)}


def test_wide_ids_are_narrowed_and_come_back(spark):
    """Only a column that does not fit is numbered anew; rows without an id or a score are no input."""
    rows = spark.createDataFrame([(2**40, 7, 1.5), (5, 8, 2.0), (2**40, 8, 1.0), (None, 7, 1.0), (5, 7, None)],
                                 "user_id bigint, item_id bigint, preference_score double")
    narrow, maps = training.narrowed(training.ratings(rows))
    assert set(maps) == {"user_id"}
    assert sorted(map(tuple, narrow.collect())) == [(0, 8, 2.0), (1, 7, 1.5), (1, 8, 1.0)]
    back = training.widened(narrow.select(F.col("user_id").cast("bigint"), "item_id"), maps)
    assert sorted(map(tuple, back.collect())) == [(5, 8), (2**40, 7), (2**40, 8)]
    assert training.narrowed(training.ratings(rows.limit(0)))[1] == {}


def test_list_invariants_name_what_is_broken(spark):
    rows = [("v", 1, 7, 1, 0.9), ("v", 1, 8, 2, 0.9), ("v", 2, 7, 1, 0.1), ("v", 2, 8, 2, 0.2), ("v", 3, 7, 1, 0.5),
            ("v", 3, 7, 2, 0.5), ("v", 4, 7, 1, 0.5), ("v", 4, 8, 3, 0.5), ("v", 5, 7, 1, None)]
    lists = spark.createDataFrame(rows, "model_version string, user_id bigint, item_id bigint, rank_position int, score double")
    got = {r.user_id: (r["items"], r.ranks_dense, r.scores_fall, r.items_distinct) for r in training.list_invariants(lists).collect()}
    assert got == {1: (2, True, True, True), 2: (2, True, False, True), 3: (2, True, True, False), 4: (2, False, True, True),
                   5: (1, True, False, True)}


def test_supplier_arrival_tells_partitions_apart(spark, tmp_path):
    """Two payloads with one offset in two partitions: the later partition wins a tie of pull times, in any row order."""
    def message(partition, name):
        return (9, partition, json.dumps({"supplierId": 31, "supplierCode": "kiln", "erpType": "KINGDEE", "pulledAt": "2024-01-05T08:00:00",
                                          "rawPayload": json.dumps([["F1", name, "S1", "A", "m"]])}))
    for turn, rows in enumerate([[message(0, "one"), message(1, "two")], [message(1, "two"), message(0, "one")]]):
        paths = suppliers.SupplierPaths(*[str(tmp_path / f"{n}{turn}") for n in ("records", "dead", "chk")])
        suppliers.supplier_sink(paths, 2)(spark.createDataFrame(rows, "seq bigint, partition int, value string"), 0)
        assert [r.supplier_name for r in spark.read.parquet(paths.records).collect()] == ["two"]


def test_incremental_roll_up(spark):
    deltas = spark.sql("""SELECT * FROM VALUES (1, 1, 2.0D, 1L, TIMESTAMP_NTZ '2024-01-01', TIMESTAMP_NTZ '2024-01-02', 1L),
        (1, 1, 3.0D, 2L, TIMESTAMP_NTZ '2024-01-03', TIMESTAMP_NTZ '2024-01-04', 2L) AS
        t(user_id, item_id, score_delta, interaction_delta, window_start, window_end, batch_id)""")
    empty = preference.roll_up(deltas.limit(0))
    first = preference.incremental_roll_up(empty, preference.batch_range(deltas, 0, 1), 0)
    second = preference.incremental_roll_up(first.matrix, deltas, first.upper_bound_id)
    row = second.matrix.first()
    assert (row.preference_score, row.interaction_count, row.last_window_start, row.last_window_end) == (
        5.0, 3, datetime(2024, 1, 1), datetime(2024, 1, 4))
    again = preference.incremental_roll_up(second.matrix, deltas, second.upper_bound_id)
    assert not again.executed and again.matrix is second.matrix


def test_sheet_and_key_values(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,name,,status\n1001,ACME,x,ACTIVE\n\n1002,B\n")
    rows = [tuple(r)[1:] for r in readers.read_sheet(spark, str(tmp_path / "s.csv")).orderBy("line_no").collect()]
    assert rows == [("1001", "ACME", "x", "ACTIVE"), ("1002", "B", "", "")]
    assert readers.read_sheet(spark, str(tmp_path / "s.csv"), max_rows=1).columns[1:] == ["id", "name", "column_2", "status"]
    dump = spark.createDataFrame([("a:1", "string", "t", None, None), ("a:2", "list", None, None, ["x"] * 150),
                                  ("b?1", "hash", None, {"k": "v"}, None), ("b:1", "stream", None, None, None)],
                                 "key string, type string, text string, fields map<string,string>, items array<string>")
    got = {r.key: r.value for r in readers.key_value_dump(dump).collect()}
    assert got["a:1"] == "t" and len(json.loads(got["a:2"])) == 150 and got["b?1"] == '{"k":"v"}'
    assert got["b:1"] == "(unsupported type: stream)"
    assert [r.key for r in readers.key_value_dump(dump, "a:[2-9]").collect()] == ["a:2"]
    assert readers.key_value_dump(dump, "b?1").count() == 2


def test_describe_tables(spark):
    spark.range(3).createOrReplaceTempView("described")
    rows = [r for r in readers.describe_tables(spark).collect() if r.table_name == "described"]
    assert [(r.column_name, r.data_type, len(r.sample_rows)) for r in rows] == [("id", "bigint", 2)]


def test_dead_letter_headers(spark):
    letters = spark.createDataFrame([("p", "t", "r")], "payload string, original_topic string, error_reason string")
    row = sinks.dead_letter_messages(letters).first()
    assert [(h.key, bytes(h.value)) for h in row.headers] == [("x-original-topic", b"t"), ("x-error-reason", b"r")]
