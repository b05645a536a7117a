"""Logs of batches, marks with a time to live, and their streaming forms."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recoflow.operators import marks, windows
from recoflow.sources import readers
from recoflow.sources.merge_log import DELETED, MergeLog, Run, live_runs
from recoflow.streaming import behavior, orders as order_stream
from recoflow.streaming.marks import acquire_stream
from test_jobs import event, write_lines

ROW = "k string, day string, v long"


def stored(log, **options):
    frame = log.read(**options)
    return [] if frame is None else sorted(((r.k, r.day, r.v) for r in frame.collect()), key=repr)


def data_files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_runs_inside_a_merged_run_are_hidden():
    runs = [Run(1, 1, 0, ""), Run(2, 2, 0, ""), Run(1, 2, 1, ""), Run(3, 3, 0, ""), Run(0, 0, 0, "")]
    assert [r.name.lstrip("0") for r in live_runs(runs)] == [Run(0, 0, 0, "").name.lstrip("0"), Run(1, 2, 1, "").name.lstrip("0"), Run(3, 3, 0, "").name.lstrip("0")]


def test_log_keeps_the_newest_row_of_a_key(spark, tmp_path):
    log = MergeLog(spark, str(tmp_path / "log"), ["k", "day"], ["day"], fanout=2)
    assert log.read() is None and log.last_batch() is None and log.compact() == 0
    expected = {}
    for batch in range(1, 8):
        rows = [(k, d, 10 * batch + i) for i, (k, d) in enumerate((("a", "1"), (None, "1"), (f"b{batch}", "2"), ("c", None)))][batch % 2:]
        gone = batch == 5
        for k, d, v in rows:
            expected[k, d] = None if gone and k == "a" else v
        log.append(spark.createDataFrame(rows, ROW).withColumn(DELETED, F.lit(gone) & (F.col("k") == "a")).fillna({DELETED: False}), batch)
        if batch in (3, 6):
            before = stored(log)
            assert log.compact() > 0 and stored(log) == before
    truth = sorted(((k, d, v) for (k, d), v in expected.items() if v is not None), key=repr)
    assert stored(log) == truth
    assert stored(log, where=F.col("day") == "2") == [r for r in truth if r[1] == "2"]
    assert log.last_batch() == 7
    # Batches that are merged or not written again change nothing.
    again = spark.createDataFrame([("a", "1", 999)], ROW)
    assert not log.append(again, 2) and stored(log) == truth
    hidden = log.hidden_runs()
    assert hidden and all((tmp_path / "log" / h).exists() for h in hidden)


def test_append_touches_no_earlier_file_and_filters_prune(spark, tmp_path):
    log = MergeLog(spark, str(tmp_path / "log"), ["k", "day"], ["day"], writers=3)
    for batch in (1, 2):
        log.append(spark.createDataFrame([(f"k{i}", str(batch), i) for i in range(50)], ROW), batch)
    before = data_files(tmp_path)
    # One hot day is written by several tasks, as long as adaptive execution does not find them too small.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    log.append(spark.createDataFrame([(f"k{i}", "2", i) for i in range(300)], ROW), 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    after = data_files(tmp_path)
    assert {p: after[p] for p in before} == before
    assert len([p for p in after if p not in before]) > 1
    read = {f.split("day=")[1][0] for f in log.read(F.col("day") == "2").inputFiles()}
    assert "2" in read
    plan = log.read(F.col("day") == "2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    # A replay replaces its own run only.
    log.append(spark.createDataFrame([(f"k{i}", "2", i) for i in range(300)], ROW), 3)
    kept = data_files(tmp_path)
    assert {p: kept[p] for p in before} == before and log.read().count() == 350


def test_a_new_checkpoint_goes_behind_the_old_one(spark, tmp_path):
    log = MergeLog(spark, str(tmp_path / "log"), ["k", "day"])
    assert log.first_batch_of("one") == 0
    for batch in range(3):
        log.append(spark.createDataFrame([("a", "1", batch)], ROW), batch)
    assert (log.first_batch_of("two"), log.first_batch_of("one"), log.first_batch_of("two")) == (3, 0, 3)


def test_behavior_streams_into_logs(spark, tmp_path):
    rows = [event(i, i * 7, user=i % 3 + 1, item=i % 5 + 1, kind=["VIEW", "CLICK", "PURCHASE", "RATE"][i % 4],
                  rating=3.5 if i % 4 == 3 else None) for i in range(200)]
    source, paths = tmp_path / "in", behavior.StreamPaths(*[str(tmp_path / n) for n in ("agg", "delta", "msg", "chk")])
    files = None
    for step in (range(0, 2), range(2, 4)):
        for part in step:
            write_lines(source / f"{part}.json", rows[part * 50:(part + 1) * 50])
        stream = readers.decode_events(readers.file_stream(spark, str(source), "value string", max_files=1))
        for query in behavior.start_behavior_queries(stream, paths, lambda m: None, available_now=True, log_storage=True):
            query.awaitTermination(120)
            assert query.exception() is None
        now = data_files(paths.aggregates)
        assert files is None or {p: now[p] for p in files} == files
        files = now
    batch = readers.decode_events(spark.read.schema("value string").json(str(source)))
    columns = ["window_start", "window_end", "user_id", "behavior_type", "event_count", "avg_rating"]
    log = behavior.aggregate_log(spark, paths.aggregates)
    truth = sorted(windows.behavior_aggregate(batch).select(columns).collect())
    assert sorted(log.read().select(columns).collect()) == truth
    log.fanout = 2
    assert log.compact() > 0 and sorted(log.read().select(columns).collect()) == truth
    deltas = behavior.delta_log(spark, paths.deltas).read()
    assert deltas.count() > 0 and deltas.agg(F.min("batch_id")).first()[0] >= 1


START = datetime(2024, 1, 1)


def messages(spark, rows):
    """(topic, id, day, partition, seq)"""
    return spark.createDataFrame([(t, i, None if d is None else START + timedelta(days=d), p, s) for t, i, d, p, s in rows],
                                 "topic string, event_id string, arrived timestamp, partition int, seq long")


def judged(rows, days, overrides):
    """Set-if-absent with an expiry, in the order of arrival."""
    ends, out = {}, {}
    for t, i, d, p, s in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[3], r[4])):
        if i is None or d is None:
            out[t, i, p, s] = "UNUSABLE"
        elif d < ends.get((t, i), -1):
            out[t, i, p, s] = "DUPLICATE"
        else:
            ends[t, i] = d + overrides.get(t, days)
            out[t, i, p, s] = "FIRST"
    return out


ROWS = [("a", "x", 0, 0, 1), ("a", "x", 6.9, 1, 1), ("a", "x", 7, 0, 2), ("a", "x", 13.9, 0, 3), ("b", "x", 0.5, 0, 4), ("b", "x", 2.4, 0, 5), ("b", "x", 2.5, 0, 6),
        (None, "x", 1, 0, 7), (None, "x", 2, 0, 8), ("a", None, 1, 0, 9), ("a", "y", None, 0, 10), ("a", "z", 3, 1, 11), ("a", "z", 3, 0, 11), ("a", "z", 3, 0, 11.5)]
ROWS = [(t, i, d, p, int(s * 2)) for t, i, d, p, s in ROWS]


def outcomes(frame):
    return {(r.topic, r.event_id, r.partition, r.seq): r.outcome for r in frame.collect()}


@pytest.mark.parametrize("max_rows", [1_000_000, 2])
def test_marks_live_as_long_as_their_topic_says(spark, max_rows):
    hot = [("a", "hot", i * 0.4, i % 3, i) for i in range(60)]
    frame = messages(spark, ROWS + hot)
    assert outcomes(marks.acquire(frame, 7, {"b": 2}, max_rows=max_rows)) == judged(ROWS + hot, 7, {"b": 2})


@pytest.mark.parametrize("cuts", [(3,), (1, 2, 6, 7), ()])
def test_stored_marks_give_what_one_batch_gives(spark, tmp_path, cuts):
    store = marks.MarkStore(spark, str(tmp_path / "m"), 7, {"b": 2}, buckets=8, fanout=2)
    got, bounds = {}, [-1, *cuts, 99]
    for batch, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = [r for r in ROWS if (low <= r[2] < high if r[2] is not None else batch == 0)]
        once = outcomes(store.acquire(messages(spark, part), batch))
        for _ in range(2):
            result = store.acquire(messages(spark, part), batch)
            assert outcomes(result) == once
            store.remember(result, batch)
        got.update(once)
        store.compact(F.lit((START + timedelta(days=max(low, 0))).date()))
    assert got == judged(ROWS, 7, {"b": 2})


def test_a_batch_reads_only_its_buckets_and_living_days(spark, tmp_path):
    store = marks.MarkStore(spark, str(tmp_path / "m"), 7, buckets=16)
    first = messages(spark, [("t", f"e{i}", i % 4, 0, i) for i in range(200)])
    store.remember(store.acquire(first, 0), 0)
    batch = messages(spark, [("t", "e5", 9, 0, 999)])
    seen = store.seen(batch, 1)
    plan = seen._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "PartitionFilters" in line]
    assert scans and all("bucket" in line and "expires" in line for line in scans)
    # Marks of days 0 and 1 end on days 7 and 8.
    assert {r.expires for r in seen.select("expires").distinct().collect()} <= {(START + timedelta(days=d)).date() for d in (9, 10)}
    bucket = batch.select(store._bucket()).first()[0]
    assert {r.bucket for r in seen.select("bucket").distinct().collect()} == {bucket}
    # A straggler from before its mark was set is a duplicate.
    late = messages(spark, [("t", "e3", 2, 0, 7)])
    assert list(outcomes(store.acquire(late, 1)).values()) == ["DUPLICATE"]
    # Merges forget marks that have ended.
    for i in range(1, 9):
        store.remember(store.acquire(messages(spark, [("t", f"n{i}", 20, 0, i)]), i), i)
    assert store.compact(F.lit((START + timedelta(days=12)).date())) == 1
    assert store.log.read().count() == 8


@pytest.mark.parametrize("files", [1, 3, 7])
def test_marks_in_a_stream(spark, tmp_path, files):
    rows = sorted([r for r in ROWS if r[1] is not None and r[2] is not None], key=lambda r: (r[2], r[3], r[4]))
    step = -(-len(rows) // files)
    for n in range(files):
        write_lines(tmp_path / "in" / f"{n}.json", [
            {"topic": t, "event_id": i, "arrived": (START + timedelta(days=d)).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "partition": p, "seq": s}
            for t, i, d, p, s in rows[n * step:(n + 1) * step]] or [{}])
    stream = readers.file_stream(spark, str(tmp_path / "in"), "topic string, event_id string, arrived timestamp, partition int, seq long", max_files=1)
    query = (acquire_stream(stream, 7, {"b": 2}).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start())
    query.awaitTermination(180)
    assert query.exception() is None
    assert outcomes(spark.read.parquet(str(tmp_path / "out"))) == judged(rows, 7, {"b": 2})


def order_message(seq, topic, event_id, day, amount, currency="USD"):
    at = None if day is None else (START + timedelta(days=day)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return {"seq": seq, "partition": 0, "topic": topic, "timestamp": at, "value": json.dumps({
        "eventId": event_id, "orderId": f"{topic}-{event_id}", "userId": 1, "status": "PAID", "amount": amount, "currency": currency,
        "occurredAt": "2024-01-01T00:00:00Z"})}


def test_order_stream_with_marks_that_end(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source / "1.json", [order_message(1, "t", "a", 0, 1), order_message(2, "t", "a", 1, 2), order_message(3, "u", "a", 0, 3)])
    write_lines(source / "2.json", [order_message(4, "t", "a", 1.5, 4), order_message(5, "t", "g", 1, 5, "GBP"),
                                    order_message(6, "t", "n", None, 6), order_message(7, "u", "a", 4, 7)])
    write_lines(source / "3.json", [order_message(8, "t", "a", 3, 8), order_message(9, "u", "a", 5, 9), order_message(10, "t", "g", 2, 10, "GBP")])
    schema = "seq bigint, partition int, topic string, timestamp timestamp, value string"
    messages = readers.file_stream(spark, str(source), schema, max_files=1)
    paths = order_stream.OrderPaths(*[str(tmp_path / n) for n in ("orders", "marks", "dead", "chk")])
    life = order_stream.MarkLife(2, {"u": 30}, buckets=4)

    def state():
        # The mark of t/a ends on day 2, so its copy of day 3 counts again; that of u/a lives for 30 days.
        kept = {r.order_id: float(r.amount) for r in spark.read.parquet(paths.orders).collect()}
        letters = sorted((r.seq, r.error_reason) for r in spark.read.parquet(paths.dead_letters).collect())
        return kept, letters

    expected = ({"t-a": 8.0, "u-a": 3.0}, [(5, "PERMANENT: unsupported currency GBP"), (6, "DESERIALIZE_FAIL: Arrival")])
    query = order_stream.start_order_stream(messages, paths, available_now=True, buckets=2, life=life)
    query.awaitTermination(180)
    assert query.exception() is None
    assert state() == expected
    # A replayed batch changes nothing; nor does the stream read again from a new checkpoint while all marks live.
    last = spark.read.schema(schema).json(str(source / "3.json"))
    order_stream.order_sink(paths, 2, life)(last, 2)
    assert state() == expected
    again = order_stream.OrderPaths(paths.orders, paths.marks, paths.dead_letters, str(tmp_path / "chk2"))
    order_stream.order_sink(again, 2, life)(last, 0)
    assert state() == expected
