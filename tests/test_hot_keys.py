"""Keyed operations on hot keys: cut into small blocks, they give what a plain loop gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recoflow.operators import events, ledger, merge, quality, skew

START = datetime(2024, 1, 1)


def _skewed(seed, n, keys=4):
    """Key of each row: key 0 holds more than half of them."""
    rng = random.Random(seed)
    return rng, [0 if rng.random() < 0.6 else rng.randrange(1, keys) for _ in range(n)]


@pytest.mark.parametrize("max_rows", [20, 1_000_000])
def test_running_maximum(spark, max_rows):
    rng, keys = _skewed(1, 300)
    rows = [(k, i * 3, rng.randrange(100)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, seq bigint, v int")
    got = {r.seq: r.m for r in skew.running_max_before(df, ["k"], "seq", F.col("v"), "m", max_rows).collect()}
    best = {}
    for k, seq, v in rows:
        assert got[seq] == best.get(k)
        best[k] = max(best.get(k, v), v)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("max_rows", [20, 1_000_000])
def test_rank_with_ties_and_limit(spark, max_rows, descending):
    rng, keys = _skewed(2, 300)
    rows = [(k, rng.randrange(50), i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, o bigint, id bigint")
    ranked = skew.rank_within(df, ["k"], "o", "p", F.col("k") * 10 + 17, ["id"], descending, max_rows)
    expected = set()
    for key in set(keys):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]), reverse=descending)
        expected |= {(*r, p) for p, r in enumerate(mine, 1) if p <= key * 10 + 17}
    assert {tuple(r) for r in ranked.select("k", "o", "id", "p").collect()} == expected


def test_pick_row(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, None), (2, 1, "c")], "k int, seq int, v string")
    assert sorted(map(tuple, skew.pick_row(df, ["k"], F.col("seq")).collect())) == [(1, 7, None), (2, 1, "c")]
    assert sorted(map(tuple, skew.pick_row(df, ["k"], F.col("seq"), newest=False).collect())) == [(1, 5, "a"), (2, 1, "c")]


@pytest.mark.parametrize("max_rows", [25, 1_000_000])
def test_dedup_within_gap(spark, max_rows):
    rng, keys = _skewed(3, 400)
    rows, at = [], START
    for i, k in enumerate(keys):
        at += timedelta(seconds=rng.choice([0, 1, 20, 100, 299, 300, 301]))
        rows.append((i, k, 1, "VIEW", None, at))
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, item_id bigint, behavior_type string, "
                                     "rating double, event_time timestamp_ntz")
    got = {r.event_id for r in events.dedup_within_gap(df, timedelta(minutes=5), max_rows=max_rows).collect()}
    kept, expected = {}, set()
    for i, k, *_, at in rows:
        if not any(t > at - timedelta(minutes=5) for t in kept.get(k, [])):
            kept.setdefault(k, []).append(at)
            expected.add(i)
    assert got == expected


@pytest.mark.parametrize("max_rows", [25, 1_000_000])
def test_request_cap(spark, max_rows):
    rng, keys = _skewed(4, 400)
    rows, at = [], START
    for i, k in enumerate(keys):
        at += timedelta(seconds=rng.choice([0, 1, 10, 60, 150]))
        rows.append((i, f"c{k}", at))
    df = spark.createDataFrame(rows, "seq bigint, client string, at timestamp_ntz")
    got = {r.seq: r.accepted for r in quality.request_cap(df, ["client"], 3, max_rows=max_rows).collect()}
    taken = {}
    for i, c, at in rows:
        live = [t for t in taken.get(c, []) if t >= at - timedelta(seconds=300)]
        accepted = len(live) < 3
        taken[c] = live + [at] if accepted else live
        assert got[i] == accepted, i


@pytest.mark.parametrize("total", [3, 40])
@pytest.mark.parametrize("max_rows", [40, 1_000_000])
def test_stock_replay(spark, max_rows, total):
    """A small stock makes the guards fire often, a large one seldom."""
    rng, keys = _skewed(5, 500)
    rows = [(i, k, rng.choice(["RESERVE", "RESERVE", "CONFIRM", "RELEASE", "OTHER"])) for i, k in enumerate(keys)]
    moves = spark.createDataFrame(rows, "seq bigint, sku_id bigint, move string")
    stock = spark.createDataFrame([(k, total, total, 0, 0, 7) for k in range(5)],
                                  "sku_id bigint, total_stock bigint, available_stock bigint, reserved_stock bigint, "
                                  "sold_stock bigint, version bigint")
    got = {r.sku_id: tuple(r)[2:] for r in ledger.replay_stock(moves, stock, max_rows=max_rows).collect()}
    state = {k: [total, 0, 0, 7, 0] for k in range(5)}
    for _, k, move in rows:
        s = state[k]
        if move == "RESERVE" and s[0] > 0:
            s[0], s[1], s[3] = s[0] - 1, s[1] + 1, s[3] + 1
        elif move == "CONFIRM" and s[1] > 0:
            s[1], s[2], s[3] = s[1] - 1, s[2] + 1, s[3] + 1
        elif move == "RELEASE" and s[1] > 0:
            s[0], s[1], s[3] = s[0] + 1, s[1] - 1, s[3] + 1
        else:
            s[4] += 1
    assert got == {k: tuple(s) for k, s in state.items()}


@pytest.mark.parametrize("max_rows", [6, 1_000_000])
def test_flash_sale(spark, max_rows):
    rng, keys = _skewed(6, 300)
    rows = [(i, 1, k, rng.randrange(40)) for i, k in enumerate(keys)]
    requests = spark.createDataFrame(rows, "seq bigint, activity_id int, sku_id bigint, user_id bigint")
    stock = spark.createDataFrame([(0, 12), (1, 3), (2, 0)], "sku_id bigint, total_stock bigint")
    got = {r.seq: r.outcome for r in ledger.flash_sale_admission(requests, stock, max_rows).collect()}
    left, admitted = {0: 12, 1: 3, 2: 0}, set()
    for seq, _, sku, user in rows:
        if sku not in left:
            expected = "ACTIVITY_CLOSED"
        elif (sku, user) in admitted:
            expected = "DUPLICATE_USER"
        elif left[sku] <= 0:
            expected = "SOLD_OUT"
        else:
            expected, left[sku] = "RESERVED", left[sku] - 1
            admitted.add((sku, user))
        assert got[seq] == expected, seq


@pytest.mark.parametrize("max_rows", [6, 1_000_000])
def test_write_outcomes(spark, max_rows):
    rng, keys = _skewed(7, 200)
    rows = [(k, i, START + timedelta(hours=rng.randrange(30))) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, seq bigint, pulled_at timestamp_ntz")
    stored = spark.createDataFrame([(1, START + timedelta(hours=15))], "k int, pulled_at timestamp_ntz")
    got = {r.seq: r.outcome for r in merge.write_outcomes(df, ["k"], "pulled_at", "seq", stored, max_rows).collect()}
    newest = {1: START + timedelta(hours=15)}
    for k, seq, at in rows:
        stale = k in newest and newest[k] > at
        assert got[seq] == ("STALE_SKIPPED" if stale else "UPSERTED")
        newest[k] = max(newest.get(k, at), at)


@pytest.mark.parametrize("max_rows", [6, 1_000_000])
def test_bounded_history(spark, max_rows):
    _, keys = _skewed(8, 250)
    rows = [(i, k, START + timedelta(seconds=i)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "event_id bigint, user_id int, event_time timestamp_ntz")
    got = {r.event_id for r in events.bounded_history(df, 50, 10, max_rows).collect()}
    history = {}
    for i, k, _ in rows:
        mine = history.setdefault(k, [])
        mine.append(i)
        if len(mine) > 50:
            del mine[:10]
    assert got == {i for mine in history.values() for i in mine}


@pytest.mark.parametrize("descending", [False, True])
def test_blocks_are_even_and_ordered_despite_outliers(spark, descending):
    rows = [(1, 0)] + [(1, 10**15 + i * i) for i in range(1999)] + [(2, 5)]
    df = spark.createDataFrame(rows, "k int, o bigint")
    blocked, cut = skew.with_blocks(df, ["k"], "o", 50, descending)
    got = sorted((r.o, r[skew.BLOCK]) for r in blocked.filter("k = 1").collect())
    blocks = [block for _, block in (reversed(got) if descending else got)]
    assert cut and blocks == sorted(blocks)
    assert max(blocks.count(b) for b in set(blocks)) <= 100


@pytest.mark.parametrize("max_rows", [5, 60, 1_000_000])
def test_long_chains_of_gaps(spark, max_rows):
    rng = random.Random(11)
    rows, at = [], START
    for i in range(500):
        # One chain of hundreds of events, repeated times, a null key and null ids among them.
        at += timedelta(seconds=rng.choice([0, 0, 40, 90, 130]))
        rows.append((None if i % 50 == 7 else i, rng.choice([None, 1, 1, 1, 2]), 1, "VIEW", None, None if i % 90 == 3 else at))
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, item_id bigint, behavior_type string, "
                                     "rating double, event_time timestamp_ntz")
    result = events.dedup_within_gap(df, timedelta(minutes=5), max_rows=max_rows)
    last, expected = {}, []
    for row in sorted((r for r in rows if r[5] is not None), key=lambda r: (r[5], r[0] is not None, r[0] or 0)):
        if row[1] not in last or row[5] - last[row[1]] >= timedelta(minutes=5):
            last[row[1]] = row[5]
            expected.append(row)
    assert sorted(map(repr, map(tuple, result.collect()))) == sorted(map(repr, expected))
    assert "Python" not in result._jdf.queryExecution().toString() and "InArrow" not in result._jdf.queryExecution().toString()
    assert events.dedup_within_gap(df, timedelta(0), max_rows=max_rows).count() == sum(r[5] is not None for r in rows)
