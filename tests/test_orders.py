"""Order ETL and ledgers against plain loops and golden cases."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recoflow.operators import ledger, orders, quality

NOW = datetime(2024, 1, 31)


def message(seq, event="e1", order="O1", amount=99.5, currency="USD", status="PAID", **extra):
    body = {"eventId": event, "orderId": order, "userId": 1001, "status": status, "amount": amount,
            "currency": currency, "occurredAt": 1767225600.5, **extra}
    return seq, "t", json.dumps(body)


def batch(spark, *messages):
    return spark.createDataFrame(list(messages), "seq bigint, topic string, value string")


def outcomes(spark, *messages):
    rows = orders.classify(orders.decode_orders(batch(spark, *messages))).orderBy("seq").collect()
    return [(r.outcome, r.reason) for r in rows]


def test_distinct_events_tell_the_same_as_all_rows(spark):
    rows = [message(1), message(2), (3, "t", "junk"), (4, "t", "junk"), message(5, "e2", currency="GBP"),
            message(6, "e2", currency="GBP"), message(7, "old"), message(8, "old"), message(9, "e3")]
    seen = spark.createDataFrame([("t", "old")], "topic string, event_id string")
    decoded = orders.decode_orders(batch(spark, *rows))
    every = orders.classify(decoded, seen).groupBy("outcome").count().collect()
    firsts = orders.first_events(decoded, seen)
    assert sorted(map(tuple, every)) == sorted(map(tuple, orders.outcome_counts(firsts).collect()))
    assert {r.seq for r in orders.order_dead_letters(firsts).collect()} == {3, 4, 5}
    assert {r.event_id for r in orders.new_marks(firsts).collect()} == {"e1", "e2", "e3"}


def test_five_copies_are_loaded_once(spark):
    copies = [message(i, event={"value": "evt-1"}) for i in range(5)]
    assert [o for o, _ in outcomes(spark, *copies)] == ["PROCESSED"] + ["DUPLICATE"] * 4
    result = orders.order_etl(batch(spark, *copies), NOW)
    row = result.orders.first()
    assert (str(row.amount_cny), row.occurred_at) == ("716.40", datetime(2026, 1, 1, 0, 0, 0, 500000))
    assert result.marks.count() == 1


def test_last_arrival_wins(spark):
    rows = [message(1, "a", amount=1), message(2, "b", amount=3), message(3, "c", order="O2", amount=2)]
    loaded = orders.order_etl(batch(spark, *rows), NOW).orders.orderBy("order_id").collect()
    assert [(r.order_id, float(r.amount)) for r in loaded] == [("O1", 3.0), ("O2", 2.0)]


def test_dead_letters(spark):
    found = outcomes(
        spark, (1, "t", "no json"), message(2, amount=-1), message(3, currency="GBP"), message(4, currency="GBP"),
        message(5, event=" "), message(6, event="x" * 65), message(7, status="LOST"), message(8, event=None))
    assert found == [
        ("DEAD_LETTER", "DESERIALIZE_FAIL: MissingField"), ("DEAD_LETTER", "DESERIALIZE_FAIL: NegativeAmount"),
        ("DEAD_LETTER", "PERMANENT: unsupported currency GBP"), ("DUPLICATE", None),
        ("DEAD_LETTER", "DESERIALIZE_FAIL: EventId"), ("DEAD_LETTER", "DESERIALIZE_FAIL: EventId"),
        ("DEAD_LETTER", "DESERIALIZE_FAIL: Status"), ("DEAD_LETTER", "DESERIALIZE_FAIL: MissingField")]


def test_marks_of_earlier_batches(spark):
    seen = spark.createDataFrame([("t", "e1")], "topic string, event_id string")
    decoded = orders.decode_orders(batch(spark, message(1), message(2, "e2")))
    assert sorted(r.outcome for r in orders.classify(decoded, seen).collect()) == ["DUPLICATE", "PROCESSED"]


def test_the_topic_is_part_of_the_mark(spark):
    one = message(1)
    assert [o for o, _ in outcomes(spark, one, (2, "other", one[2]))] == ["PROCESSED", "PROCESSED"]


@pytest.mark.parametrize("graph, actions", [
    (ledger.PAYMENT, ["START", "SUCCESS", "CLOSE", "OTHER"]),
    (ledger.RESERVATION, ["ORDER", "PAY", "CANCEL", "EXPIRE", "RELEASE"])])
@pytest.mark.parametrize("max_rows", [9, 1_000_000])
def test_replay_equals_a_loop(spark, graph, actions, max_rows):
    """Key 0 holds a third of the rows; its blocks are walked apart when few rows are allowed."""
    rng = random.Random(9)
    rows = [(0 if rng.random() < 0.3 else rng.randrange(60), i, rng.choice(actions)) for i in range(500)]
    log = spark.createDataFrame(rows, "k int, seq bigint, action string")
    got = {r.seq: (r.state_before, r.verdict) for r in ledger.replay_log(log, "k", ["seq"], "action", graph, max_rows).collect()}
    finals = {r.k: r.final_state for r in ledger.replay_summary(log, "k", ["seq"], "action", graph, max_rows).collect()}
    state = {}
    for k, seq, action in rows:
        now = state.get(k, graph.initial)
        target = graph.changes.get((now, action))
        verdict = "APPLIED" if target else "REPEAT" if (now, action) in graph.repeats else "REJECTED"
        assert got[seq] == (now, verdict)
        state[k] = target or now
    assert finals == state


def test_late_changes_cross_blocks(spark):
    """The only applicable requests of a key lie in its first and last block."""
    idle = [(1, i, "SUCCESS") for i in range(1, 60)]
    log = spark.createDataFrame([(1, 0, "CLOSE"), *idle, (1, 60, "CLOSE"), (2, 5, "START")], "k int, seq bigint, action string")
    got = ledger.replay_summary(log, "k", ["seq"], "action", ledger.PAYMENT, 10).collect()
    assert sorted(map(tuple, got)) == [(1, "CLOSED", 1, 1, 59), (2, "PAYING", 1, 0, 0)]


def test_requests_without_key_or_action(spark):
    log = spark.createDataFrame([(None, 1, "START"), (None, 2, "SUCCESS"), (1, 3, None)], "k int, seq bigint, action string")
    got = {r.seq: (r.state_before, r.verdict) for r in ledger.replay_log(log, "k", ["seq"], "action", ledger.PAYMENT).collect()}
    assert got == {1: ("UNPAID", "APPLIED"), 2: ("UNPAID", "REJECTED"), 3: ("UNPAID", "REJECTED")}
    assert [tuple(r) for r in ledger.replay_summary(log, "k", ["seq"], "action", ledger.PAYMENT).collect()] == [(1, "UNPAID", 0, 0, 1)]
    assert ledger.replay_summary(log.limit(0), "k", ["seq"], "action", ledger.PAYMENT).count() == 0


def test_replay_needs_one_exchange(spark):
    log = spark.range(100).selectExpr("id % 7 AS k", "id AS seq", "'START' AS action")
    plan = ledger.replay_summary(log, "k", ["seq"], "action", ledger.PAYMENT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_release_returns_stock_once(spark):
    rows = [(1, 1, "CANCEL"), (1, 2, "RELEASE"), (1, 3, "RELEASE"), (2, 4, "ORDER"), (2, 5, "PAY"), (2, 6, "RELEASE"),
            (3, 7, "EXPIRE"), (None, 8, "RELEASE"), (4, 9, "RELEASE")]
    log = spark.createDataFrame(rows, "k int, seq bigint, action string")
    arguments = ("k", ["seq"], "action", ledger.RESERVATION)
    moves = ledger.linked_moves(log, *arguments)
    assert sorted((r.seq, r.move, r.move_id) for r in moves.collect()) == [
        (2, "RELEASE", "1:RELEASE"), (5, "CONFIRM", "2:CONFIRM"), (9, "RELEASE", "4:RELEASE")]
    later = spark.createDataFrame([*rows, (3, 10, "RELEASE"), (1, 11, "RELEASE")], log.schema)
    assert [r.move_id for r in ledger.linked_moves(later, *arguments, done=moves.select("move_id")).collect()] == ["3:RELEASE"]
    stock = spark.createDataFrame([(7, 10, 6, 4, 0, 0)], "sku_id int, total_stock bigint, available_stock bigint, "
                                                         "reserved_stock bigint, sold_stock bigint, version bigint")
    after = ledger.replay_stock(moves.withColumn("sku_id", F.lit(7)), stock)
    assert [tuple(r) for r in after.collect()] == [(7, 10, 8, 1, 1, 3, 0)]
    assert quality.stock_violations(after).count() == 0


def test_first_create_wins(spark):
    rows = spark.createDataFrame(
        [(1, "k1", 5, "a"), (1, "k1", 7, "b"), (1, "k2", 6, "c"), (2, "k9", 1, "d"), (1, "k3", 9, "e")],
        "order_no int, idempotency_key string, seq bigint, v string")
    got = {r.order_no: (r.idempotency_key, r.v, r.returned, r.refused) for r in ledger.first_creates(rows).collect()}
    assert got == {1: ("k1", "a", 1, 2), 2: ("k9", "d", 0, 0)}
    assert [tuple(r) for r in quality.idempotency_conflicts(rows).collect()] == [(1, 3)]


def test_stock_identity(spark):
    rows = spark.createDataFrame([(1, 100, 97, 2, 1), (2, 100, 97, 2, 2), (3, 0, -1, 1, 0)],
                                 "sku_id int, total_stock int, available_stock int, reserved_stock int, sold_stock int")
    bad = {r.sku_id: r.violations for r in quality.stock_violations(rows).collect()}
    assert bad == {2: ["total mismatch"], 3: ["negative counter"]}
