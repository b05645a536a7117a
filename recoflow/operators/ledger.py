"""Payment orders, flash-sale reservations and stock counters as tables.

State changes are logs that get replayed: each request is a map over the states, and a prefix scan over composed maps
gives the state before each one. The state graphs have no cycles, so running aggregates of one order do the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from recoflow.operators.events import moment
from recoflow.operators.scan import Fold, sequential_fold
from recoflow.operators.skew import BLOCK, MAX_ROWS_PER_KEY, rank_within, with_blocks
from recoflow.session import cut_lineage


@dataclass(frozen=True)
class StateGraph:
    """Allowed changes (state, action) → state, repeats that are accepted silently, and the depth
    (most changes on any path)."""

    initial: str
    changes: dict[tuple[str, str], str]
    repeats: frozenset[tuple[str, str]]
    depth: int


# States and actions of payments and reservations.
PAYMENT = StateGraph(
    "UNPAID",
    {("UNPAID", "START"): "PAYING", ("PAYING", "SUCCESS"): "SUCCESS",
     ("UNPAID", "CLOSE"): "CLOSED", ("PAYING", "CLOSE"): "CLOSED"},
    frozenset({("PAYING", "START"), ("SUCCESS", "START"), ("SUCCESS", "SUCCESS"), ("CLOSED", "CLOSE")}),
    2,
)
RESERVATION = StateGraph(
    "RESERVED",
    {("RESERVED", "ORDER"): "ORDER_CREATED", ("ORDER_CREATED", "PAY"): "PAID",
     ("RESERVED", "CANCEL"): "CANCELLED", ("ORDER_CREATED", "CANCEL"): "CANCELLED",
     ("RESERVED", "EXPIRE"): "EXPIRED", ("ORDER_CREATED", "EXPIRE"): "EXPIRED",
     ("RESERVED", "RELEASE"): "RELEASED", ("ORDER_CREATED", "RELEASE"): "RELEASED",
     ("CANCELLED", "RELEASE"): "RELEASED", ("EXPIRED", "RELEASE"): "RELEASED"},
    frozenset(),
    3,
)


STATE_BITS = 4


def _states(graph: StateGraph) -> list[str]:
    """Names of the states by number; the initial one is 0."""
    return list(dict.fromkeys([graph.initial, *graph.changes.values()]))


def _maps(graph: StateGraph, action: Column) -> Column:
    """What a request does, as a map over states packed in a long: ``STATE_BITS`` for each state hold the one after it."""
    states = _states(graph)

    def packed(name: str | None) -> int:
        after = [graph.changes.get((state, name), state) for state in states]
        return sum(states.index(state) << (STATE_BITS * i) for i, state in enumerate(after))

    result = F.when(F.lit(False), F.lit(0))
    for name in dict.fromkeys(name for _, name in graph.changes):
        result = result.when(action == name, F.lit(packed(name)))
    return result.otherwise(F.lit(packed(None))).cast("bigint")


def _mapped(state: Column) -> Column:
    shifted = F.call_function("shiftright", F.col("_map"), (state * STATE_BITS).cast("int"))
    return shifted.bitwiseAND(F.lit((1 << STATE_BITS) - 1).cast("bigint"))


def _walk(rows: DataFrame, parts: Sequence[str], order: Sequence[str], entries: dict[str, Column], depth: int) -> DataFrame:
    """Columns ``name`` (state before the row) and ``name_step`` (changes before it) for each entry state.

    The graph has no cycles, so a key changes its state at most ``depth`` times. The j-th change is the first row after the
    one before that its map moves: a running aggregate. All of them use one partitioning and one order.
    """
    before = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for name, entry in entries.items():
        rows = rows.withColumn(f"{name}_0", entry.cast("bigint"))
    for level in range(depth):
        last = {name: F.col(f"{name}_{level}") for name in entries}
        rows = rows.withColumns({
            f"{name}_{level + 1}": F.first(F.when(_mapped(s) != s, _mapped(s)), ignorenulls=True).over(before)
            for name, s in last.items()})
    for name in entries:
        levels = [F.col(f"{name}_{level}") for level in range(depth, -1, -1)]
        steps = sum((s.isNotNull().cast("int") for s in levels[:-1]), F.lit(0))
        rows = rows.withColumns({name: F.coalesce(*levels), f"{name}_step": steps})
        rows = rows.drop(*[f"{name}_{level}" for level in range(depth + 1)])
    return rows


def _replayed(rows: DataFrame, key: str, order: Sequence[str], action: str, graph: StateGraph, max_rows: int) -> DataFrame:
    """``rows`` (non-null keys) with ``_before``, ``_before_step`` and ``_after``: a prefix scan over composed maps.

    Keys with more than ``max_rows`` requests are cut into blocks. A block is walked from every state at once, which
    composes its maps into one; the blocks of a key are then walked like requests and give each block its entry state.
    """
    blocked, cut = with_blocks(rows.withColumn("_map", _maps(graph, F.col(action))), [key], order[0], max_rows)
    parts, entry = [key, BLOCK], F.lit(0)
    if not cut:
        blocked, parts = blocked.drop(BLOCK), [key]
    else:
        count = len(_states(graph))
        sizes = blocked.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
        several = sizes.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)
        inside = _walk(blocked.join(several, key, "left_semi"), parts, order, {f"_s{i}": F.lit(i) for i in range(count)}, graph.depth)
        # A state's changes only grow along a block, so the largest (changes, state) is the one at its end.
        ends = inside.groupBy(*parts).agg(*[F.max(_progress(f"_s{i}")).alias(f"_s{i}") for i in range(count)])
        composed = sum((F.shiftleft(_state_of(F.col(f"_s{i}")), STATE_BITS * i) for i in range(count)), F.lit(0).cast("bigint"))
        blocks = _walk(ends.select(*parts, composed.alias("_map")), [key], [BLOCK], {"_entry": F.lit(0)}, graph.depth)
        blocked = blocked.join(cut_lineage(blocks.select(*parts, "_entry")), parts, "left")
        entry = F.coalesce("_entry", F.lit(0))
    walked = _walk(blocked, parts, order, {"_before": entry}, graph.depth)
    return walked.withColumn("_after", _mapped(F.col("_before"))).drop(BLOCK, "_entry")


def _progress(name: str) -> Column:
    """Changes up to and with this row, then the state after it, as one number that never falls along a key."""
    state, after = F.col(name), _mapped(F.col(name))
    return (F.col(f"{name}_step") + (after != state).cast("int")).cast("bigint") * (1 << STATE_BITS) + after


def _state_of(progress: Column) -> Column:
    return progress.bitwiseAND(F.lit((1 << STATE_BITS) - 1).cast("bigint"))


def _named(graph: StateGraph, state: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in _states(graph)]), state.cast("int"))


def _verdict(graph: StateGraph, action: str) -> Column:
    """Verdict of a request from the state before it."""
    repeated = F.lit(False)
    for state, name in graph.repeats:
        repeated = repeated | ((F.col("_before") == _states(graph).index(state)) & (F.col(action) == name))
    return (F.when(F.col("_after") != F.col("_before"), F.lit("APPLIED")).when(repeated, F.lit("REPEAT"))
            .otherwise(F.lit("REJECTED")))


def replay_log(log: DataFrame, key: str, order: Sequence[str], action: str, graph: StateGraph,
               max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Add ``state_before`` and ``verdict`` (APPLIED, REPEAT, REJECTED) to every request.

    ``order`` must identify a request within its key. A request without a key meets the initial state; one without an
    action, or with an unknown one, is rejected.
    """
    keyed = _replayed(log.filter(F.col(key).isNotNull()), key, order, action, graph, max_rows)
    lone = log.filter(F.col(key).isNull()).withColumn("_map", _maps(graph, F.col(action))).withColumn("_before", F.lit(0).cast("bigint"))
    rows = keyed.unionByName(lone.withColumn("_after", _mapped(F.col("_before"))), allowMissingColumns=True)
    return rows.select(*log.columns, _named(graph, F.col("_before")).alias("state_before"), _verdict(graph, action).alias("verdict"))


def replay_summary(log: DataFrame, key: str, order: Sequence[str], action: str, graph: StateGraph,
                   max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Final state and verdict counts per key; requests without a key are left out."""
    rows = log.select(key, *order, action).filter(F.col(key).isNotNull())
    walked = _replayed(rows, key, order, action, graph, max_rows).select(
        key, _progress("_before").alias("_progress"), _verdict(graph, action).alias("verdict"))
    summed = walked.groupBy(key).agg(
        F.max("_progress").alias("_progress"),
        F.count_if(F.col("verdict") == "APPLIED").alias("applied"),
        F.count_if(F.col("verdict") == "REPEAT").alias("repeated"),
        F.count_if(F.col("verdict") == "REJECTED").alias("rejected"),
    )
    return summed.select(key, _named(graph, _state_of(F.col("_progress"))).alias("final_state"), "applied", "repeated", "rejected")


# What a reservation's changes do to the stock it holds.
RESERVATION_MOVES = {"PAID": "CONFIRM", "RELEASED": "RELEASE"}


def linked_moves(log: DataFrame, key: str, order: Sequence[str], action: str, graph: StateGraph,
                 moves: dict[str, str] | None = None, done: DataFrame | None = None,
                 max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Stock movements caused by the changes of another state machine: the columns of ``log``, ``move`` and ``move_id``.

    Only a change that took effect moves stock, and a state is entered at most once, so ``move_id`` (key and move) names
    a movement for good: a reservation that is released again, or whose log arrives again, returns its stock once. With
    ``done`` (``move_id``) the movements already booked are left out. Requests without a key move nothing.
    """
    rows = _replayed(log.filter(F.col(key).isNotNull()), key, order, action, graph, max_rows)
    entered = _named(graph, F.col("_after"))
    move = F.coalesce(*[F.when(entered == state, F.lit(name)) for state, name in (moves or RESERVATION_MOVES).items()])
    booked = (
        rows.filter(F.col("_after") != F.col("_before")).select(*log.columns, move.alias("move"))
        .filter(F.col("move").isNotNull()).withColumn("move_id", F.concat_ws(":", F.col(key).cast("string"), "move"))
    )
    # A few rows per key; a replay of the stock reads them several times and must not walk the log again.
    return cut_lineage(booked if done is None else booked.join(done.select("move_id"), "move_id", "left_anti"))


def conditional_transition(orders: DataFrame, requests: DataFrame, expected: str, target: str) -> DataFrame:
    """``update … where status = expected``: move the requested orders that are in the expected state.

    ``requests`` has order_no and updated_at, one row per order.
    """
    asked = requests.select("order_no", F.col("updated_at").alias("_at"))
    joined = orders.join(asked, "order_no", "left")
    moves = F.col("_at").isNotNull() & (F.col("status") == expected)
    new = {"status": F.when(moves, F.lit(target)).otherwise(F.col("status")),
           "updated_at": F.when(moves, F.col("_at")).otherwise(F.col("updated_at"))}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in orders.columns])


def first_creates(requests: DataFrame, sequence: str = "seq") -> DataFrame:
    """First request per order number with the fate of the later ones.

    A later request with the same idempotency key gets the stored order back, another key is
    refused. Requests are first reduced to one row per order and key, then to one per order.
    """
    rest = [c for c in requests.columns if c not in ("order_no", "idempotency_key")]
    per_key = requests.groupBy("order_no", "idempotency_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*rest), F.col(sequence)).alias("_row"))
    first = F.struct("idempotency_key", "_row", "_n")
    per_order = per_key.groupBy("order_no").agg(
        F.min_by(first, F.col(f"_row.{sequence}")).alias("_first"), F.sum("_n").alias("_all"))
    return per_order.select(
        "order_no", "_first.idempotency_key", *[F.col(f"_first._row.{c}").alias(c) for c in rest],
        (F.col("_first._n") - 1).alias("returned"), (F.col("_all") - F.col("_first._n")).alias("refused"),
    )


def flash_sale_admission(requests: DataFrame, stock: DataFrame, max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Outcome of each reserve request: ACTIVITY_CLOSED, DUPLICATE_USER, SOLD_OUT or RESERVED.

    ``requests`` has activity_id, sku_id, user_id, seq; ``stock`` has sku_id, total_stock. Without
    releases the first request of each user competes in arrival order for the stock of its sku, and
    only admitted users are duplicates later.
    """
    user = ["activity_id", "sku_id", "user_id"]
    firsts = requests.groupBy(*user).agg(F.min("seq").alias("seq")).join(stock.select("sku_id", "total_stock"), "sku_id")
    admitted = rank_within(firsts, ["sku_id"], "seq", "_position", limit=F.col("total_stock"), max_rows=max_rows)
    # Joined on user *and* sku, so the crowd around one sku spreads over its users.
    outcomes = (
        requests.join(admitted.select(*user, F.col("seq").alias("_seq")), user, "left")
        .join(stock.select("sku_id", F.lit(True).alias("_open")), "sku_id", "left")
    )
    outcome = (
        F.when(F.col("_open").isNull(), F.lit("ACTIVITY_CLOSED")).when(F.col("_seq").isNull(), F.lit("SOLD_OUT"))
        .when(F.col("seq") == F.col("_seq"), F.lit("RESERVED"))
        .when(F.col("seq") > F.col("_seq"), F.lit("DUPLICATE_USER"))
    )
    return outcomes.withColumn("outcome", outcome).select(*requests.columns, "outcome")


# Stock movements.
STOCK_MOVES = {"RESERVE": 1, "CONFIRM": 2, "RELEASE": 3}


def _stock_step(state: list[int], inputs: tuple) -> tuple[list[int], int]:
    """Counters are available, reserved, sold, applied moves; a guard refuses moves from an empty counter."""
    available, reserved, sold, version = state
    (move,) = inputs
    if move == 1 and available > 0:
        return [available - 1, reserved + 1, sold, version + 1], 1
    if move == 2 and reserved > 0:
        return [available, reserved - 1, sold + 1, version + 1], 1
    if move == 3 and reserved > 0:
        return [available + 1, reserved - 1, sold, version + 1], 1
    return state, 0


def stock_verdicts(moves: DataFrame, stock: DataFrame, order: Sequence[str] = ("seq",),
                   max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Add ``applied`` to each movement (sku_id, seq, move) of the skus in ``stock``."""
    opening = stock.select("sku_id", "available_stock", "reserved_stock", "sold_stock")
    rows = moves.join(opening, "sku_id")
    code = F.coalesce(*[F.when(F.col("move") == name, F.lit(number)) for name, number in STOCK_MOVES.items()], F.lit(0))
    initial = F.array(*[F.col(c).cast("bigint") for c in ("available_stock", "reserved_stock", "sold_stock")],
                      F.lit(0).cast("bigint"))
    folded = sequential_fold(rows, ["sku_id"], order, Fold(_stock_step, [code], initial, additive=4), "_v", max_rows)
    return folded.select(*moves.columns, (F.col("_v") == 1).alias("applied"))


def replay_stock(moves: DataFrame, stock: DataFrame, order: Sequence[str] = ("seq",),
                 max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Stock rows after a movement log: reserve, confirm and release never take a counter below zero."""
    applied = F.col("applied")

    def total(name: str) -> Column:
        return F.count_if(applied & (F.col("move") == name))

    sums = stock_verdicts(moves, stock, order, max_rows).groupBy("sku_id").agg(
        total("RESERVE").alias("_r"), total("CONFIRM").alias("_c"), total("RELEASE").alias("_l"),
        F.count_if(~applied).alias("refused"))
    joined = stock.join(sums, "sku_id", "left").fillna(0, ["_r", "_c", "_l", "refused"])
    return joined.select(
        "sku_id", "total_stock",
        (F.col("available_stock") - F.col("_r") + F.col("_l")).alias("available_stock"),
        (F.col("reserved_stock") + F.col("_r") - F.col("_c") - F.col("_l")).alias("reserved_stock"),
        (F.col("sold_stock") + F.col("_c")).alias("sold_stock"),
        (F.col("version") + F.col("_r") + F.col("_c") + F.col("_l")).alias("version"), "refused",
    )


def stuck_payments(orders: DataFrame, deadline: datetime, limit: int | None = None) -> DataFrame:
    """Payments that started before the deadline and never finished, oldest first."""
    stuck = orders.filter((F.col("status") == "PAYING") & (F.col("paying_started_at") < moment(deadline)))
    ordered = stuck.orderBy("paying_started_at", "order_no")
    return ordered if limit is None else ordered.limit(limit)
