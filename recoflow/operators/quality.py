"""Audits: rows that break an invariant, with the reasons."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from recoflow.functions.network import METADATA_ADDRESS, in_block, is_public
from recoflow.functions.text import is_blank
from recoflow.operators.scan import Fold, sequential_fold
from recoflow.operators.skew import MAX_ROWS_PER_KEY, as_number

# Request caps of connection tests (window in seconds; per address, target, both).
CAP_WINDOW_SECONDS = 300
CAP_PER_ADDRESS, CAP_PER_TARGET, CAP_PER_PAIR = 20, 10, 3

# What each payment status requires and forbids.
PAYMENT_REQUIRES = {
    "UNPAID": [], "PAYING": ["paying_started_at"],
    "SUCCESS": ["paying_started_at", "channel_trade_no", "paid_at"], "CLOSED": ["closed_at"],
}
PAYMENT_FORBIDS = {
    "UNPAID": ["channel_trade_no", "paid_at", "closed_at"], "PAYING": ["channel_trade_no", "paid_at", "closed_at"],
    "SUCCESS": ["closed_at"], "CLOSED": ["channel_trade_no", "paid_at"],
}


def _with_violations(rows: DataFrame, checks: Sequence[Column]) -> DataFrame:
    """Rows with at least one violation and the list of their names."""
    return rows.withColumn("violations", F.array_compact(F.array(*checks))).filter(F.size("violations") > 0)


def payment_violations(orders: DataFrame) -> DataFrame:
    """Payment orders whose fields do not fit their status."""
    status, checks = F.col("status"), []
    for name in ("order_no", "idempotency_key", "product_code"):
        checks.append(F.when(is_blank(F.col(name)), F.lit(f"{name} missing")))
    for name in ("user_id", "amount_fen"):
        checks.append(F.when(F.coalesce(F.col(name) <= 0, F.lit(True)), F.lit(f"{name} not positive")))
    checks.append(F.when(~F.coalesce(status.isin(list(PAYMENT_REQUIRES)), F.lit(False)), F.lit("unknown status")))
    for state, fields in PAYMENT_REQUIRES.items():
        for name in fields:
            absent = is_blank(F.col(name)) if name == "channel_trade_no" else F.col(name).isNull()
            checks.append(F.when((status == state) & absent, F.lit(f"{state} requires {name}")))
    for state, fields in PAYMENT_FORBIDS.items():
        for name in fields:
            checks.append(F.when((status == state) & F.col(name).isNotNull(), F.lit(f"{state} forbids {name}")))
    return _with_violations(orders, checks)


def reservation_violations(reservations: DataFrame) -> DataFrame:
    status = F.col("status")
    no_order = status.isin("ORDER_CREATED", "PAID") & is_blank(F.col("payment_order_no"))
    return _with_violations(reservations, [
        F.when(no_order, F.concat(status, F.lit(" requires payment_order_no"))),
        F.when((status == "RELEASED") & F.col("released_at").isNull(), F.lit("RELEASED requires released_at")),
    ])


def stock_violations(stock: DataFrame) -> DataFrame:
    """Stock rows with available + reserved + sold different from total, or a negative counter."""
    counters = [F.col(c) for c in ("available_stock", "reserved_stock", "sold_stock")]
    negative = (counters[0] < 0) | (counters[1] < 0) | (counters[2] < 0)
    return _with_violations(stock, [
        F.when(counters[0] + counters[1] + counters[2] != F.col("total_stock"), F.lit("total mismatch")),
        F.when(negative, F.lit("negative counter")),
    ])


def lease_violations(connections: DataFrame) -> DataFrame:
    """Connections that hold a lease without being active."""
    return connections.filter((F.col("status") != "ACTIVE") & F.col("lease_until").isNotNull())


def idempotency_conflicts(requests: DataFrame) -> DataFrame:
    """Order numbers that were used with more than one idempotency key."""
    return (
        requests.groupBy("order_no").agg(F.count_distinct("idempotency_key").alias("key_count"))
        .filter(F.col("key_count") > 1)
    )


def target_verdict(
    host: Column,
    address: Column,
    exact_hosts: Sequence[str] = (),
    suffixes: Sequence[str] = (),
    blocks: Sequence[str] = (),
    public_only: bool = True,
) -> Column:
    """ALLOWED or the reason why a connection target is refused; the allow-list goes first."""
    name = F.lower(host)
    listed = name.isin([h.lower() for h in exact_hosts]) if exact_hosts else F.lit(False)
    for suffix in suffixes:
        listed = listed | name.endswith(suffix.lower())
    for block in blocks:
        listed = listed | in_block(address, block)
    local = (name == "localhost") | name.endswith(".local")
    # The metadata address however it is written.
    metadata = in_block(address, f"{METADATA_ADDRESS}/32")
    private = ~is_public(address) if public_only else F.lit(False)
    return (
        F.when(listed, F.lit("ALLOWED")).when(local, F.lit("LOCAL_HOST"))
        .when(metadata, F.lit("METADATA_ADDRESS")).when(private, F.lit("NON_PUBLIC"))
        .otherwise(F.lit("ALLOWED"))
    )


def _cap_step(limit: int, window_us: int):
    def step(state: list[int], inputs: tuple) -> tuple[list[int], int]:
        (at,) = inputs
        if at is None:
            return state, 0
        kept = [t for t in state if t >= at - window_us]
        return (kept, 0) if len(kept) >= limit else (kept + [at], 1)

    return step


def request_cap(
    requests: DataFrame,
    keys: Sequence[str],
    limit: int,
    window: timedelta = timedelta(seconds=CAP_WINDOW_SECONDS),
    time_column: str = "at",
    sequence: str = "seq",
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Add ``accepted``: fewer than ``limit`` accepted requests of the key in the window before.

    Only accepted requests count, so this is a fold in time order; its state is the at most
    ``limit`` accepted times. Caps on different keys are independent of each other here, whereas an
    online guard that checks several keys in turn also charges the earlier ones for requests that a
    later one refuses. Requests without a time are refused and not counted.
    """
    at = as_number(time_column, requests.schema[time_column].dataType)
    fold = Fold(_cap_step(limit, int(window.total_seconds() * 1_000_000)), [at], F.array().cast("array<bigint>"))
    folded = sequential_fold(requests, list(keys), [time_column, sequence], fold, "_v", max_rows)
    return folded.withColumn("accepted", F.col("_v") == 1).drop("_v")
