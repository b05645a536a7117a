"""Scheduling state, audit reports and outcome bookkeeping of supplier pulls."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from recoflow.functions.codes import backoff_seconds
from recoflow.operators.events import moment
from recoflow.operators.skew import pick_row

RETRY_LIMIT = 5
BATCH_SIZE = 50
BACKOFF_BASE, BACKOFF_CAP = 30, 3600
P99 = 0.99
RANGE_BITS = [20, 10, 0]


def is_due(now: datetime) -> Column:
    """Active, time has come, and no running lease."""
    lease = F.col("lease_until")
    return (
        (F.col("status") == "ACTIVE") & (F.col("next_pull_at") <= moment(now))
        & (lease.isNull() | (lease <= moment(now)))
    )


def due_connections(connections: DataFrame, now: datetime, limit: int | None = BATCH_SIZE) -> DataFrame:
    """Connections to pull next: often failed ones last, then the longest due."""
    order = [F.when(F.col("retry_count") >= RETRY_LIMIT, 1).otherwise(0), F.col("next_pull_at"), F.col("supplier_id")]
    due = connections.filter(is_due(now)).orderBy(*order)
    return due if limit is None else due.limit(limit)


def _plus_seconds(at: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), at)


def apply_outcomes(connections: DataFrame, outcomes: DataFrame, base: int = BACKOFF_BASE, cap: int = BACKOFF_CAP,
                   max_jitter_ms: int = 0) -> DataFrame:
    """Connections after their pulls.

    ``outcomes`` has at most one row per connection: supplier_id, version, outcome (SUCCESS or an
    error kind), finished_at, next_cursor, retry_after. It applies only when the version still
    matches. Success resets the retries, a failure backs off (or waits until ``retry_after`` when
    rate limited), an authentication failure suspends the connection.
    """
    found = connections.join(
        outcomes.select("supplier_id", F.col("version").alias("_v"), "outcome", "finished_at", "next_cursor",
                        "retry_after"), "supplier_id", "left")
    applies = F.coalesce(F.col("version") == F.col("_v"), F.lit(False))
    active, kind, at = F.col("status") == "ACTIVE", F.col("outcome"), F.col("finished_at")
    success = applies & active & (kind == "SUCCESS")
    suspend = applies & (F.col("status") != "SUSPENDED") & (kind == "AUTH_FAILURE")
    failure = applies & active & ~kind.isin("SUCCESS", "AUTH_FAILURE")
    changed = success | suspend | failure
    delayed = _plus_seconds(at, backoff_seconds(F.col("retry_count"), base, cap))
    if max_jitter_ms > 0:
        jitter = F.pmod(F.xxhash64("supplier_id", "version"), F.lit(max_jitter_ms)).cast("int")
        delayed = F.timestamp_add("MILLISECOND", jitter, delayed)
    retry_at = F.when(kind == "RATE_LIMITED", F.coalesce("retry_after", delayed)).otherwise(delayed)
    none = F.lit(None)
    new = {
        "status": F.when(suspend, F.lit("SUSPENDED")).otherwise(F.col("status")),
        "next_pull_at": F.when(success, _plus_seconds(at, F.col("pull_interval_seconds")))
        .when(failure, retry_at).otherwise(F.col("next_pull_at")),
        "last_success_at": F.when(success, at).otherwise(F.col("last_success_at")),
        "last_error_at": F.when(failure | suspend, at).otherwise(F.col("last_error_at")),
        "last_cursor": F.when(success, F.col("next_cursor")).otherwise(F.col("last_cursor")),
        "retry_count": F.when(success, 0).when(failure, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
        "lease_until": F.when(changed, none).otherwise(F.col("lease_until")),
        "version": F.when(changed, F.col("version") + 1).otherwise(F.col("version")),
        "updated_at": F.when(changed, at).otherwise(F.col("updated_at")),
    }
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in connections.columns])


def task_key(supplier_id: Column, at: Column) -> Column:
    """Key of a pull task: one per supplier and minute."""
    return F.concat(supplier_id.cast("string"), F.lit("_"), F.date_format(at, "yyyyMMddHHmm"))


def dedup_tasks(tasks: DataFrame, time_column: str, sequence: str) -> DataFrame:
    """First task per supplier and minute."""
    keyed = tasks.withColumn("idempotency_key", task_key(F.col("supplier_id"), F.col(time_column)))
    return pick_row(keyed, ["idempotency_key"], F.col(sequence), newest=False)


def order_statistic(values: DataFrame, column: str, fraction: float, alias: str) -> DataFrame:
    """Element at index floor(n · fraction) of all sorted values, as a one-row table.

    Values are counted per distinct value, then the element is narrowed down: to a range of 2^20
    values, inside it to one of 2^10, inside that to the value. Only the totals of one level are
    ever accumulated in order: at most 1024 rows, and 2^20 on the first level for values below 2^40.
    """
    counts = values.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    all_rows = Window.partitionBy(F.lit(0))
    earlier = all_rows.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        counts.groupBy(F.shiftright("value", RANGE_BITS[0]).alias("range")).agg(F.sum("n").alias("n"))
        .withColumn("base", F.lit(0)).withColumn("target", F.floor(F.sum("n").over(all_rows) * F.lit(fraction)).cast("bigint"))
    )
    for bits, next_bits in zip(RANGE_BITS, [*RANGE_BITS[1:], None]):
        before = F.col("base") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
        found = (
            totals.withColumn("before", before)
            .filter((F.col("before") <= F.col("target")) & (F.col("target") < F.col("before") + F.col("n")))
            .select("range", F.col("before").alias("base"), "target")
        )
        if next_bits is not None:
            inside = counts.withColumn("range", F.shiftright("value", bits)).join(found, "range").drop("range")
            totals = inside.groupBy(F.shiftright("value", next_bits).alias("range"), "base", "target").agg(
                F.sum("n").alias("n"))
    return found.agg(F.max("range").alias(alias))


def pull_report(audit: DataFrame, duration_ms: int) -> DataFrame:
    """Totals of a run of ``duration_ms``: outcomes, latency (mean, maximum, 99th percentile), rate per second."""
    latency, kind = F.col("duration_ms"), F.col("outcome")
    ran = audit.filter(kind.isin("SUCCESS", "FAILURE", "SKIPPED_DUPLICATE"))
    totals = ran.agg(
        F.count(F.lit(1)).alias("executed"),
        F.count_if(kind == "SUCCESS").alias("success_count"),
        F.count_if(kind == "FAILURE").alias("failure_count"),
        F.count_if(kind == "SKIPPED_DUPLICATE").alias("skipped_count"),
        F.sum(latency).alias("_sum"),
        F.coalesce(F.max(latency), F.lit(0)).alias("max_latency_ms"),
    )
    p99 = order_statistic(ran, "duration_ms", P99, "_p99")
    rate = F.col("executed") * 1000.0 / duration_ms if duration_ms > 0 else F.lit(0.0)

    def one_place(value: Column) -> Column:
        return F.floor(value * 10.0 + 0.5) / 10.0

    # Both sides are global aggregates, hence single rows.
    return totals.withColumn("_p99", p99.scalar()).select(
        "executed", "success_count", "failure_count", "skipped_count",
        F.coalesce(one_place(F.col("_sum") / F.nullif(F.col("executed"), F.lit(0))), F.lit(0.0)).alias("avg_latency_ms"),
        "max_latency_ms", F.coalesce("_p99", F.lit(0)).alias("p99_latency_ms"),
        one_place(rate).alias("throughput_per_second"),
    )


def status_counts(connections: DataFrame) -> DataFrame:
    return connections.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "ACTIVE").alias("active"),
        F.count_if(F.col("status") == "SUSPENDED").alias("suspended"),
    )


def recent(table: DataFrame, time_column: str, id_column: str, limit: int) -> DataFrame:
    """Newest rows by time, then id."""
    return table.orderBy(F.desc(time_column), F.desc(id_column)).limit(limit)


def recent_per_key(table: DataFrame, key: str, time_column: str, id_column: str, limit: int) -> DataFrame:
    """Newest rows per key; each map task forwards at most ``limit`` rows of a key."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(time_column), F.desc(id_column)))
    return table.withColumn("_position", position).filter(F.col("_position") <= limit).drop("_position")
