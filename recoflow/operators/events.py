"""Checks, ranges, de-duplication and history limits of behaviour events.

Events have the columns event_id, user_id, item_id, behavior_type, rating, event_time.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from recoflow.functions.scoring import is_valid_rating, parsed_behavior_type
from recoflow.operators.skew import MAX_ROWS_PER_KEY, as_number, rank_within, running_max_before
from recoflow.session import cut_lineage

HISTORY_LIMIT, HISTORY_STEP = 10_000, 1_000


def moment(value: datetime) -> Column:
    """A point in time as a zone-less literal; it compares with either timestamp type."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def is_valid(now: datetime) -> Column:
    """Positive ids, a known type and a time that is not in the future."""
    return F.coalesce(
        (F.col("user_id") > 0)
        & (F.col("item_id") > 0)
        & parsed_behavior_type(F.col("behavior_type")).isNotNull()
        & (F.col("event_time") <= moment(now)),
        F.lit(False),
    )


def reject_reason(now: datetime) -> Column:
    """Why an event is refused; null for a good one."""
    return (
        F.when(F.col("user_id").isNull() | (F.col("user_id") <= 0), F.lit("USER_ID"))
        .when(F.col("item_id").isNull() | (F.col("item_id") <= 0), F.lit("ITEM_ID"))
        .when(parsed_behavior_type(F.col("behavior_type")).isNull(), F.lit("BEHAVIOR_TYPE"))
        .when(F.col("event_time").isNull(), F.lit("EVENT_TIME"))
        .when(F.col("event_time") > moment(now), F.lit("FUTURE"))
        .when(F.col("rating").isNotNull() & ~is_valid_rating(F.col("rating")), F.lit("RATING"))
    )


def valid_events(events: DataFrame, now: datetime) -> DataFrame:
    return events.filter(is_valid(now))


def in_time_range(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Events from start to end, both included."""
    return events.filter(F.col("event_time").between(moment(start), moment(end)))


def last_hours(events: DataFrame, now: datetime, hours: int) -> DataFrame:
    return in_time_range(events, now - timedelta(hours=hours), now)


def expired(events: DataFrame, now: datetime, valid_hours: int) -> DataFrame:
    """Events older than their validity."""
    return events.filter(F.col("event_time") < moment(now - timedelta(hours=valid_hours)))


#: Chains of up to so many times are walked as an array, longer ones by pointer doubling.
CHAIN = 1_000


def _walk(times: DataFrame, gap_us: int) -> DataFrame:
    """Kept times (``_key``, ``_at``) of short chains: the next one is the first that lies ``gap_us`` or more after the last."""
    chains = times.groupBy("_key", "_start").agg(F.sort_array(F.collect_list("_at")).alias("_times"))
    first = F.struct(F.col("_start").alias("last"), F.array().cast("array<bigint>").alias("kept"))

    def step(state: Column, at: Column) -> Column:
        taken = F.struct(at.alias("last"), F.concat(state["kept"], F.array(at)).alias("kept"))
        return F.when(at - state["last"] >= gap_us, taken).otherwise(state)

    return chains.select("_key", F.explode(F.aggregate("_times", first, step)["kept"]).alias("_at"))


def _double(times: DataFrame, gap_us: int, max_rows: int) -> DataFrame:
    """Kept times of long chains. Each time points to the first one ``gap_us`` or more after it; after k rounds the pointers
    go 2^k steps and the first 2^k times of each chain are reached.
    """
    place = ["_key", "_start", "_at"]
    points = times.select(*place).unionByName(times.select("_key", "_start", F.col("_start").alias("_at")).distinct())
    # Backwards in time, the probe of a time stands right after the times its pointer may go to.
    nothing = F.lit(None).cast("bigint")
    both = points.select("_key", "_start", nothing.alias("_at"), (-2 * F.col("_at")).alias("_order"), (-F.col("_at")).alias("_to")).unionByName(
        points.select(*place, (1 - 2 * (F.col("_at") + gap_us)).alias("_order"), nothing.alias("_to")))
    found = running_max_before(both, ["_key", "_start"], "_order", F.col("_to"), "_next", max_rows).filter(F.col("_at").isNotNull())
    jumps = cut_lineage(found.select(*place, (-F.col("_next")).alias("_next")).filter(F.col("_next").isNotNull()))
    reached = points.filter(F.col("_at") == F.col("_start"))
    while not jumps.isEmpty():
        reached = cut_lineage(reached.unionByName(reached.join(jumps, place).select("_key", "_start", F.col("_next").alias("_at"))))
        further = jumps.select("_key", "_start", F.col("_at").alias("_next"), F.col("_next").alias("_after"))
        jumps = cut_lineage(jumps.join(further, ["_key", "_start", "_next"]).select(*place, F.col("_after").alias("_next")))
    return reached.filter(F.col("_at") > F.col("_start")).select("_key", "_at")


def dedup_within_gap(
    events: DataFrame,
    gap: timedelta = timedelta(minutes=5),
    keys: tuple[str, ...] = ("user_id", "item_id", "behavior_type"),
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Drop an event when a *kept* event of the same key lies less than ``gap`` before it.

    Of events at one time only the first by event_id can stay. One that lies ``gap`` or more after the event before it stays
    whatever came earlier and begins a chain; what is nearer to a chain's begin goes. Only the times left in chains depend
    on each other: short chains are walked, long ones take pointer doubling, all in the JVM. Events without a time are
    dropped (``reject_reason`` names them), null keys are keys, a gap of zero or less keeps all others.
    """
    gap_us = int(gap.total_seconds() * 1_000_000)
    timed = events.withColumn("_at", as_number("event_time", events.schema["event_time"].dataType)).filter(F.col("_at").isNotNull())
    if gap_us <= 0:
        return timed.drop("_at")
    # Structs compare null fields as equal, so rows of null keys meet in joins.
    nodes = timed.groupBy(F.struct(*keys).alias("_key"), "_at").agg(
        F.min_by(F.struct(*events.columns), F.struct("event_id")).alias("_row"))
    at, start, head = F.col("_at"), F.col("_start"), F.col("_head")
    times = running_max_before(nodes, ["_key"], "_at", at, "_before", max_rows)
    times = times.withColumn("_head", F.col("_before").isNull() | (at - F.col("_before") >= gap_us)).drop("_before")
    times = running_max_before(times, ["_key"], "_at", F.when(head, at), "_start", max_rows)
    times = cut_lineage(times.withColumn("_start", F.when(head, at).otherwise(start)).filter(head | (at - start >= gap_us)))
    whole = times.filter(head).select("_row.*")
    left = times.filter(~head).select("_key", "_start", "_at")
    sizes = left.groupBy("_key", "_start").agg(F.count(F.lit(1)).alias("_times"))
    most = sizes.agg(F.max("_times")).first()[0]
    if most is None:
        return whole
    chain = min(CHAIN, max_rows)
    if most <= chain:
        kept = _walk(left, gap_us)
    else:
        long = cut_lineage(sizes.filter(F.col("_times") > chain).select("_key", "_start"))
        kept = _walk(left.join(long, ["_key", "_start"], "left_anti"), gap_us).unionByName(
            _double(left.join(long, ["_key", "_start"], "left_semi"), gap_us, max_rows))
    return whole.unionByName(times.filter(~head).join(kept, ["_key", "_at"], "left_semi").select("_row.*"))


def bounded_history(
    events: DataFrame,
    limit: int = HISTORY_LIMIT,
    step: int = HISTORY_STEP,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Newest events per user, as left over by a history that sheds its oldest ``step`` events
    whenever it outgrows ``limit``.
    """
    sizes = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    over = F.col("_n") - (limit + 1)
    kept = F.when(over < 0, F.col("_n")).otherwise(limit + 1 - step + F.pmod(over, F.lit(step)))
    trimmed = sizes.filter(over >= 0).select("user_id", kept.alias("_kept"))
    marked = events.join(trimmed, "user_id", "left")
    whole = marked.filter(F.col("_kept").isNull()).drop("_kept")
    cut = rank_within(
        marked.filter(F.col("_kept").isNotNull()), ["user_id"], "event_time", "_position",
        limit=F.col("_kept"), tie_breaker=["event_id"], descending=True, max_rows=max_rows,
    )
    return whole.unionByName(cut.drop("_kept", "_position"))
