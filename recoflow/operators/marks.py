"""Marks of events that took effect, with a time to live per topic: a copy counts as a duplicate only while the mark lives."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from recoflow.operators.scan import Fold, sequential_fold
from recoflow.operators.skew import MAX_ROWS_PER_KEY, as_number
from recoflow.sources.merge_log import MergeLog

TTL_DAYS, BUCKETS = 7, 64
DAY_US = 86_400_000_000
FIRST, DUPLICATE, UNUSABLE = "FIRST", "DUPLICATE", "UNUSABLE"
#: Before every time that occurs: where a stored mark stands among the events of its batch.
STORED = -(1 << 62)


def ttl_days(topic: Column, days: int = TTL_DAYS, overrides: Mapping[str, int] | None = None) -> Column:
    """Days a mark of this topic lives; topics without an own number, the null topic included, have ``days``."""
    value = F.lit(days)
    for name, own in (overrides or {}).items():
        value = F.when(topic == name, F.lit(own)).otherwise(value)
    return F.coalesce(value, F.lit(days)).cast("bigint")


def _step(state: list[int], inputs: tuple) -> tuple[list[int], int]:
    at, ttl = inputs
    if state and at < state[0]:
        return state, 0
    return [at + ttl], 1


def acquire(events: DataFrame, days: int = TTL_DAYS, overrides: Mapping[str, int] | None = None, seen: DataFrame | None = None,
            max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Add ``outcome``: FIRST sets (or renews) the mark of its (topic, event_id), DUPLICATE came while it lived.

    ``events`` has topic, event_id, arrived, partition, seq; events of a mark are judged in the order of the last three. A
    duplicate does not prolong the mark. ``seen`` holds marks of earlier batches (topic, event_id, marked_at): they go before all
    events of this batch, so a straggler that arrived before its mark was set is a duplicate too. A null topic is a
    topic; events without an id or an arrival time are UNUSABLE. A hot mark is cut like any hot key.
    """
    names = events.columns
    mark = F.to_json(F.struct("topic", "event_id"))
    rows = events.withColumn("_at", as_number("arrived", events.schema["arrived"].dataType)).withColumn("_order", F.col("_at"))
    if seen is not None:
        stored = seen.groupBy("topic", "event_id").agg(F.max("marked_at").alias("arrived"))
        stored = stored.withColumn("_at", as_number("arrived", stored.schema["arrived"].dataType)).withColumn("_order", F.lit(STORED))
        rows = rows.withColumn("_stored", F.lit(False)).unionByName(stored.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    else:
        rows = rows.withColumn("_stored", F.lit(False))
    usable = F.col("event_id").isNotNull() & F.col("_at").isNotNull()
    ttl = ttl_days(F.col("topic"), days, overrides) * F.lit(DAY_US)
    fold = Fold(_step, [F.col("_at"), F.col("_ttl")], F.array().cast("array<bigint>"))
    folded = sequential_fold(rows.filter(usable).withColumn("_mark", mark).withColumn("_ttl", ttl), ["_mark"],
                             ["_order", "partition", "seq"], fold, "_first", max_rows)
    judged = folded.filter(~F.col("_stored")).withColumn("outcome", F.when(F.col("_first") == 1, FIRST).otherwise(DUPLICATE))
    refused = rows.filter(~usable & ~F.col("_stored")).withColumn("outcome", F.lit(UNUSABLE))
    return judged.select(*names, "outcome").unionByName(refused.select(*names, "outcome"))


def new_marks(acquired: DataFrame, days: int = TTL_DAYS, overrides: Mapping[str, int] | None = None) -> DataFrame:
    """The newest mark per (topic, event_id) and the day it ends."""
    marks = acquired.filter(F.col("outcome") == FIRST).groupBy("topic", "event_id").agg(F.max("arrived").alias("marked_at"))
    end = F.to_date(F.timestamp_add("DAY", ttl_days(F.col("topic"), days, overrides), F.col("marked_at")))
    return marks.withColumn("expires", end)


class MarkStore:
    """Durable marks in folders by the day they end and a hash of the mark.

    A batch writes its own marks and reads the folders it can meet: buckets its events fall into, days that have not ended.
    Merges drop marks that have ended. A replayed batch ignores its own marks, so it gives what it gave before.
    """

    def __init__(self, spark, path: str, days: int = TTL_DAYS, overrides: Mapping[str, int] | None = None, buckets: int = BUCKETS,
                 fanout: int = 8):
        self.days, self.overrides, self.buckets = days, dict(overrides or {}), buckets
        self.log = MergeLog(spark, path, ["topic", "event_id"], ["expires", "bucket"], fanout=fanout)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("topic", "event_id"), F.lit(self.buckets)).cast("int")

    def seen(self, events: DataFrame, batch_id: int) -> DataFrame | None:
        """Marks that events of this batch can meet. At most ``buckets`` numbers and a time come to the driver."""
        own = events.filter(F.col("event_id").isNotNull() & F.col("arrived").isNotNull())
        met = own.agg(F.collect_set(self._bucket()), F.min(F.to_date("arrived"))).first()
        if not met[0]:
            return None
        # A renewed mark ends later than the one before, so a day leaves out old rows of a mark, never its newest living one.
        return self.log.read(F.col("bucket").isin(sorted(met[0])) & (F.col("expires") >= F.lit(met[1])), before=batch_id)

    def acquire(self, events: DataFrame, batch_id: int) -> DataFrame:
        return acquire(events, self.days, self.overrides, self.seen(events, batch_id))

    def remember(self, acquired: DataFrame, batch_id: int) -> None:
        marks = new_marks(acquired, self.days, self.overrides).withColumn("bucket", self._bucket())
        self.log.append(marks, batch_id)

    def compact(self, today: Column) -> int:
        """Merge runs but for the newest, which a replay may write again; marks that ended before ``today`` go."""
        return self.log.compact(keep_open=1, keep=F.col("expires") >= today)
