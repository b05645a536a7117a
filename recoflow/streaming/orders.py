"""Streaming order ETL with exactly-once effect."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from recoflow.operators import orders
from recoflow.operators.marks import MarkStore, TTL_DAYS
from recoflow.session import cut_lineage
from recoflow.sources.sinks import read_table, upsert_table

BUCKETS = 64


@dataclass(frozen=True)
class OrderPaths:
    orders: str
    marks: str
    dead_letters: str
    checkpoints: str


@dataclass(frozen=True)
class MarkLife:
    """How many days marks live, topics with a number of their own, and how many folders a day's marks are dealt to."""

    days: int = TTL_DAYS
    topics: Mapping[str, int] = field(default_factory=dict)
    buckets: int = BUCKETS
    fanout: int = 8


def _bucketed(df: DataFrame, *columns: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))


def order_sink(paths: OrderPaths, buckets: int = BUCKETS, life: MarkLife | None = None) -> Callable[[DataFrame, int], None]:
    """Per micro-batch: de-duplicate against the durable marks, load orders, file dead letters.

    All writes are keyed, and marks remember the batch that set them: a replayed batch ignores its
    own marks, so it produces what it produced before.

    Without ``life`` marks are kept for ever and each batch reads all of them. With it they end after their topic's days, a
    batch reads the folders it can meet only, and merges forget what has ended; messages then need a ``timestamp``. The two
    forms keep marks in different layouts, so a table of marks stays with the form that began it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = orders.decode_orders(batch)
        store = None
        if life is None:
            marks = read_table(spark, paths.marks)
            seen = None if marks is None else marks.filter(F.col("batch_id") != batch_id)
            firsts = cut_lineage(orders.first_events(decoded, seen))
        else:
            store = MarkStore(spark, paths.marks, life.days, life.topics, life.buckets, life.fanout)
            # Batches of a new checkpoint go behind all that are stored.
            batch_id += store.log.first_batch_of(paths.checkpoints)
            firsts = cut_lineage(orders.acquired_events(decoded, lambda events: store.acquire(events, batch_id)))
        now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
        loaded = orders.load_orders(orders.warehouse_orders(firsts)).withColumn("etl_time", now)
        upsert_table(paths.orders, _bucketed(loaded, "order_id", buckets=buckets), ["order_id"], ["bucket"])
        letters = orders.order_dead_letters(firsts).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if not letters.isEmpty():
            letters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
                paths.dead_letters)
        if store is not None:
            store.remember(firsts.withColumn("outcome", F.col("mark")), batch_id)
            return
        fresh = orders.new_marks(firsts).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if not fresh.isEmpty():
            fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
                paths.marks)

    return write


def start_order_stream(messages: DataFrame, paths: OrderPaths, available_now: bool = False,
                       trigger: str = "10 seconds", buckets: int = BUCKETS, life: MarkLife | None = None) -> StreamingQuery:
    """``messages`` has seq (offset), topic and value, with ``life`` also timestamp."""
    when = {"availableNow": True} if available_now else {"processingTime": trigger}
    return (
        messages.writeStream.option("checkpointLocation", paths.checkpoints).trigger(**when)
        .foreachBatch(order_sink(paths, buckets, life)).start()
    )


def within_ttl(decoded: DataFrame, ttl: str = "7 days") -> DataFrame:
    """First event per topic and id within a time to live, kept in streaming state only.

    Cheaper than the durable marks, but copies that come later than the TTL pass. Rows without id or time, which
    nothing can tell apart or date, all pass and are refused by the checks that follow.
    """
    timed = decoded.withColumn("event_time", F.col("occurred_at").cast("timestamp"))
    usable = F.col("event_id").isNotNull() & F.col("event_time").isNotNull()
    first = timed.filter(usable).withWatermark("event_time", ttl).dropDuplicatesWithinWatermark(["topic", "event_id"])
    return first.unionByName(timed.filter(~usable))
