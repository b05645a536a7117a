"""Idempotent order ETL: decode, de-duplicate, convert, load, dead letters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from recoflow.functions.codes import ORDER_STATUSES, amount_in_cny, rate_to_cny
from recoflow.functions.text import capped_payload, is_blank
from recoflow.operators.events import moment
from recoflow.operators.merge import last_arrival
from recoflow.schemas import ORDER_MESSAGE
from recoflow.session import cut_lineage

ORDER_COLUMNS = ["order_id", "user_id", "status", "amount_cny", "amount", "currency", "occurred_at", "seq"]
#: What tells messages of a topic apart, in the order of arrival.
ARRIVAL = ["arrived", "partition", "seq"]
MAX_EVENT_ID = 64
DEAD_LETTER_BYTES = 4096


def decode_orders(messages: DataFrame) -> DataFrame:
    """Read order messages (columns seq, topic, value) and keep the text.

    ``seq`` is the offset, which repeats in every ``partition`` (0 where there is no such column). Messages
    arrive in the order of ``timestamp`` (where there is one), partition and offset.

    The event id may be plain text or an object with a ``value``. A time is a number of epoch
    seconds or ISO text.
    """
    m = F.from_json(F.col("value").cast("string"), ORDER_MESSAGE)
    wrapped = F.from_json(F.col("m.eventId"), "struct<value:string>")["value"]
    at = F.col("m.occurredAt")
    seconds = F.when(at.rlike(r"^[0-9]+([.][0-9]+)?(E[0-9]+)?$"), at.try_cast("decimal(20,6)"))
    when = F.coalesce(F.timestamp_micros((seconds * 1_000_000).cast("bigint")), F.try_to_timestamp(at))
    place = [F.col("partition").cast("int") if "partition" in messages.columns else F.lit(0).alias("partition"),
             F.col("timestamp").cast("timestamp").alias("arrived") if "timestamp" in messages.columns
             else F.lit(None).cast("timestamp").alias("arrived")]
    return messages.withColumn("m", m).select(
        "seq", *place, "topic", F.col("value").cast("string").alias("payload"),
        F.when(F.col("m.eventId").startswith("{"), wrapped).otherwise(F.col("m.eventId")).alias("event_id"),
        F.col("m.orderId").alias("order_id"), F.col("m.userId").alias("user_id"), F.col("m.status").alias("status"),
        F.col("m.amount").alias("amount"), F.col("m.currency").alias("currency"),
        when.cast("timestamp_ntz").alias("occurred_at"),
    )


def decode_error() -> Column:
    """Why a decoded order is refused, null for a good one."""
    missing = F.lit(False)
    for name in ("event_id", "order_id", "user_id", "status", "amount", "currency", "occurred_at"):
        missing = missing | F.col(name).isNull()
    return (
        F.when(missing, F.lit("DESERIALIZE_FAIL: MissingField"))
        .when(is_blank(F.col("event_id")) | (F.length("event_id") > MAX_EVENT_ID), F.lit("DESERIALIZE_FAIL: EventId"))
        .when(~F.col("status").isin(ORDER_STATUSES), F.lit("DESERIALIZE_FAIL: Status"))
        .when(F.col("amount") < 0, F.lit("DESERIALIZE_FAIL: NegativeAmount"))
    )


def classify(orders: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Add outcome (PROCESSED, DUPLICATE, DEAD_LETTER) and reason to decoded orders.

    The first good event of a (topic, event_id) holds its mark for ever, even when its currency is
    unknown; ``seen`` holds the marks of earlier batches. First events are found by an aggregate and
    joined back on id *and* arrival, so copies of one event do not meet in one task. A null topic is a topic.
    """
    # Decoding is costly, so nothing here may be pushed down into it: bad events are left out inside
    # the aggregate instead of by a filter, and the join key is never null, which would add one.
    # Structs compare null fields as equal.
    keys = ["_mark", "_at"]
    checked = (
        orders.withColumn("reason", decode_error()).withColumn("_at", F.struct(*ARRIVAL))
        .withColumn("_mark", F.struct("topic", F.coalesce("event_id", F.lit("")).alias("event_id")))
    )
    firsts = (
        checked.groupBy("_mark").agg(F.min(F.when(F.col("reason").isNull(), F.col("_at"))).alias("_at"))
        .filter(F.col("_at").isNotNull()).withColumn("_first", F.lit(True))
    )
    if seen is not None:
        firsts = firsts.join(seen.select(F.struct("topic", "event_id").alias("_mark")), "_mark", "left_anti")
    marked = checked.join(firsts, keys, "left")
    good, first = F.col("reason").isNull(), F.col("_first").isNotNull()
    unsupported = good & first & rate_to_cny(F.col("currency")).isNull()
    outcome = (
        F.when(~good | unsupported, F.lit("DEAD_LETTER")).when(first, F.lit("PROCESSED")).otherwise(F.lit("DUPLICATE"))
    )
    reason = F.when(unsupported, F.concat(F.lit("PERMANENT: unsupported currency "), "currency")).otherwise(F.col("reason"))
    return marked.withColumn("outcome", outcome).withColumn("reason", reason).drop("_first", *keys)


def first_events(orders: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Distinct events with outcome, reason and number of ``copies``; bad events are kept one by one.

    This is ``classify`` without the rows of the duplicates: one pass over the messages and one
    shuffle, in which copies already collapse on the map side.
    """
    checked = orders.withColumn("reason", decode_error())
    name = F.when(F.col("reason").isNull(), F.concat(F.lit("event:"), "event_id")).otherwise(
        F.concat_ws(":", F.lit("message"), F.col("partition"), F.col("seq")))
    rest = [c for c in checked.columns if c != "topic"]
    events = (
        checked.withColumn("_name", name).groupBy("topic", "_name")
        .agg(F.min_by(F.struct(*rest), F.struct(*ARRIVAL)).alias("_row"), F.count(F.lit(1)).alias("copies"))
        .select("topic", F.struct("topic", "_name").alias("_mark"), "_row.*", "copies")
    )
    known = F.lit(False)
    if seen is not None:
        name = F.concat(F.lit("event:"), "event_id").alias("_name")
        marks = seen.select(F.struct("topic", name).alias("_mark"), F.lit(True).alias("_known"))
        events, known = events.join(marks.distinct(), "_mark", "left"), F.col("_known").isNotNull()
    bad = F.col("reason").isNotNull()
    unsupported = ~bad & ~known & rate_to_cny(F.col("currency")).isNull()
    outcome = (
        F.when(bad | unsupported, F.lit("DEAD_LETTER")).when(known, F.lit("DUPLICATE")).otherwise(F.lit("PROCESSED")))
    reason = F.when(unsupported, F.concat(F.lit("PERMANENT: unsupported currency "), "currency")).otherwise(F.col("reason"))
    return events.withColumn("outcome", outcome).withColumn("reason", reason).drop("_mark", "_known")


def acquired_events(orders: DataFrame, acquire: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Every event with outcome and reason, where marks end: ``acquire`` (as in ``marks``) judges the good events.

    ``mark`` keeps what ``acquire`` said (null for bad events). An event comes to effect again once its mark has ended, so a
    batch may hold several. Good events without a time of arrival cannot be judged and are dead letters. Payloads are
    parsed once: the decoded events are written before they are split.
    """
    checked = cut_lineage(orders.withColumn("reason", decode_error()))
    good = F.col("reason").isNull()
    rows = (
        acquire(checked.filter(good)).withColumnRenamed("outcome", "mark")
        .unionByName(checked.filter(~good).withColumn("mark", F.lit(None).cast("string")))
    )
    unusable, first = good & (F.col("mark") == "UNUSABLE"), good & (F.col("mark") == "FIRST")
    unsupported = first & rate_to_cny(F.col("currency")).isNull()
    outcome = (
        F.when(~good | unusable | unsupported, F.lit("DEAD_LETTER")).when(first, F.lit("PROCESSED")).otherwise(F.lit("DUPLICATE"))
    )
    reason = (
        F.when(unsupported, F.concat(F.lit("PERMANENT: unsupported currency "), "currency"))
        .when(unusable, F.lit("DESERIALIZE_FAIL: Arrival")).otherwise(F.col("reason"))
    )
    return rows.withColumn("outcome", outcome).withColumn("reason", reason)


def new_marks(classified: DataFrame) -> DataFrame:
    """Marks to remember: events that were first, whether loaded or refused for their currency."""
    marks = (F.col("outcome") == "PROCESSED") | F.startswith("reason", F.lit("PERMANENT"))
    return classified.filter(marks).select("topic", "event_id")


def warehouse_orders(classified: DataFrame) -> DataFrame:
    """Processed orders with the amount in CNY."""
    return (
        classified.filter(F.col("outcome") == "PROCESSED")
        .withColumn("amount_cny", amount_in_cny(F.col("amount"), F.col("currency")))
        .select(*ORDER_COLUMNS, F.struct(*ARRIVAL).alias("arrival"))
    )


def load_orders(warehouse: DataFrame) -> DataFrame:
    """State of each order: the last arrival, whatever its event time."""
    return last_arrival(warehouse, ["order_id"], "arrival").drop("arrival")


def order_dead_letters(classified: DataFrame) -> DataFrame:
    """Dead letters: payload (whole, and a snippet of 4096 bytes), original topic and reason (message headers)."""
    return classified.filter(F.col("outcome") == "DEAD_LETTER").select(
        "seq", "partition", F.coalesce("topic", F.lit("")).alias("original_topic"), F.col("reason").alias("error_reason"),
        capped_payload(F.col("payload"), DEAD_LETTER_BYTES).alias("payload"), F.col("payload").alias("full_payload"),
    )


def outcome_counts(firsts: DataFrame) -> DataFrame:
    """Messages per outcome, from ``first_events``: later copies of an event are duplicates."""
    later = F.when(F.col("outcome") != "DUPLICATE", F.col("copies") - 1).otherwise(F.col("copies"))
    counts = firsts.agg(
        F.count_if(F.col("outcome") == "PROCESSED").alias("PROCESSED"),
        F.count_if(F.col("outcome") == "DEAD_LETTER").alias("DEAD_LETTER"),
        F.coalesce(F.sum(later), F.lit(0)).alias("DUPLICATE"),
    )
    return counts.unpivot([], ["PROCESSED", "DEAD_LETTER", "DUPLICATE"], "outcome", "events").filter("events > 0")


@dataclass(frozen=True)
class OrderBatch:
    """Everything one batch of order messages produces."""

    orders: DataFrame
    dead_letters: DataFrame
    marks: DataFrame
    counts: DataFrame


def order_etl(messages: DataFrame, etl_time: datetime, seen: DataFrame | None = None,
              materialize: bool = False) -> OrderBatch:
    """Decode, de-duplicate and split a batch of messages.

    Set ``materialize`` when more than one of the results is used: the distinct events are then
    written once to the shared checkpoint folder.
    """
    firsts = first_events(decode_orders(messages), seen)
    if materialize:
        firsts = cut_lineage(firsts)
    orders = load_orders(warehouse_orders(firsts)).withColumn("etl_time", moment(etl_time))
    return OrderBatch(orders, order_dead_letters(firsts), new_marks(firsts), outcome_counts(firsts))
