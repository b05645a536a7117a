"""The three streaming queries over behaviour events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from recoflow.operators import windows
from recoflow.sources.merge_log import MergeLog
from recoflow.sources.sinks import upsert_table

TRIGGER = "10 seconds"


@dataclass(frozen=True)
class StreamPaths:
    """Where the queries write and keep their checkpoints (a folder shared by the cluster)."""

    aggregates: str
    deltas: str
    messages: str
    checkpoints: str


def _start(df: DataFrame, sink: Callable[[DataFrame, int], None], name: str, checkpoints: str,
           mode: str, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{checkpoints}/{name}").queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).foreachBatch(sink).start()


def _by_day(batch: DataFrame) -> DataFrame:
    return batch.withColumn("window_date", F.to_date("window_start"))


def aggregate_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Upsert of behaviour aggregates on (user, type, window)."""
    keys = ["user_id", "behavior_type", "window_start", "window_end"]

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(path, _by_day(batch), keys, ["window_date"])

    return write


def delta_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Upsert of preference deltas on (user, item, window).

    Deltas carry the id of the batch that wrote them; the incremental roll-up goes by it.
    """
    keys = ["user_id", "item_id", "window_start", "window_end"]

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = _by_day(batch).withColumn("batch_id", F.lit(batch_id + 1).cast("bigint"))
        upsert_table(path, marked, keys, ["window_date"])

    return write


def log_sink(log: MergeLog, first: int, number: str | None = None) -> Callable[[DataFrame, int], None]:
    """Each micro-batch as a run of its own: nothing that is stored is read or rewritten, whatever the size of the day.

    ``first`` is the log's id of the stream's batch 0. Ids written to ``number`` start at 1 and never repeat, also when a
    stream starts with a new checkpoint, so an incremental roll-up misses no batch. Runs are merged apart, by ``log.compact``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _by_day(batch)
        if number is not None:
            rows = rows.withColumn(number, F.lit(first + batch_id + 1).cast("bigint"))
        log.append(rows, first + batch_id)

    return write


def aggregate_log(spark: SparkSession, path: str) -> MergeLog:
    return MergeLog(spark, path, ["user_id", "behavior_type", "window_start", "window_end"], ["window_date"])


def delta_log(spark: SparkSession, path: str) -> MergeLog:
    return MergeLog(spark, path, ["user_id", "item_id", "window_start", "window_end"], ["window_date"])


def message_sink(publish: Callable[[DataFrame], None], n: int = windows.TOP_N) -> Callable[[DataFrame, int], None]:
    """Latest-window top list of the users in each micro-batch, as messages."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                publish(windows.recommendation_messages(windows.latest_top_items(batch, n), F.current_timestamp()))
        finally:
            batch.unpersist()

    return write


def start_behavior_queries(
    events: DataFrame,
    paths: StreamPaths,
    publish: Callable[[DataFrame], None],
    length: str = windows.WINDOW_LENGTH,
    watermark: str = windows.WATERMARK,
    available_now: bool = False,
    closed_deltas_only: bool = True,
    log_storage: bool = False,
) -> list[StreamingQuery]:
    """Start aggregation, preference deltas and recommendations on one decoded stream.

    ``events.event_time`` must be a timestamp with time zone. With ``closed_deltas_only`` deltas are
    written once, when their window closes, so an incremental roll-up never misses a late update;
    otherwise they are written on every change and have to be rolled up as a whole.

    With ``log_storage`` aggregates and deltas go to ``aggregate_log`` and ``delta_log``, where a trigger writes only its own
    rows; read them with their ``read`` and merge them with their ``compact``. Else each trigger rewrites the days it touches.
    """
    aggregates = windows.behavior_aggregate(events, length, watermark)
    scores = windows.item_scores(events, length, watermark)
    deltas = windows.preference_delta(events, length, watermark)
    delta_mode = "append" if closed_deltas_only else "update"
    keep_aggregates, keep_deltas = aggregate_sink(paths.aggregates), delta_sink(paths.deltas)
    if log_storage:
        spark = events.sparkSession
        logs = [(aggregate_log(spark, paths.aggregates), "aggregation", None), (delta_log(spark, paths.deltas), "preference-delta", "batch_id")]
        keep_aggregates, keep_deltas = [log_sink(log, log.first_batch_of(f"{paths.checkpoints}/{name}"), number) for log, name, number in logs]
    return [
        _start(aggregates, keep_aggregates, "aggregation", paths.checkpoints, "update", available_now),
        _start(scores, message_sink(publish), "recommendations", paths.checkpoints, "update", available_now),
        _start(deltas, keep_deltas, "preference-delta", paths.checkpoints, delta_mode, available_now),
    ]


def run_until_any_ends(queries: list[StreamingQuery]) -> None:
    """Wait until one query ends, then stop the others; an error of the ended query is raised."""
    if not queries:
        return
    try:
        SparkSession.active().streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
