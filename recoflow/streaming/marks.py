"""Marks with a time to live in streaming state: the value is when the mark ends, a timer takes it out."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from recoflow.operators.marks import DAY_US, DUPLICATE, FIRST, TTL_DAYS, ttl_days

OUTPUT = "topic string, event_id string, partition int, seq bigint, arrived timestamp, outcome string"


class TtlMarks(StatefulProcessor):
    """One key is a (topic, event_id). State is one number; rows of a micro-batch are judged in their order of arrival."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ends = handle.getValueState("ends", "ends bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["at", "partition", "seq"], kind="stable")
        ends = self.ends.get()[0] if self.ends.exists() else None
        before, outcomes = ends, []
        for at, ttl in zip(frame["at"], frame["ttl"]):
            first = ends is None or at >= ends
            if first:
                ends = int(at + ttl)
            outcomes.append(FIRST if first else DUPLICATE)
        if ends != before:
            if before is not None:
                self.handle.deleteTimer(before // 1000)
            self.ends.update((ends,))
            self.handle.registerTimer(ends // 1000)
        yield frame.assign(outcome=outcomes)[["topic", "event_id", "partition", "seq", "arrived", "outcome"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.ends.clear()
        return iter([])

    def close(self) -> None:
        pass


def acquire_stream(events: DataFrame, days: int = TTL_DAYS, overrides: Mapping[str, int] | None = None, lateness: str = "1 day") -> DataFrame:
    """Streaming twin of ``operators.marks.acquire``: the outcome of each event, marks kept in state until they end.

    ``arrived`` must be a timestamp with time zone; events later than ``lateness`` behind the newest are dropped by the
    watermark, events without id or arrival time are left out. State holds the marks that live, not all ever set.
    """
    usable = events.filter(F.col("event_id").isNotNull() & F.col("arrived").isNotNull())
    timed = usable.select("topic", "event_id", F.col("partition").cast("int").alias("partition"), F.col("seq").cast("bigint").alias("seq"), "arrived",
                          F.unix_micros("arrived").alias("at"), (ttl_days(F.col("topic"), days, overrides) * F.lit(DAY_US)).alias("ttl"))
    return timed.withWatermark("arrived", lateness).groupBy("topic", "event_id").transformWithStateInPandas(
        TtlMarks(), OUTPUT, "append", "EventTime")
