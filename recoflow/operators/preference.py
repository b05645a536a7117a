"""The user–item preference matrix: roll-up of window deltas, increments, retention and reads."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from recoflow.operators.events import moment

RETENTION_DAYS = 30


def high_water_mark(deltas: DataFrame, batch_column: str = "batch_id") -> DataFrame:
    """Largest batch id, 0 for an empty table."""
    return deltas.agg(F.coalesce(F.max(batch_column), F.lit(0)).cast("bigint").alias("high_water_mark"))


def roll_up(deltas: DataFrame) -> DataFrame:
    """Deltas summed into one row per user and item."""
    return deltas.groupBy("user_id", "item_id").agg(
        F.sum("score_delta").alias("preference_score"),
        F.sum("interaction_delta").alias("interaction_count"),
        F.min("window_start").alias("last_window_start"),
        F.max("window_end").alias("last_window_end"),
    )


def batch_range(deltas: DataFrame, after: int, up_to: int, batch_column: str = "batch_id") -> DataFrame:
    """Deltas with after < batch id ≤ up_to."""
    return deltas.filter((F.col(batch_column) > after) & (F.col(batch_column) <= up_to))


def accumulate(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Merge matrices: scores and counts add up, the window range widens."""
    return existing.unionByName(incoming).groupBy("user_id", "item_id").agg(
        F.sum("preference_score").alias("preference_score"),
        F.sum("interaction_count").alias("interaction_count"),
        F.min("last_window_start").alias("last_window_start"),
        F.max("last_window_end").alias("last_window_end"),
    )


@dataclass(frozen=True)
class IncrementResult:
    """Outcome of one incremental roll-up."""

    matrix: DataFrame
    last_processed_id: int
    upper_bound_id: int
    executed: bool


def incremental_roll_up(
    matrix: DataFrame, deltas: DataFrame, last_processed_id: int, batch_column: str = "batch_id"
) -> IncrementResult:
    """Add the deltas after the checkpoint; a no-op when there are none.

    The new checkpoint is ``upper_bound_id``; store it only after the matrix has been written.
    """
    upper = high_water_mark(deltas, batch_column).first()[0]
    if upper <= last_processed_id:
        return IncrementResult(matrix, last_processed_id, upper, False)
    fresh = roll_up(batch_range(deltas, last_processed_id, upper, batch_column))
    return IncrementResult(accumulate(matrix, fresh), last_processed_id, upper, True)


def is_purgeable(now: datetime, checkpoint: int, retention_days: int = RETENTION_DAYS,
                 batch_column: str = "batch_id") -> Column:
    """Expired and already rolled up."""
    if retention_days <= 0:
        raise ValueError("retention_days must be positive")
    cutoff = moment(now - timedelta(days=retention_days))
    return (F.col("window_end") < cutoff) & (F.col(batch_column) <= checkpoint)


def purge_deltas(deltas: DataFrame, now: datetime, checkpoint: int, retention_days: int = RETENTION_DAYS,
                 batch_column: str = "batch_id") -> DataFrame:
    """Deltas that stay. Without a checkpoint nothing is purged."""
    purgeable = is_purgeable(now, checkpoint, retention_days, batch_column)
    return deltas if checkpoint <= 0 else deltas.filter(~purgeable)


def purge_count(deltas: DataFrame, now: datetime, checkpoint: int, retention_days: int = RETENTION_DAYS,
                batch_column: str = "batch_id") -> DataFrame:
    purgeable = is_purgeable(now, checkpoint, retention_days, batch_column)
    deleted = F.count_if(purgeable) if checkpoint > 0 else F.lit(0).cast("bigint")
    return deltas.agg(deleted.alias("deleted_rows"))


def of_user(matrix: DataFrame, user_id: int) -> DataFrame:
    return matrix.filter(F.col("user_id") == user_id).orderBy(F.desc("preference_score"))


def of_item(matrix: DataFrame, item_id: int) -> DataFrame:
    return matrix.filter(F.col("item_id") == item_id).orderBy(F.desc("preference_score"))


def windows_after(table: DataFrame, moment_: datetime) -> DataFrame:
    """Aggregates or deltas of windows that start after a point in time."""
    return table.filter(F.col("window_start") > moment(moment_))


def aggregates_of_user(aggregates: DataFrame, user_id: int, after: datetime | None = None) -> DataFrame:
    """Window aggregates of a user, newest first."""
    rows = aggregates if after is None else windows_after(aggregates, after)
    return rows.filter(F.col("user_id") == user_id).orderBy(F.desc("window_start"))


def count_above(matrix: DataFrame, threshold: float) -> DataFrame:
    """Number of preferences above a score, per user."""
    return (
        matrix.filter(F.col("preference_score") > threshold)
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("preference_count"))
    )
