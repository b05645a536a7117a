"""Keyed merges: replace, accumulate, newer wins, last wins, first wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recoflow.operators.skew import MAX_ROWS_PER_KEY, pick_row, running_max_before


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """Replace rows of ``existing`` by those of ``incoming`` with the same key and add the new ones.

    With ``order`` the last incoming row per key wins; without it incoming keys must be unique.
    """
    fresh = incoming if order is None else pick_row(incoming, keys, order)
    fresh = fresh.select(*existing.columns)
    return existing.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def dedup_last(df: DataFrame, key: str, sequence: Column) -> DataFrame:
    """Last row per key; rows without a key are all kept."""
    return pick_row(df.filter(F.col(key).isNotNull()), [key], sequence).unionByName(df.filter(F.col(key).isNull()))


def last_arrival(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Row that arrived last per key, whatever its event time."""
    return pick_row(df, keys, F.col(sequence))


def newer_wins(
    incoming: DataFrame,
    keys: Sequence[str],
    time_column: str,
    sequence: str,
    written_at: Column,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Latest version per key by ``time_column``; equal times go to the later arrival.

    ``written_at`` is the write time of the incoming rows. created_at stays from the first write of a
    key and updated_at comes from the last one that was accepted. ``stored`` has the incoming
    columns except ``sequence``, plus created_at and updated_at.
    """
    rows = incoming.withColumn("created_at", written_at).withColumn("updated_at", written_at)
    if stored is not None:
        rows = rows.unionByName(stored.withColumn(sequence, F.lit(None).cast(incoming.schema[sequence].dataType)))
    # Nulls sort first: a stored row is older than any arrival and loses ties to it.
    order = F.struct(time_column, sequence)
    rest = [name for name in rows.columns if name not in keys and name != "created_at"]
    merged = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), order).alias("_row"),
        F.min_by("created_at", F.struct(F.col(sequence), F.col(time_column))).alias("created_at"),
    )
    columns = [name for name in rows.columns if name not in keys and name != sequence]
    return merged.select(
        *keys, *[F.col("created_at") if c == "created_at" else F.col("_row")[c].alias(c) for c in columns]
    )


def write_outcomes(
    incoming: DataFrame,
    keys: Sequence[str],
    time_column: str,
    sequence: str,
    stored: DataFrame | None = None,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Add ``outcome``: STALE_SKIPPED when an earlier arrival or the stored row is newer, else UPSERTED."""
    marked = running_max_before(incoming, keys, sequence, F.col(time_column), "_newest", max_rows)
    newest = F.col("_newest")
    if stored is not None:
        marked = marked.join(stored.select(*keys, F.col(time_column).alias("_stored")), list(keys), "left")
        newest = F.greatest(newest, F.col("_stored"))
    stale = F.coalesce(F.col(time_column) < newest, F.lit(False))
    outcome = F.when(stale, F.lit("STALE_SKIPPED")).otherwise(F.lit("UPSERTED"))
    return marked.withColumn("outcome", outcome).drop("_newest", "_stored")


def outcome_summary(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return outcomes.groupBy(*by).agg(
        F.count_if(F.col("outcome") == "UPSERTED").alias("upserted_count"),
        F.count_if(F.col("outcome") == "STALE_SKIPPED").alias("stale_skipped_count"),
    )
