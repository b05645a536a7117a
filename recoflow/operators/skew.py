"""Keyed operations that stay parallel when a single key holds a large share of all rows.

Picking one row per key is an aggregation with a partial step, so a hot key reaches its reducer as
one row per map task. Operations that depend on the order inside a key cut hot keys into blocks of
their order column, work on all blocks in parallel and connect them through per-block totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from recoflow.session import cut_lineage

MAX_ROWS_PER_KEY = 1_000_000
BROADCAST_KEYS = 10_000
QUANTILES = 100
BLOCK, LAST_BLOCK = "_block", 1 << 62


def pick_row(df: DataFrame, keys: Sequence[str], order: Column, newest: bool = True) -> DataFrame:
    """One row per key: the one with the largest (or smallest) order value.

    ``order`` must be unique within a key. Rows whose order value is null are ignored.
    """
    rest = [name for name in df.columns if name not in keys]
    choose = F.max_by if newest else F.min_by
    picked = df.groupBy(*keys).agg(choose(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[name].alias(name) for name in rest]).select(*df.columns)


def as_number(column: str, dtype: T.DataType) -> Column:
    """Order column as a bigint that keeps its order: microseconds for time, itself for integers."""
    value = F.col(column)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value)
    return value.cast("bigint")


def hot_keys(df: DataFrame, keys: Sequence[str], number: Column, max_rows: int) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows and how to cut them; None when there are none.

    There are at most (rows / max_rows) such keys. Each gets up to ``QUANTILES`` bounds that split
    its rows about evenly however its order values are spread, and the number of equal steps between
    two bounds. The result is cut from its lineage, so that bounds never change under a retry, and
    marked for broadcast only while its row count is small.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_rows)
    if counted.isEmpty():
        return None
    counted = _small(cut_lineage(counted.withColumn("_blocks", F.ceil(F.col("_rows") / F.lit(max_rows)).cast("bigint"))))
    fractions = F.lit([i / QUANTILES for i in range(1, QUANTILES)])
    cuts = (
        df.select(*keys, number.alias("_number")).join(counted, list(keys))
        .groupBy(*keys).agg(
            F.percentile_approx("_number", fractions, 10 * QUANTILES).alias("_bounds"), F.min("_number").alias("_low"),
            F.max("_number").alias("_high"), F.max("_blocks").alias("_blocks"))
        .select(*keys, F.array_distinct("_bounds").alias("_bounds"), "_low", "_high",
                F.ceil(F.col("_blocks") / QUANTILES).alias("_steps"))
    )
    return _small(cut_lineage(cuts))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def with_blocks(
    df: DataFrame, keys: Sequence[str], order_column: str, max_rows: int = MAX_ROWS_PER_KEY, descending: bool = False
) -> tuple[DataFrame, bool]:
    """Add ``_block``: 0 for ordinary keys, a range of the order column for hot ones.

    Blocks of a key are numbered in processing order and rows of equal order value share a block.
    The flag tells whether any key was cut.
    """
    number = as_number(order_column, df.schema[order_column].dataType)
    number = -number if descending else number
    hot = hot_keys(df, keys, number, max_rows)
    if hot is None:
        return df.withColumn(BLOCK, F.lit(0).cast("bigint")), False
    joined = df.join(hot, list(keys), "left").withColumn("_number", number)
    joined = joined.withColumn("_range", F.size(F.filter("_bounds", lambda bound: bound < F.col("_number"))))
    lower = F.coalesce(F.get("_bounds", F.col("_range") - 1), F.col("_low") - 1)
    upper = F.coalesce(F.get("_bounds", F.col("_range")), F.col("_high"))
    step = F.floor((F.col("_number") - lower - 1).cast("double") * F.col("_steps") / F.greatest(upper - lower, F.lit(1)))
    block = F.col("_range") * F.col("_steps") + F.least(F.greatest(step, F.lit(0)), F.col("_steps") - 1)
    # Null order values stand where a sort puts them: before all others, or after them when descending.
    unordered = F.col("_bounds").isNotNull() & F.col("_number").isNull()
    block = F.when(unordered, F.lit(LAST_BLOCK if descending else -1)).otherwise(F.coalesce(block.cast("bigint"), F.lit(0)))
    blocked = joined.withColumn(BLOCK, block.cast("bigint"))
    return blocked.drop("_bounds", "_low", "_high", "_steps", "_number", "_range"), True


def _before(keys: Sequence[str], *order: Column | str):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def running_max_before(
    df: DataFrame,
    keys: Sequence[str],
    order_column: str,
    value: Column,
    alias: str,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Largest ``value`` among earlier rows of the same key; null for the first one.

    ``order_column`` must be unique within a key.
    """
    rows, cut = with_blocks(df.withColumn("_value", value), keys, order_column, max_rows)
    parts = [*keys, BLOCK]
    local = F.max("_value").over(_before(parts, order_column))
    if not cut:
        return rows.withColumn(alias, local).drop("_value", BLOCK)
    totals = rows.groupBy(*parts).agg(F.max("_value").alias("_total"))
    earlier = totals.select(*parts, F.max("_total").over(_before(keys, BLOCK)).alias("_earlier"))
    joined = rows.join(earlier, parts, "left")
    return joined.withColumn(alias, F.greatest(local, "_earlier")).drop("_value", "_earlier", BLOCK)


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order_column: str,
    alias: str,
    limit: Column | None = None,
    tie_breaker: Sequence[str] = (),
    descending: bool = False,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Position of each row within its key, 1-based; rows beyond ``limit`` are dropped.

    ``limit`` may be a column that is constant per key. Blocks that lie wholly beyond it are
    discarded before their rows are ranked.
    """
    rows, cut = with_blocks(df, keys, order_column, max_rows, descending)
    parts = [*keys, BLOCK]
    order = [F.desc(c) if descending else F.asc(c) for c in (order_column, *tie_breaker)]
    position = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
    if cut:
        sizes = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("_size"))
        offsets = sizes.select(*parts, F.coalesce(F.sum("_size").over(_before(keys, BLOCK)), F.lit(0)).alias("_offset"))
        rows = rows.join(offsets, parts)
        if limit is not None:
            rows = rows.filter(F.col("_offset") < limit)
        ranked = rows.withColumn(alias, (F.col("_offset") + position).cast("bigint")).drop("_offset")
    else:
        ranked = rows.withColumn(alias, position.cast("bigint"))
    ranked = ranked.drop(BLOCK)
    return ranked if limit is None else ranked.filter(F.col(alias) <= limit)
