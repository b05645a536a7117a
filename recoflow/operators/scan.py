"""Sequential folds per key that still run in parallel on hot keys.

Some rules accept or reject a row by what was accepted before it (minimum gaps, request caps,
guarded counters). Rows of a key are folded in order inside Arrow batches with constant memory. A
hot key is cut into blocks; all blocks are folded at once from a guessed entry state. The exits show
which guesses were wrong, and only from there the fold is repeated, over runs of 2, 4, 8, … blocks.
When every block has started from the true exit of the block before it, the result is exact. States
usually agree after a few rounds; with B blocks there are never more than log2(B) + 2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from recoflow.operators.skew import BLOCK, MAX_ROWS_PER_KEY, with_blocks
from recoflow.session import cut_lineage

STATE = T.ArrayType(T.LongType())
Step = Callable[[list[int], tuple], tuple[list[int], int]]


@dataclass(frozen=True)
class Fold:
    """A sequential rule.

    ``step(state, inputs)`` returns the next state and a verdict number for the row. ``inputs`` are
    bigint columns. With ``additive`` the state is a fixed list of counters and a later block is
    guessed by adding up the changes of the blocks before it; otherwise the exit is carried over.
    """

    step: Step
    inputs: Sequence[Column]
    initial: Column
    additive: int = 0


def _folder(step: Step, width: int, kept: int, summary: bool):
    """Batch function over sorted rows. The state restarts with each group; groups may span batches.

    The columns after the first ``kept`` ones are group, unit (a block of a key), entry state and
    inputs. A summary gives the states before and after each unit, otherwise each row its verdict.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = unit = state = started = None
        for batch in batches:
            groups, units = batch.column(kept).to_pylist(), batch.column(kept + 1).to_pylist()
            entries = batch.column(kept + 2)
            inputs = zip(*[batch.column(kept + 3 + i).to_pylist() for i in range(width)])
            verdicts, done = [], []
            for position, values in enumerate(inputs):
                if units[position] != unit:
                    if unit is not None:
                        done.append((unit, started, state))
                    if groups[position] != group:
                        group, state = groups[position], entries[position].as_py()
                    unit, started = units[position], state
                state, verdict = step(state, values)
                verdicts.append(verdict)
            if not summary:
                columns = [*batch.columns[:kept], pa.array(verdicts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], "_verdict"])
            elif done:
                yield _unit_states(done)
        if summary and unit is not None:
            yield _unit_states([(unit, started, state)])

    return run


def _unit_states(done: list[tuple]) -> pa.RecordBatch:
    states = pa.list_(pa.int64())
    units, starts, ends = zip(*done)
    return pa.RecordBatch.from_arrays(
        [pa.array(units, pa.string()), pa.array(starts, states), pa.array(ends, states)],
        names=["_unit", "_started", "_ended"])


def _name(parts: Sequence[str]) -> Column:
    """Several columns as one text; JSON quotes and escapes each part, so names cannot collide."""
    return F.to_json(F.struct(*[F.col(part).cast("string").alias(part) for part in parts]))


def _fold(rows: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold, entry: Column, summary: bool,
          chunk: str = BLOCK) -> DataFrame:
    """Run the rule over the (key, chunk) groups of ``rows``; a chunk is a run of blocks."""
    inputs = [column.cast("bigint").alias(f"_in{i}") for i, column in enumerate(fold.inputs)]
    plain = [name for name in rows.columns if name not in (BLOCK, "_entry", "_chunk")]
    kept = [] if summary else plain
    arranged = (
        rows.repartition(*keys, chunk)
        .sortWithinPartitions(*keys, *dict.fromkeys([chunk, BLOCK]), *order)
        .select(*kept, _name([*keys, chunk]).alias("_group"), _name([*keys, BLOCK]).alias("_unit"),
                entry.cast(STATE).alias("_entry"), *inputs)
    )
    run = _folder(fold.step, len(inputs), len(kept), summary)
    if summary:
        return arranged.mapInArrow(run, "_unit string, _started array<bigint>, _ended array<bigint>")
    schema = T.StructType([*[rows.schema[name] for name in plain], T.StructField("_verdict", T.LongType())])
    return arranged.mapInArrow(run, schema)


def _next_entry(keys: Sequence[str], additive: int) -> Column:
    """Entry state of a block implied by the states of all earlier blocks of its key."""
    before = Window.partitionBy(*keys).orderBy(BLOCK)
    if not additive:
        return F.coalesce(F.lag("_exit").over(before), F.col("_initial")).cast(STATE)
    changes = before.rowsBetween(Window.unboundedPreceding, -1)
    return F.array(*[
        F.col("_initial")[i] + F.coalesce(F.sum(F.col("_exit")[i] - F.col("_entry")[i]).over(changes), F.lit(0))
        for i in range(additive)
    ]).cast(STATE)


def sequential_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fold: Fold,
    verdict: str,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Fold the rows of each key in ``order`` and add the verdict of each row.

    ``order`` must identify a row within its key; its first column cuts hot keys into blocks.
    ``fold.initial`` may refer to columns that are constant per key.
    """
    rows, cut = with_blocks(df, keys, order[0], max_rows)
    if not cut:
        folded = _fold(rows, keys, order, fold, fold.initial, summary=False)
        return folded.withColumnRenamed("_verdict", verdict)

    parts = [*keys, BLOCK]
    per_key = Window.partitionBy(*keys)
    table = cut_lineage(
        rows.groupBy(*parts).agg(F.first(fold.initial.cast(STATE)).alias("_initial"))
        .withColumn("_blocks", F.count(F.lit(1)).over(per_key)).filter("_blocks > 1")
        .withColumn("_index", F.row_number().over(per_key.orderBy(BLOCK)) - 1)
        .select(*parts, "_index", "_initial", _name(parts).alias("_unit"), F.col("_initial").alias("_entry"),
                F.col("_initial").alias("_exit"), F.lit(True).alias("_changed"))
    )
    length = 1
    while not table.filter("_changed").isEmpty():
        # A run of blocks is folded from its first wrong block to its end.
        first_wrong = F.min(F.when(F.col("_changed"), F.col("_index"))).over(Window.partitionBy(*keys, "_chunk"))
        todo = (
            table.withColumn("_chunk", F.floor(F.col("_index") / length))
            .withColumn("_from", first_wrong).filter(F.col("_index") >= F.col("_from"))
            .select(*parts, "_chunk", "_entry")
        )
        states = _fold(rows.join(todo, parts), keys, order, fold, F.col("_entry"), summary=True, chunk="_chunk")
        updated = (
            table.join(states, "_unit", "left")
            .withColumn("_entry", F.coalesce("_started", "_entry")).withColumn("_exit", F.coalesce("_ended", "_exit"))
            .drop("_started", "_ended").withColumn("_next", _next_entry(keys, fold.additive))
        )
        table = cut_lineage(
            updated.withColumn("_changed", ~F.col("_next").eqNullSafe(F.col("_entry")))
            .withColumn("_entry", F.col("_next")).drop("_next")
        )
        length *= 2
    entered = rows.join(table.select(*parts, "_entry"), parts, "left")
    entry = F.coalesce(F.col("_entry"), fold.initial.cast(STATE))
    return _fold(entered, keys, order, fold, entry, summary=False).withColumnRenamed("_verdict", verdict)
