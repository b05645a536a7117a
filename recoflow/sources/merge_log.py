"""A keyed table as a log of batches: a batch writes only itself, readers take the newest row of a key, runs are merged level by level.

Layout: ``runs/<first>-<last>/…`` holds the rows of the batches ``first`` to ``last``, ``commits/<first>-<last>`` says that the
run is complete. A complete run hides all complete runs that lie inside its range, so a merge becomes visible with its
one commit, and a writer lost before that leaves the table as it was.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

FANOUT, WRITERS = 8, 8
RUN, DELETED = "_run", "_deleted"
_COMMIT = "first long, last long, level int, schema string"


@dataclass(frozen=True)
class Run:
    first: int
    last: int
    level: int
    schema: str

    @property
    def name(self) -> str:
        return f"{self.first:019d}-{self.last:019d}"


def live_runs(commits: Sequence[Run]) -> list[Run]:
    """Runs that no other run covers, oldest first. Of two runs of one range (a replay after a merge) either holds the same rows."""
    wide = sorted(commits, key=lambda r: (r.first, -r.last))
    live: list[Run] = []
    for run in wide:
        if not live or run.last > live[-1].last:
            live.append(run)
    return live


class MergeLog:
    """A table at ``path`` with unique ``keys``, in folders by ``partition_by`` (columns that follow from the key).

    Batch ids must grow from batch to batch. Writing a batch again replaces its own run, also when that run has been merged
    meanwhile: then nothing is written at all, as the merged run already holds it.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str] = (),
                 fanout: int = FANOUT, writers: int = WRITERS):
        self.spark, self.path, self.keys, self.partition_by = spark, path.rstrip("/"), list(keys), list(partition_by)
        self.fanout, self.writers = fanout, writers

    def commits(self) -> list[Run]:
        try:
            rows = self.spark.read.schema(_COMMIT).json(f"{self.path}/commits/*")
            return [Run(*row) for row in rows.select("first", "last", "level", "schema").collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def runs(self) -> list[Run]:
        return live_runs(self.commits())

    def last_batch(self) -> int | None:
        """Highest batch id written, None for an empty log; a restarted stream goes on from here."""
        return max((run.last for run in self.runs()), default=None)

    def _write(self, rows: DataFrame, run: Run) -> None:
        # A hot partition is written by several tasks: the salt follows from the key, so a task that runs again writes the same rows.
        salt = F.pmod(F.xxhash64(*self.keys), F.lit(self.writers))
        dealt = rows.repartition(*self.partition_by, salt)
        (dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*self.partition_by)
         .parquet(f"{self.path}/runs/{run.name}"))
        commit = self.spark.createDataFrame([(run.first, run.last, run.level, run.schema)], _COMMIT)
        (commit.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").json(f"{self.path}/commits/{run.name}"))

    def first_batch_of(self, stream: str) -> int:
        """Batch id that batch 0 of a stream (named by its checkpoint folder) has here.

        A stream with a new checkpoint counts from 0 again; its batches go behind all that are written. The number is kept, so
        a stream that goes on with its checkpoint, and replays, find the same.
        """
        path, schema = f"{self.path}/streams", "stream string, first long"
        try:
            known = self.spark.read.schema(schema).json(path).filter(F.col("stream") == stream).agg(F.min("first")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            known = None
        if known is None:
            last = self.last_batch()
            known = 0 if last is None else last + 1
            self.spark.createDataFrame([(stream, known)], schema).coalesce(1).write.mode("append").json(path)
        return known

    def append(self, rows: DataFrame, batch_id: int) -> bool:
        """Write one batch; nothing else is read or written. Keys are unique within a batch; null keys are keys.

        A row whose ``_deleted`` is true removes its key. Returns whether anything was written.
        """
        inside = [run for run in self.commits() if run.first <= batch_id <= run.last and run.first < run.last]
        if inside:
            return False
        rows = rows if DELETED in rows.columns else rows.withColumn(DELETED, F.lit(False))
        self._write(rows, Run(batch_id, batch_id, 0, rows.schema.json()))
        return True

    def _rows_of(self, runs: Sequence[Run], where: Column | None) -> DataFrame:
        parts = []
        for run in runs:
            schema = StructType.fromJson(json.loads(run.schema))
            part = self.spark.read.schema(schema).parquet(f"{self.path}/runs/{run.name}")
            part = part.select(*schema.names, F.lit(run.last).cast("long").alias(RUN))
            parts.append(part if where is None else part.filter(where))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _newest(self, runs: Sequence[Run], where: Column | None) -> DataFrame:
        """Newest row of each key, removed keys included.

        Only the key and the run number are aggregated, and the whole rows are joined back on both, so wide rows are not
        sorted. A single run is read as it is.
        """
        rows = self._rows_of(runs, where)
        if len(runs) == 1:
            return rows.drop(RUN)
        names = [f"_key{i}" for i in range(len(self.keys))]
        newest = rows.groupBy(*[F.col(k).alias(n) for k, n in zip(self.keys, names)]).agg(F.max(RUN).alias("_newest"))
        same = [rows[k].eqNullSafe(newest[n]) for k, n in zip(self.keys, names)]
        return rows.join(newest, reduce(lambda a, b: a & b, same, rows[RUN] == newest["_newest"]), "left_semi").drop(RUN)

    def read(self, where: Column | None = None, before: int | None = None) -> DataFrame | None:
        """The table, newest row per key, without removed keys; None before the first batch.

        ``where`` must hold for all rows of a key or none (a filter on keys or partition columns) and prunes folders. With
        ``before`` only batches with a smaller id count, as far as they are not merged with later ones.
        """
        runs = [run for run in self.runs() if before is None or run.last < before]
        if not runs:
            return None
        return self._newest(runs, where).filter(~F.col(DELETED)).drop(DELETED)

    def compact(self, keep_open: int = 0, keep: Column | None = None) -> int:
        """Merge ``fanout`` neighbouring runs of a level into one of the next, as long as there are so many; returns the merges.

        The newest ``keep_open`` runs stay out, for readers that need to tell batches apart. A row is rewritten once per
        level, log(batches) times in all. Removals are forgotten when the oldest run takes part. Rows for which ``keep``
        does not hold are left out: it must be false for all older rows of a key where it is false for the newest.
        """
        done = 0
        while True:
            runs = self.runs()
            settled = runs[:len(runs) - keep_open] if keep_open else runs
            group = next((settled[i:i + self.fanout] for i in range(len(settled) - self.fanout + 1)
                          if len({r.level for r in settled[i:i + self.fanout]}) == 1), None)
            if group is None:
                return done
            merged = self._newest(group, None)
            if group[0] == runs[0]:
                merged = merged.filter(~F.col(DELETED))
            if keep is not None:
                merged = merged.filter(keep)
            self._write(merged, Run(group[0].first, group[-1].last, group[0].level + 1, merged.schema.json()))
            done += 1

    def hidden_runs(self) -> list[str]:
        """Folders under ``path`` that no reader of the present table needs; they may be deleted when no older reader is left."""
        live = {run.name for run in self.runs()}
        return [f"{kind}/{run.name}" for run in self.commits() if run.name not in live for kind in ("commits", "runs")]
