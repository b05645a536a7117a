"""Hard negatives by exact scores: subset-sum tables of anchors, indexed with the bit planes of candidates."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recoflow.llm.common import cut

POSITIVES, NEGATIVES, SCALE = 5, 10, 256
LOW_PERCENT, HIGH_PERCENT = 30, 90
SHARD_ROWS, LEAST_SHARD_ROWS, SHARDS_PER_CORE = 1 << 16, 1 << 10, 4
ANCHOR_BLOCK, CANDIDATE_BLOCK = 128, 4096
# Scores of blocks that may pass this bound are summed as Python's whole numbers instead of 64-bit ones.
SAFE = 1 << 62
MOST_DIGITS = 10 ** 38 - 1
# Vectors with a larger component stand in shards of their own, so that the others keep their 64-bit sums.
WIDE = float(1 << 12)
_SUBSETS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def whole(vectors: list, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit numbers, or as Python's whole numbers where one is too large for that."""
    scaled = np.floor(np.array(vectors, np.float64) * scale)
    if np.abs(scaled).max(initial=0) < SAFE:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled.tolist()], object)


def padded(vectors: np.ndarray) -> np.ndarray:
    more = -vectors.shape[1] % 8
    # Zeros of the same kind: Python's whole numbers must stay Python's.
    return np.concatenate([vectors, np.zeros((len(vectors), more), vectors.dtype)], axis=1) if more else vectors


class BitPlanes:
    """Candidates as packed bytes: eight components a byte, one plane for each bit of the two's complement."""

    def __init__(self, vectors: np.ndarray):
        vectors = padded(vectors)
        largest = max((max(abs(int(v)) for v in (vectors.min(), vectors.max())) if vectors.size else 0), 1)
        self.bits = largest.bit_length() + 1
        groups = vectors.reshape(len(vectors), -1, 8)
        weights = 1 << np.arange(8)
        self.planes = [(((groups >> b) & 1) @ weights).astype(np.uint8) for b in range(self.bits)]
        self.groups = groups.shape[1]

    def exact_in_64_bits(self, anchors: np.ndarray) -> bool:
        most = max((sum(abs(int(v)) for v in row) for row in anchors), default=0)
        return anchors.dtype != object and most << self.bits < SAFE

    def scores(self, tables: np.ndarray, first: int, after: int) -> np.ndarray:
        """Inner products [candidate, anchor]: per plane one lookup for each eight components, planes joined by shift and add."""
        total = None
        for bit in range(self.bits - 1, -1, -1):
            index = self.planes[bit][first:after]
            part = np.zeros((len(index), tables.shape[2]), tables.dtype)
            for group in range(self.groups):
                part += tables[group].take(index[:, group], axis=0)
            # The highest plane carries the sign.
            total = -part if total is None else (total << 1) + part
        return total


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[group, subset, anchor]: the sums of all 256 subsets of each eight components of each anchor."""
    groups = padded(anchors).reshape(len(anchors), -1, 8)
    return np.ascontiguousarray(np.moveaxis(groups @ _SUBSETS.T.astype(groups.dtype), 0, 2))


class Best:
    """The ``k`` best (score, id) of each slot. Candidates come with rising ids, so a tie with the kth never enters."""

    def __init__(self, k: int, slots: int):
        self.k, self.held = k, [[] for _ in range(slots)]
        self.kth: list[int | None] = [None] * slots

    def offer(self, slots: list[int], scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` and ``allowed`` are [candidate, slot], the columns being ``slots``."""
        known = [self.kth[s] for s in slots]
        if any(x is not None for x in known):
            bound = np.array([-SAFE if x is None else x for x in known], scores.dtype)
            free = np.array([x is None for x in known])
            allowed = allowed & ((scores > bound) | free)
        if scores.dtype != object and len(scores) > self.k and np.count_nonzero(allowed) > 4 * self.k * len(slots):
            floor = np.where(allowed, scores, -SAFE)
            allowed = allowed & (scores >= np.partition(floor, len(scores) - self.k, axis=0)[len(scores) - self.k])
        columns, rows = np.nonzero(allowed.T)
        found = scores[rows, columns].tolist()
        edges = np.searchsorted(columns, np.arange(len(slots) + 1)).tolist()
        names = ids[rows].tolist()
        for column, slot in enumerate(slots):
            a, z = edges[column], edges[column + 1]
            if a < z:
                held = sorted(self.held[slot] + list(zip(found[a:z], names[a:z])), key=lambda x: (-x[0], x[1]))[:self.k]
                self.held[slot] = held
                if len(held) == self.k:
                    self.kth[slot] = held[-1][0]


class Shard:
    """Candidates of one shard, sorted by id; anchors are scored against them block by block."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list, scale: int):
        self.ids, self.labels, self.scale = np.array(ids), np.array(labels), scale
        self.planes = BitPlanes(whole(vectors, scale))

    def blocks(self, vectors: list) -> Iterator[tuple[int, int, np.ndarray]]:
        anchors = whole(vectors, self.scale)
        fits = self.planes.exact_in_64_bits(anchors)
        tables = subset_sums(anchors if fits else anchors.astype(object))
        step = CANDIDATE_BLOCK if fits else 64
        for first in range(0, len(self.ids), step):
            after = min(first + step, len(self.ids))
            yield first, after, self.planes.scores(tables, first, after)

    def positives(self, anchors: list[tuple], k: int) -> Iterator[tuple]:
        """(anchor, twin, 0, id, score) of the best rows of an anchor's label."""
        best, own = Best(k, len(anchors)), np.array([a[0] for a in anchors])
        labels = np.array([a[2] for a in anchors])
        for first, after, scores in self.blocks([a[3] for a in anchors]):
            ids = self.ids[first:after]
            allowed = (self.labels[first:after, None] == labels) & (ids[:, None] != own)
            best.offer(list(range(len(anchors))), scores, allowed, ids)
        for anchor, held in zip(anchors, best.held):
            for score, row in held:
                yield anchor[0], anchor[1], 0, row, score

    def negatives(self, anchors: list[tuple], k: int, low: int, high: int) -> Iterator[tuple]:
        """(anchor, twin, place of the positive, id, score) of the best rows of other labels whose score lies between the bounds."""
        slots = [(i, place, -((-low * int(p)) // 100), high * int(p) // 100)
                 for i, a in enumerate(anchors) for place, p in enumerate(a[4])]
        slots = [s for s in slots if s[2] <= s[3]]
        best, labels, names = Best(k, len(slots)), np.array([a[2] for a in anchors]), np.array([a[0] for a in anchors])
        groups = [[n for n, s in enumerate(slots) if s[1] == place] for place in sorted({s[1] for s in slots})]
        for first, after, scores in self.blocks([a[3] for a in anchors]):
            ids = self.ids[first:after]
            other = (self.labels[first:after, None] != labels) & (ids[:, None] != names)
            for group in groups:
                at = [slots[n][0] for n in group]
                bounds = [[slots[n][j] for n in group] for j in (2, 3)]
                if scores.dtype != object:
                    bounds = [[min(max(x, -SAFE), SAFE) for x in side] for side in bounds]
                own = scores if len(at) == scores.shape[1] else scores[:, at]
                own_other = other if len(at) == scores.shape[1] else other[:, at]
                least, most = (np.array(side, scores.dtype) for side in bounds)
                best.offer(group, own, own_other & (own >= least) & (own <= most), ids)
        for (i, place, _, _), held in zip(slots, best.held):
            for score, row in held:
                yield anchors[i][0], anchors[i][1], place, row, score


def scored_rows(batches: Iterator[pa.RecordBatch], scale: int, k: int, bounds: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """A shard's candidates come first (kind 0), its anchors follow (kind 1) and stream past them in blocks."""
    number, points, shard = None, ([], [], []), None
    anchors: list[tuple] = []

    def flush() -> list[tuple]:
        if not anchors or shard is None:
            anchors.clear()
            return []
        found = shard.positives(anchors, k) if bounds is None else shard.negatives(anchors, k, *bounds)
        rows = list(found)
        anchors.clear()
        return rows

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
        scores = [Decimal(min(max(r[4], -MOST_DIGITS), MOST_DIGITS)) for r in rows]
        return pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.decimal128(38, 0))], names=["id", "twin", "place", "row", "score"])

    for batch in batches:
        out: list[tuple] = []
        names = ("shard", "kind", "id", "twin", "label", "vector", "asked")
        for at, kind, own, twin, label, vector, asked in zip(*[batch.column(name).to_pylist() for name in names]):
            if at != number:
                out += flush()
                number, points, shard = at, ([], [], []), None
            if kind == 0:
                for column, value in zip(points, (own, label, vector)):
                    column.append(value)
                continue
            if points[0]:
                shard, points = Shard(*points, scale), ([], [], [])
            anchors.append((own, twin, label, vector, asked or []))
            if len(anchors) >= ANCHOR_BLOCK:
                out += flush()
        yield batch_of(out)
    last = flush()
    if last:
        yield batch_of(last)


def usable(vectors: DataFrame) -> DataFrame:
    """``id``, ``label``, ``vector``: rows without any null or non-finite value in those columns."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return kept.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("vector"))


def as_long(score: Column) -> Column:
    """A whole decimal as a long; what is beyond 64 bits becomes the nearest long."""
    least, most = (F.lit(x).cast("decimal(38,0)") for x in (-(1 << 63), (1 << 63) - 1))
    return F.least(F.greatest(score, least), most).cast("long")


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
         low: int = LOW_PERCENT, high: int = HIGH_PERCENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has ``vec_id``, ``label``, ``embedding``. A score is the inner product of floor(``scale`` * x). Anchors are
    the rows whose id is divisible by ``every``; the first ``positives`` other rows of the same label are their positives;
    for each, the first ``negatives`` rows of other labels with ``low`` to ``high`` percent of the positive's score are
    returned. Higher scores come first, ties by smaller id.

    Candidates are dealt to shards of at most about ``shard_rows`` by a hash of the id, so equal vectors and labels
    spread over all; a shard's candidates fill one task's memory (packed bit planes) and anchors stream past them in
    blocks with their subset-sum tables. That is done twice: for the positives, then for the negatives between the
    bounds the positives set. Each shard returns at most ``positives`` or ``negatives`` rows per anchor or pair.

    Rows with a null id, label, vector or component or a non-finite component take no part. Only vectors of one length
    compare; empty vectors score 0. Rows that repeat an id are candidates each, but never of an anchor with that id; an
    anchor that repeats counts once per distinct label and vector. Sums are exact whatever the components' size; scores
    are ordered exactly up to 38 digits, and given as the nearest long beyond 64 bits. Other columns are ignored.
    """
    points = cut(usable(vectors))
    cores = points.sparkSession.sparkContext.defaultParallelism
    count = points.count()
    shards = max(-(-count // shard_rows), min(SHARDS_PER_CORE * cores, -(-count // LEAST_SHARD_ROWS)), 1)
    wide = F.exists("vector", lambda v: F.abs(v) > WIDE).cast("long")
    size = F.size("vector").cast("long")
    candidates = points.select(
        ((size * 2 + wide) * shards + F.pmod(F.xxhash64("id"), F.lit(shards))).alias("shard"), F.lit(0).alias("kind"), "id",
        F.lit(0).cast("long").alias("twin"), "label", "vector", F.lit(None).cast("array<decimal(38,0)>").alias("asked"))
    anchors = (points.where(F.col("id") % every == 0).distinct()
               .withColumn("twin", F.xxhash64("label", "vector")).withColumn("own_wide", wide))

    def scored(asking: DataFrame, k: int, bounds: tuple[int, int] | None) -> DataFrame:
        # The stated anchors against every shard, in blocks: one row per anchor and shard (two kinds of shards).
        asked = asking.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2 * shards - 1).cast("long")))).select(
            (size * 2 * shards + F.col("part")).alias("shard"), (F.lit(1) + F.col("own_wide").cast("int")).alias("kind"),
            "id", "twin", "label", "vector", "asked")
        rows = candidates.unionByName(asked)
        return (rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "id")
                .mapInArrow(lambda it: scored_rows(it, scale, k, bounds), "id long, twin long, place int, row long, score decimal(38,0)"))

    def first(rows: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("id", "twin", "place").orderBy(F.desc("score"), "row")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    nearest = cut(first(scored(anchors.withColumn("asked", F.lit(None).cast("array<decimal(38,0)>")), positives, None), positives)
                  .select("id", "twin", (F.col("rank") - 1).alias("place"), F.col("row").alias("positive_id"), F.col("score").alias("positive")))
    # At most ``positives`` rows each, in the order of their rank.
    lists = nearest.groupBy("id", "twin").agg(F.array_sort(F.collect_list(F.struct("place", "positive"))).alias("pairs"))
    asking = anchors.join(lists, ["id", "twin"]).withColumn("asked", F.transform("pairs", lambda p: p["positive"])).drop("pairs")
    found = first(scored(asking, negatives, (low, high)), negatives)
    return found.join(nearest, ["id", "twin", "place"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row").alias("negative_id"),
        as_long(F.col("positive")).alias("positive_score"), as_long(F.col("score")).alias("negative_score"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """Every seventh id takes the next of ten labels."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE label = anchor_label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.label
       AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
