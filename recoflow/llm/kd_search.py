"""Exact top-k inner-product search: a KD-tree per shard, searched best-first by box bounds for blocks of queries, with the kth row carried along."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from recoflow.llm.common import cut

K, LEAF, SHARD_ROWS = 20, 128, 1 << 16
LONG = (1 << 63) - 1
#: How a vector of whole numbers is stored, by bytes a component: the first that holds it. Doubles are whole, too.
STORED = {1: np.dtype(np.int8), 2: np.dtype(np.int16), 4: np.dtype(np.int32), 8: np.dtype(np.float64)}
#: What sums of products are computed with: the first whose limit is above the product of both vectors' lengths, and so above every
#: partial sum. Below these limits floats add whole numbers exactly, in any order.
EXACT = ((2.0 ** 23, np.float32), (2.0 ** 52, np.float64), (2.0 ** 62, np.int64), (np.inf, object))
#: Queries searched at once, scores held at once, components turned into whole numbers at once.
BLOCK, SLAB, VALUES = 2048, 1 << 21, 1 << 20
#: A box is searched as a whole if this share of queries and boxes below has to be searched anyway.
DENSE = 0.75
#: Packed products serve while this share of the pairs at most is found by them, as each of those is looked at by itself.
FEW = 1 / 128
#: A round visits at most so many times the shards visited before, and all that is left if that is not much more.
FURTHER, REST = 3, 4


def as_long(scores: np.ndarray) -> np.ndarray:
    """Scores beyond a long become the nearest long; those of other types are exact as they are."""
    return np.clip(scores, -LONG - 1, LONG).astype(np.int64) if scores.dtype == object else scores


def typed(values: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers as another type that holds them."""
    if kind is object:
        return np.frompyfunc(int, 1, 1)(values).astype(object)
    return values.astype(kind)


def hits(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero``, faster where few are true."""
    packed = np.packbits(mask)
    some = np.flatnonzero(packed != 0)
    r, c = np.nonzero(np.unpackbits(packed[some, None], axis=1))
    return 8 * some[r] + c


class Best:
    """The ``k`` best rows of each query of a block: highest scores, ids ascending on ties. ``score`` and ``id`` are those of the
    kth row so far, where it is ``known``; what comes after it is turned away."""

    def __init__(self, own: np.ndarray, known: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
        self.own, self.known, self.score, self.id, self.k = own, known.copy(), score.copy(), ids.copy(), k
        self.rows, self.ids, self.scores = np.zeros((3, 0), np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.count = 0

    def open(self, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether the queries may still find something with a score up to the bound."""
        return (bounds >= self.score[rows]) | ~self.known[rows]

    def limits(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The least scores that count, where known: one as high as the kth does not if no id is below that of the kth."""
        limit = self.score[rows]
        return limit + ((self.id[rows] <= ids.min()) & (limit < LONG))

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> float:
        """``scores`` of the queries ``rows`` with the points ``ids``; gives the share that reached the limits."""
        known = self.known[rows]
        lowest = -np.inf if scores.dtype.kind == "f" else -LONG - 1
        limit = np.where(known, self.limits(rows, ids), lowest).astype(scores.dtype)
        new = np.flatnonzero(~known)
        if len(new) and len(ids) > self.k:
            # Of the first points that a query meets only the k best, and ties, are kept.
            seen = np.where(ids != self.own[rows[new], None], scores[new], scores.dtype.type(lowest))
            limit[new] = np.partition(seen, -self.k, axis=1)[:, -self.k]
        r, c = np.divmod(hits(scores >= limit[:, None]), len(ids))
        self.take(rows[r], ids[c], scores[r, c].astype(np.int64))
        if len(new) and self.count:
            self.settle()
        return len(r) / scores.size

    def take(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """One query, point and score at each place."""
        better = (scores > self.score[rows]) | ((scores == self.score[rows]) & (ids < self.id[rows])) | ~self.known[rows]
        kept = np.flatnonzero(better & (ids != self.own[rows]))
        self.waiting.append((rows[kept], ids[kept], scores[kept]))
        self.count += len(kept)
        if self.count >= 2 * self.k * len(self.own):
            self.settle()

    def settle(self) -> None:
        """Only the ``k`` best of each query stay."""
        rows, ids, scores = (np.concatenate(x) for x in zip((self.rows, self.ids, self.scores), *self.waiting))
        order = np.lexsort((ids, ~scores, rows))  # ~x falls as x grows, and unlike -x has no overflow
        first = np.searchsorted(rows[order], np.arange(len(self.own) + 1))
        order = order[np.arange(len(order)) - first[rows[order]] < self.k]
        self.rows, self.ids, self.scores = rows[order], ids[order], scores[order]
        first = np.searchsorted(self.rows, np.arange(len(self.own) + 1))
        full = np.flatnonzero(np.diff(first) == self.k)
        kth = first[full] + self.k - 1
        score, own = self.scores[kth], self.ids[kth]
        better = ~self.known[full] | (score > self.score[full]) | ((score == self.score[full]) & (own < self.id[full]))
        full, kth = full[better], kth[better]
        self.known[full], self.score[full], self.id[full] = True, self.scores[kth], self.ids[kth]
        self.waiting, self.count = [], 0


class Packed:
    """Which scores of a block reach their limits, by a product of doubles that hold the scores of several queries each.

    A sum is made to lie between 2^53 and 2^54, whose doubles have 52 bits in steps of 2. Each of ``fields`` queries has ``width`` of
    these bits, for score - limit + 2^(width - 1) + 1: the highest is set if the limit is reached. A score far below the limit makes
    its bits negative, which takes 1 from the bits above (hence the + 1) and may set the highest one, too; if those above all
    are negative, the sum falls below 2^53, which the lowest bit of the exponent tells (bit 52). So what is found may be too
    much and has to be looked at, but is never too little. All sums on the way are whole and below 2^54, hence exact.
    """

    def __init__(self, queries: np.ndarray, most: np.ndarray, centre: np.ndarray, fields: int):
        """``most``: no score of a query is larger, in size; ``centre``: about where they lie."""
        self.count, self.fields, self.width = len(queries), fields, 52 // fields
        self.half, self.groups = 1 << (self.width - 1), -(-len(queries) // fields)
        self.scale = 2.0 ** (self.width * np.arange(fields)[:, None] + 1)
        apart = np.zeros((fields * self.groups, queries.shape[1]))
        apart[:self.count] = queries
        self.factors = np.zeros((self.groups, queries.shape[1] + 1))
        self.factors[:, :-1] = (apart.reshape(fields, self.groups, -1) * self.scale[:, :, None]).sum(axis=0)
        # Limits must keep each query's scores within its bits. Lower ones than asked for find more: few, if scores keep near their centre.
        self.lowest = most - self.half + 2
        self.highest = np.minimum(2 * self.half - most, centre + self.half // 2)
        self.mask = np.uint64(sum(1 << (self.width * (j + 1) - 1) for j in range(fields)) | 1 << 52)

    @classmethod
    def fitting(cls, queries: np.ndarray, most: np.ndarray, centre: np.ndarray, limits: np.ndarray) -> Packed | None:
        """With as many fields as these limits, and higher ones, allow; two cost as much as a product of 32-bit floats."""
        for fields in (4, 3):
            packed = cls(queries, most, centre, fields)
            if (np.minimum(limits, packed.highest) >= packed.lowest).all():
                return packed
        return None

    def reached(self, points: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Queries and points, all whose score reaches the limit and a few others; nothing where they are many."""
        ones = np.ones((len(points), points.shape[1] + 1))
        ones[:, :-1] = points
        limit = np.full(self.fields * self.groups, 2)  # of a query that is not there: its scores are 0
        limit[:self.count] = np.minimum(limits, self.highest)
        self.factors[:, -1] = 2.0 ** 53 + ((self.half + 1 - limit).reshape(self.fields, self.groups) * self.scale).sum(axis=0)
        bits = (self.factors @ ones.T).view(np.uint64)
        bits &= self.mask
        places = hits(bits != 0)
        if len(places) > FEW * self.count * len(points):
            return None
        group, column = np.divmod(places, len(points))
        marks = bits.ravel()[places].astype(np.int64)
        rows, columns = [], []
        for field in range(self.fields):
            some = np.flatnonzero(marks & (1 << (self.width * (field + 1) - 1) | 1 << 52))
            rows.append(field * self.groups + group[some])
            columns.append(column[some])
        rows, columns = np.concatenate(rows), np.concatenate(columns)
        there = rows < self.count
        return rows[there], columns[there]


class KDTree:
    """Median splits of the widest side down to leaves; every node is a run of the points, with their tight box."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points = ids.copy(), points.copy()
        self.children: list[tuple[int, int] | None] = []
        self.runs: list[tuple[int, int]] = []
        low, high = [], []
        stack = [(0, len(ids), -1)]
        while stack:
            start, end, parent = stack.pop()
            number = len(self.children)
            if parent >= 0:
                self.children[parent] = (*(self.children[parent] or ()), number)
            own = self.points[start:end]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            self.children.append(None)
            self.runs.append((start, end))
            wide = high[-1].astype(np.float64) - low[-1]
            if end - start > LEAF and wide.max(initial=0) > 0:
                half = (end - start) // 2
                order = np.argpartition(own[:, int(wide.argmax())], half)
                stack += [(start, start + half, number), (start + half, end, number)]
            else:
                # Equal points beyond a leaf's size stay together: no split tells them apart.
                order = np.argsort(self.ids[start:end], kind="stable")
            self.points[start:end], self.ids[start:end] = own[order], self.ids[start:end][order]
        self.low, self.high = np.array(low), np.array(high)
        # A node's number is followed by those of all boxes below it.
        self.below = [1] * len(self.children)
        for number in reversed(range(len(self.children))):
            self.below[number] += sum(self.below[child] for child in self.children[number] or ())
        with np.errstate(over="ignore"):
            self.length = length(np.maximum(np.abs(self.low[:1].astype(np.float64)), np.abs(self.high[:1].astype(np.float64))))[0]
        # Boxes by kind of sums; points stay as narrow as they are and are widened where they are met.
        self.kinds: dict[type, tuple[np.ndarray, np.ndarray]] = {}
        self.longest: float | None = None

    def search(self, queries: np.ndarray, best: Best) -> None:
        """Every box that may hold one of the best of a query of the block is opened for those queries, the most promising box first."""
        with np.errstate(over="ignore", invalid="ignore"):
            sums = length(queries) * self.length * (1 + 1e-9)
        tier = np.searchsorted([limit for limit, _ in EXACT[:-1]], np.nan_to_num(sums, nan=np.inf), side="right")
        for number in np.unique(tier):
            rows = np.flatnonzero(tier == number)
            self._search(rows, queries[rows], best, EXACT[number][1])

    def _search(self, rows: np.ndarray, queries: np.ndarray, best: Best, kind: type) -> None:
        if kind not in self.kinds:
            self.kinds[kind] = typed(self.low, kind), typed(self.high, kind)
        low, high = self.kinds[kind]
        queries = typed(queries, kind)
        # The largest score any point of each box can have, per node and query.
        bounds = as_long(high @ np.maximum(queries, 0).T + low @ np.minimum(queries, 0).T)
        step = max(1, SLAB // len(rows))
        packed, packs, share = None, kind is np.float32, 1.0
        queue = [(-int(bounds[0].max()), 0)]
        while queue:
            _, node = heapq.heappop(queue)
            wanted = best.open(rows, bounds[node])
            if not wanted.any():
                continue
            start, end = self.runs[node]
            if self.children[node] and (end - start > step or best.open(rows, bounds[node:node + self.below[node]]).mean() < DENSE):
                for child in self.children[node]:
                    heapq.heappush(queue, (-int(bounds[child].max()), child))
                continue
            # A leaf, or a box of which most queries want most of what is below.
            places = np.flatnonzero(wanted)
            asked, asking = (rows[places], queries[places]) if len(places) < DENSE * len(rows) else (rows, queries)
            for first in range(start, end, step):
                after = min(end, first + step)
                ids, points = self.ids[first:after], self.points[first:after]
                found = None
                if packs and share < FEW / 2 and asked is rows and best.known[rows].all():
                    packed = packed or self.packed(queries, best.score[rows])
                    found = packed and packed.reached(points, best.limits(rows, ids))
                    packs = found is not None  # else these scores do not fit packed products
                if found is None:
                    share = best.offer(asked, ids, as_long(asking @ typed(points, kind).T))
                else:
                    r, c = found
                    best.take(rows[r], ids[c], np.einsum("ij,ij->i", queries[r], typed(points[c], kind)).astype(np.int64))

    def packed(self, queries: np.ndarray, limits: np.ndarray) -> Packed | None:
        if self.longest is None:
            self.longest, self.mean = max(length(self.points[i:i + LEAF]).max() for i in range(0, len(self.points), LEAF)), self.points.mean(axis=0, dtype=np.float64)
        most = np.ceil(length(queries) * self.longest * (1 + 1e-9)).astype(np.int64) + 1
        return Packed.fitting(queries, most, np.floor(queries @ self.mean).astype(np.int64), limits)


def length(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def packed_rows(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """``id``, ``size``, ``width``, ``vector``: floor(scale * x) of vectors whose components are all finite, as ``STORED``."""
    for whole in batches:
        column = whole.column(1)
        values = max(1, column.offsets[-1].as_py() - column.offsets[0].as_py()) if whole.num_rows else 1
        rows = max(1, VALUES * whole.num_rows // values)
        for batch in (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)):
            ids, column = batch.column(0).to_numpy(), batch.column(1)
            offsets = column.offsets.to_numpy()
            values = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)  # a null becomes NaN
            starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
            for size in np.unique(sizes).tolist():
                rows_of = np.flatnonzero(sizes == size)
                x = values[starts[rows_of][:, None] + np.arange(size)]
                good = np.isfinite(x).all(axis=1)
                # Doubles beyond 2^53 are whole already; + 0.0 makes -0.0 a zero like all others.
                x, own = np.floor(x[good] * float(scale)) + 0.0, ids[rows_of[good]]
                largest = np.abs(x).max(axis=1, initial=0)
                widths = np.select([largest < 1 << 7, largest < 1 << 15, largest < 1 << 31], [1, 2, 4], 8)
                for width in np.unique(widths).tolist():
                    these = np.flatnonzero(widths == width)
                    n, data = len(these), x[these].astype(STORED[width])
                    ends = (np.arange(n + 1) * size * width).astype(np.int32)
                    vectors = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())])
                    yield pa.RecordBatch.from_arrays([pa.array(own[these]), pa.array(np.full(n, size, np.int32)),
                                                      pa.array(np.full(n, width, np.int32)), vectors], names=["id", "size", "width", "vector"])


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Width, rows and matrix for each width of a batch whose vectors are of one length."""
    widths, vectors, size = batch.column("width").to_numpy(), batch.column("vector"), batch.column("size")[0].as_py()
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        data = b"".join(vectors.take(pa.array(rows)).to_numpy(zero_copy_only=False))
        yield width, rows, np.frombuffer(data, STORED[width]).reshape(len(rows), size)


def search_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A shard's points come first (kind 0), its queries follow (kind 1) and stream through its trees: one for each width, so that a
    few large points do not slow the others down."""
    shard, points, trees = None, defaultdict(list), None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        numbers, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), batch.num_rows]
        out = [(np.zeros(0, np.int64),) * 3]
        for first, after in zip(cuts, cuts[1:]):
            if numbers[first] != shard:
                shard, points, trees = numbers[first], defaultdict(list), None
            part = batch.slice(first, after - first)
            if kinds[first] == 0:
                ids = part.column("id").to_numpy()
                for width, rows, vectors in unpacked(part):
                    points[width].append((ids[rows], vectors))
                continue
            if trees is None:
                trees = [KDTree(*map(np.concatenate, zip(*points.pop(width)))) for width in sorted(points)]
            for begin in range(0, part.num_rows, BLOCK):
                block = part.slice(begin, BLOCK)
                least = block.column("least")
                columns = (block.column("id").to_numpy(), ~np.asarray(least.is_null()),
                           least.fill_null(0).to_numpy(), block.column("least_id").fill_null(0).to_numpy())
                for _, rows, vectors in unpacked(block):
                    best = Best(*(c[rows] for c in columns), k)
                    for tree in trees:
                        tree.search(vectors, best)
                    best.settle()
                    out.append((best.own[best.rows], best.ids, best.scores))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["query_id", "vec_id", "score"])


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """``id``, ``size``, ``width``, ``vector``: floor(scale * x) of usable vectors, packed; see ``top_k``."""
    there = vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull())
    rows = there.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    return rows.mapInArrow(lambda it: packed_rows(it, scale), "id long, size int, width int, vector binary")


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, every: int = 20, k: int = K, scale: int = 64, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` highest inner products of each query, ties to smaller ids.

    Queries are rows whose id is divisible by ``every``, candidates all other rows. Points are dealt to shards of about
    ``shard_rows`` by a hash of the id, so equal vectors spread over all shards. A shard's points fill one task's
    memory; queries stream in blocks, whose scores with a leaf are one matrix product. Each query first visits one shard;
    its kth row there is a bound that the other shards start from, so most of their boxes are never opened where boxes tell
    points apart, and few of their rows are returned. Many shards are visited in rounds, each with the kth row of those before.

    Vectors that are null, or hold a null or non-finite component, take no part; nor do rows without an id. Only vectors
    of one length compare. Large components are computed with whole numbers of any size; a score that does not fit a
    long is given as the nearest long, and such scores tie.
    Rows that repeat an id are candidates each; a query that repeats counts once per distinct vector. Empty vectors score 0.
    """
    points = cut(quantised(vectors, scale))
    queries = cut(points.where(F.col("id") % every == 0).distinct())
    shards = max(1, -(-points.count() // shard_rows))
    shard_of = F.pmod(F.xxhash64("id"), F.lit(shards))
    number = F.col("size").cast("long") * shards
    bare = [F.lit(None).cast("long").alias("least"), F.lit(None).cast("long").alias("least_id")]
    packed = ["id", "size", "width", "vector", "least", "least_id"]
    dealt = points.select("*", *bare).select((number + shard_of).alias("shard"), F.lit(0).alias("kind"), *packed)

    def searched(asked: DataFrame) -> DataFrame:
        rows = dealt.unionByName(asked.select("shard", F.lit(1).alias("kind"), *packed))
        # A shard is a partition: hashed, several would meet in one task while others have none.
        return (rows.repartitionById(shards, F.pmod("shard", F.lit(shards)).cast("int")).sortWithinPartitions("shard", "kind")
                .mapInArrow(lambda it: search_rows(it, k), "query_id long, vec_id long, score long"))

    found = searched(queries.select("*", *bare).withColumn("shard", number + shard_of))
    visited = 1
    while visited < shards:
        found = cut(_best(found, k))
        kth = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"), F.col("vec_id").alias("least_id"))
        rest = shards - visited
        visits = rest if rest <= REST * visited else FURTHER * visited
        # The query set against further shards, in blocks: one row per query and shard.
        turn = F.explode(F.sequence(F.lit(visited), F.lit(visited + visits - 1)))
        away = queries.join(kth, "id", "left").withColumn("turn", turn)
        away = away.withColumn("shard", number + F.pmod(shard_of + F.col("turn"), F.lit(shards)))
        found = found.drop("rank").unionByName(searched(away))
        visited += visits
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""
