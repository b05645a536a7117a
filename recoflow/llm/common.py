"""Helpers shared by the operators: tables, shared storage, vectorised hashing of words, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from recoflow.session import shared_checkpoint_dir

CHUNK_BYTES = 1 << 20
#: Bytes of text that ``text_slices`` hands on at a time.
SLICE_BYTES = 1 << 18
#: Places of the bitmaps of ``sifted``: 8 MB in all, however many ids there are.
SIFT_BITS = 1 << 26
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it again: lost executors cost no recomputation."""
    path = f"{shared_checkpoint_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def python_rows(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns only, so that no other column (whatever its name or type) reaches Python."""
    return df.select(*[F.col(f"`{name}`") for name in columns])


def sifted(rows: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose ``column`` is in ``ids`` (one column), and few others: what a later join drops leaves before its exchange.

    The hashed ids are bits in bitmaps of bounded size, which are broadcast. More ids than places let more rows pass, never fewer.
    """
    names = rows.columns
    place = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(SIFT_BITS))
    maps = (ids.select(place.alias("__place")).groupBy(F.bitmap_bucket_number("__place").alias("__map"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__place")).alias("__bits")))
    placed = rows.withColumn("__place", F.pmod(F.xxhash64(F.col(column)), F.lit(SIFT_BITS)))
    placed = placed.withColumn("__map", F.bitmap_bucket_number("__place")).withColumn("__place", F.bitmap_bit_position("__place"))
    byte = F.expr("int(conv(hex(substring(__bits, int(__place div 8) + 1, 1)), 16, 10))")
    return placed.join(F.broadcast(maps), "__map").where(byte.bitwiseAND(F.expr("shiftleft(1, int(__place % 8))")) != 0).select(*names)


# Vectorised hashing. All arithmetic is modulo 2**64.

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (finaliser of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


class Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            steps = np.full(size, self.base, _U)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps = np.full(size, self.inverse, _U)
            steps[0] = 1
            self.down = np.multiply.accumulate(steps)
        return self.up[:n], self.down[:n]


_BYTE_POWERS = Powers(0x5851F42D4C957F2D)
_WORD_POWERS = (Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5))
_BYTES = _table(0x1234567)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True


def runs_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; equal bytes give equal hashes wherever they stand."""
    up, down = _BYTE_POWERS.take(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def windows_hash(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, way: int = 0) -> np.ndarray:
    """A hash of ``words[start:end]`` for each window; the two ways are independent."""
    up, down = _WORD_POWERS[way].take(len(words) + 1)
    sums = np.zeros(len(words) + 1, _U)
    own = words if way == 0 else mix(words + _U(0x632BE59BD9B4E019))
    np.cumsum(own * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of the runs without ASCII white space."""
    full = np.empty(len(data) + 2, bool)
    full[0] = full[-1] = False
    np.logical_not(SPACES[data], out=full[1:-1])
    edges = np.flatnonzero(full[1:] != full[:-1])
    return edges[0::2], edges[1::2]


def text_slices(batches: Iterator[pa.RecordBatch], *columns: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in slices with about ``limit`` bytes in the text columns (a longer text ends its slice).

    Spark's batches hold 10,000 rows whatever their texts' size. A worker that turns a whole one into Python objects keeps that
    memory for the tasks that follow, as freed objects seldom leave the process.
    """
    for batch in batches:
        before = np.zeros(batch.num_rows + 1, np.int64)
        for i in columns:
            before[1:] += np.cumsum(pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False))
        place = before[:-1] // limit
        cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), batch.num_rows]
        for first, after in zip(cuts, cuts[1:]):
            yield batch.slice(first, after - first)


def text_chunks(texts: list[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts as UTF-8, a space after each, in chunks of about ``limit`` bytes (a longer text is a chunk of its own).

    Yields first index, index after the last, the bytes, and where each text begins and the chunk ends.
    """
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append((text or "").encode("utf-8", "replace") + b" ")
        size += len(held[-1])
        if size >= limit or i + 1 == len(texts):
            bounds = np.zeros(len(held) + 1, np.int64)
            np.cumsum([len(x) for x in held], out=bounds[1:])
            yield first, i + 1, np.frombuffer(b"".join(held), np.uint8), bounds
            first, held, size = i + 1, [], 0


def hashed_words(data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, byte starts, byte ends, and the index of the first word of each text (and the number of words)."""
    starts, ends = word_spans(data)
    words = runs_hash(_LOWER[data] if lower else data, starts, ends)
    return words, starts, ends, np.searchsorted(starts, bounds)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def struct_lists(column: pa.ListArray) -> list[list[tuple]]:
    """The structs of each list as tuples; a null list is empty."""
    if len(column) == 0:
        return []
    offsets, null = column.offsets.to_pylist(), column.is_null().to_pylist()
    low = offsets[0]
    fields = column.values.slice(low, offsets[-1] - low)  # of a slice only what it holds
    values = list(zip(*[fields.field(i).to_pylist() for i in range(fields.type.num_fields)]))
    return [[] if null[i] else values[offsets[i] - low:offsets[i + 1] - low] for i in range(len(column))]


def labelled_sample(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """``doc_id`` and ``column`` of at most ``rows`` labelled documents, the first by a hash of the id; small enough to broadcast."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (the last one the constant) of a ridge logistic regression by Newton steps; a missing class gives a constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        w[-1] = 0.0 if len(y) == 0 else 4.0 * (2 * y[0] - 1)
        return w
    penalty = np.diag([ridge * len(y)] * (x.shape[1] - 1) + [1e-9])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def pairs_once(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).where(F.col(a) != F.col(b)).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int | None = None) -> DataFrame:
    """``node``, ``component``: the smallest id reachable over the undirected links, for every id that has one.

    Large-star and small-star rounds: each one moves links toward the smallest neighbour, the number of links never
    grows, and the last rounds leave one star per component. A hub is a join key of skewed size, not a group.
    Stopped after ``rounds``, the result may still split a component, but never joins two.
    """
    edges = cut(pairs_once(links, a, b).select(F.col(b).alias("u"), F.col(a).alias("v")))
    before, done = None, 0
    while rounds is None or done < rounds:
        done += 1
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        # One row gives both its links: a union of two selections would plan all of the above twice.
        moved = F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        after = large.join(down, "u").select(moved).where("u <> v").distinct()
        # The state is counted while the links are written, not by a job of its own.
        seen = Observation()
        edges = cut(after.observe(seen, F.count("*").alias("links"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("names")))
        if rounds == done:
            break
        state = seen.get
        if state == before or state["links"] == 0:
            break
        before = state
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    if rounds is None:
        return pairs.unionByName(centres)  # stars: no centre has a centre
    pairs = pairs.groupBy("node").agg(F.min("component").alias("component"))
    return pairs.unionByName(centres.join(pairs.select("node"), "node", "left_anti"))
