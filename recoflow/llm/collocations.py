"""Phrase collocations by Toivonen's method: a sample proposes phrases and their border, whole passes count both exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recoflow.llm.common import _BYTES, _LOWER, cut, mix, text_chunks

LEAST, COVERED_PERCENT, TOP, LONGEST = 10, 50, 2000, 3
#: One document in so many is in the sample, chosen by a hash of its text.
SAMPLE_SHARE = 16
#: Bits of a proposal bitmap for each item, and at most; what is broadcast and sent to the driver never exceeds them.
BITS_PER_ITEM, BITS = 16, 1 << 26
HOT_PARTS, SALTS, CHUNK, SHORT, ROWS = 256, 32, 3 << 20, 48, 1 << 15
_U = np.uint64
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_COUNTS = "lang string, k int, phrase string, n long"


class Proposal:
    """Hashed sets of words and of word pairs. A pair is asked for if both its words are in, a triple if both its pairs are.

    The asked phrases hold all that were frequent in what the sets were built from and their negative border (phrases
    that were not, though all their parts were). A hash that collides asks for more phrases, never for fewer.
    """

    def __init__(self, words: np.ndarray, pairs: np.ndarray):
        self.words, self.pairs = words, pairs

    @staticmethod
    def _in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = hashes % _U(len(bitmap) * 64)
        return (bitmap[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) != 0

    def asks(self, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word, pair = self._in(self.words, words), self._in(self.pairs, pairs)
        return word[:-1] & word[1:], pair[:-1] & pair[1:]


def lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _spread(shifts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, …, each run of the given size shifted."""
    at = np.repeat(shifts.astype(np.int32) if len(sizes) and sizes.sum() < 1 << 30 else shifts, sizes)
    at += np.arange(len(at), dtype=at.dtype)
    return at


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, all words a byte at a time, the long ones one by one."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    at, active = starts[order], np.searchsorted(-sizes[order], -np.arange(SHORT), "left")
    own = np.zeros(len(order), _U)
    for place, count in enumerate(active.tolist()):
        if not count:
            break
        own[:count] = (own[:count] + _BYTES[data[at[:count] + place]]) * _U(0xD1342543DE82EF95)
    for i in range(int(np.searchsorted(-sizes[order], -SHORT, "left"))):
        word = data[at[i]:at[i] + sizes[order[i]]].tobytes()
        own[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    hashes = np.empty(len(order), _U)
    hashes[order] = own
    return mix(hashes + sizes.astype(_U))


class Chunk:
    """Words of some texts: hashes that depend on the language, and which neighbours stand in one piece."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: list[str]):
        kind = _KIND[data]
        kind[bounds[1:] - 1] = 2
        full = np.zeros(len(data) + 2, bool)
        full[1:-1] = kind == 0
        edges = np.flatnonzero(full[1:] != full[:-1])
        self.starts, self.ends = edges[0::2].copy(), edges[1::2].copy()
        del full, edges
        self.data = _LOWER[data]
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        self.owner = np.searchsorted(bounds, self.starts, "right") - 1
        names = {lang: lang_hash(lang) for lang in set(langs)}
        own = np.array([names[x] for x in langs], _U)
        self.words = mix(word_hashes(self.data, self.starts, self.ends) ^ own[self.owner])
        self.pairs = mix(self.words[:-1] * _U(3) + self.words[1:])
        self.pair_stands = piece[:-1] == piece[1:]
        self.place: np.ndarray | None = None

    def phrases(self, k: int, hashes: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
        """First word, count and text of each distinct phrase of ``k`` words among the occurrences ``at``, some at a time."""
        if not len(at):
            return
        own = hashes[at]
        order = np.argsort(own)
        own = own[order]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts = np.diff(np.concatenate([new, [len(own)]]))
        at = at[order[new]]
        del own, order, new
        if self.place is None:
            self._space_joined()
        for first in range(0, len(at), ROWS):
            part = at[first:first + ROWS]
            begins = self.place[part]
            sizes = self.place[part + k] - 1 - begins
            offsets = np.zeros(len(part) + 1, np.int64)
            np.cumsum(sizes, out=offsets[1:])
            text = self.plain[_spread(begins - offsets[:-1], sizes)]
            strings = pa.LargeStringArray.from_buffers(len(part), pa.py_buffer(offsets), pa.py_buffer(text))
            yield part, counts[first:first + ROWS], strings.cast(pa.string())

    def _space_joined(self) -> None:
        """The words with one space after each, and where each begins."""
        sizes = self.ends - self.starts + 1
        self.place = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=self.place[1:])
        self.plain = self.data[_spread(self.starts - self.place[:-1], sizes)]
        self.plain[self.place[1:] - 1] = 0x20


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, list[str]]]:
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for first, after, data, bounds in text_chunks(batch.column(0).to_pylist(), CHUNK):
            yield Chunk(data, bounds, langs[first:after]), langs[first:after]


def count_rows(batches: Iterator[pa.RecordBatch], proposals: list[Proposal]) -> Iterator[pa.RecordBatch]:
    """Counts per chunk of the phrases that the last of the proposals asks for and none before did.

    Without any (the sample) all words and pairs count. The first whole pass also counts all words, and the words of
    each language as the empty phrase.
    """
    now, before = (proposals[-1], proposals[:-1]) if proposals else (None, [])
    for chunk, langs in chunks(batches):
        if not len(chunk.words):
            continue
        pair, triple = chunk.pair_stands.copy(), chunk.pair_stands[:-1] & chunk.pair_stands[1:]
        if now is None:
            triple[:] = False
        else:
            asked = now.asks(chunk.words, chunk.pairs)
            pair &= asked[0]
            triple &= asked[1]
            for earlier in before:
                asked = earlier.asks(chunk.words, chunk.pairs)
                pair &= ~asked[0]
                triple &= ~asked[1]
        names = pa.array(langs, pa.string())

        def rows(k: int, hashes: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
            for place, counts, phrases in chunk.phrases(k, hashes, at):
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(chunk.owner[place])), pa.array(np.full(len(place), k, np.int32)), phrases,
                     pa.array(counts.astype(np.int64))], names=["lang", "k", "phrase", "n"])

        yield from rows(2, chunk.pairs, np.flatnonzero(pair))
        if now is not None:
            at = np.flatnonzero(triple)
            hashes = np.zeros(len(chunk.words), _U)
            hashes[at] = mix(chunk.pairs[at] * _U(5) + chunk.words[at + 2])
            yield from rows(3, hashes, at)
        if not before:
            yield from rows(1, chunk.words, np.arange(len(chunk.words)))
        if not before:
            sums: dict[str, int] = {}
            for lang, n in zip(langs, np.bincount(chunk.owner, minlength=len(langs)).tolist()):
                sums[lang] = sums.get(lang, 0) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([0] * len(sums), pa.int32()), pa.array([""] * len(sums), pa.string()),
                 pa.array(list(sums.values()), pa.int64())], names=["lang", "k", "phrase", "n"])


def _hashes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """``k`` (1 or 2) and hashes of the words or pairs of a batch of (phrase, lang, k)."""
    sizes = np.array(batch.column(2).to_pylist(), np.int64)
    for k in (1, 2):
        part = batch.filter(pa.array(sizes == k))
        for chunk, _ in chunks([part]):
            # Each phrase is a text of its own, so all neighbours in one piece are its pairs.
            yield k, chunk.words if k == 1 else chunk.pairs[chunk.pair_stands]


def bit_rows(batches: Iterator[pa.RecordBatch], bits: dict[int, int]) -> Iterator[pa.RecordBatch]:
    maps = {k: np.zeros(n // 64, _U) for k, n in bits.items()}
    for batch in batches:
        for k, hashes in _hashes(batch):
            at = hashes % _U(bits[k])
            np.bitwise_or.at(maps[k], (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
    for k, bitmap in maps.items():
        used = np.flatnonzero(bitmap)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(used), k, np.int32)), pa.array(used), pa.array(bitmap[used].view(np.int64))], names=["k", "slot", "bits"])


def failure_rows(batches: Iterator[pa.RecordBatch], proposal: Proposal) -> Iterator[pa.RecordBatch]:
    missing = 0
    for batch in batches:
        for k, hashes in _hashes(batch):
            missing += int(np.count_nonzero(~proposal._in(proposal.words if k == 1 else proposal.pairs, hashes)))
    yield pa.RecordBatch.from_arrays([pa.array([missing], pa.int64())], names=["missing"])


def proposal_of(frequent: DataFrame, bits: int = BITS) -> Proposal:
    """The words and pairs among ``frequent`` as bitmaps; ``bits`` / 64 numbers each reach the driver at most."""
    found = {r[0]: r[1] for r in frequent.where("k in (1, 2)").groupBy("k").count().collect()}
    sizes = {k: min(bits, 1 << max(10, (BITS_PER_ITEM * found.get(k, 0)).bit_length())) for k in (1, 2)}
    rows = (frequent.where("k in (1, 2)").select("phrase", "lang", "k").mapInArrow(lambda it: bit_rows(it, sizes), "k int, slot long, bits long")
            .groupBy("k", "slot").agg(F.bit_or("bits").alias("bits")).toArrow())
    k, slot, value = (rows.column(i).to_numpy() for i in range(3))
    maps = []
    for wanted in (1, 2):
        bitmap = np.zeros(sizes[wanted] // 64, np.int64)
        bitmap[slot[k == wanted]] = value[k == wanted]
        maps.append(bitmap.view(_U))
    return Proposal(*maps)


def frequent_phrases(docs: DataFrame, least: int = LEAST, sample_share: int = SAMPLE_SHARE, bits: int = BITS) -> tuple[DataFrame, int]:
    """``lang``, ``k``, ``phrase``, ``n`` of all phrases of one to three words with ``n >= least`` (k = 0: all words), and the passes.

    The sample (one text in ``sample_share``, by hash) proposes the words and pairs that reach the lowered threshold there; the
    first whole pass counts all words and all phrases the proposal asks for. As long as a frequent word or pair lies outside
    the last proposal, all that are known to be frequent make the next one, and a further pass counts what no earlier one did.
    Every count comes from a whole pass. With three words at most three passes are needed.
    """
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    context = docs.sparkSession.sparkContext

    def counted(source: DataFrame, now, before: list, threshold: int) -> DataFrame:
        # Plain arrays only: workers need no class of this package to read them.
        shared = context.broadcast([(p.words, p.pairs) for p in (*before, *([now] if now else []))])
        rows = source.mapInArrow(lambda it: count_rows(it, [Proposal(*x) for x in shared.value]), _COUNTS)
        # Tasks have counted already: dealt out first, rows meet one hash table, in small partitions, instead of one per task and one after.
        dealt = rows.repartition("lang", "k", "phrase")
        done = cut(dealt.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= threshold) | (F.col("k") == 0)))
        shared.destroy()
        return done

    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(sample_share)) == 0)
    lowered = max(1, least * 4 // (5 * sample_share))
    proposals, known = [proposal_of(counted(sample, None, [], lowered), bits)], None
    while True:
        new = counted(texts, proposals[-1], proposals[:-1], least)
        known = new if known is None else known.unionByName(new)
        last = context.broadcast((proposals[-1].words, proposals[-1].pairs))
        missing = (known.where("k in (1, 2)").select("phrase", "lang", "k")
                   .mapInArrow(lambda it: failure_rows(it, Proposal(*last.value)), "missing long").agg(F.sum("missing")).first()[0])
        last.destroy()
        if not missing:
            return known, len(proposals)
        proposals.append(proposal_of(known, bits))


def _with_count(rows: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """``rows`` with the count of ``part`` as ``name``. Parts that more than a 256th of the rows have are joined by broadcast."""
    keys = ["lang", part]
    table = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    often = rows.groupBy(*keys).count().where(F.col("count") * HOT_PARTS > rows.count()).select(*keys)
    # Fewer than HOT_PARTS keys can be that frequent.
    hot = F.broadcast(cut(table.join(F.broadcast(often), keys)))
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(table, keys))


def _part(first: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(docs: DataFrame, least: int = LEAST, covered_percent: int = COVERED_PERCENT, top: int = TOP,
                 sample_share: int = SAMPLE_SHARE, bits: int = BITS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the ``top`` phrases of each language.

    ``docs`` has ``text`` and ``lang``. Candidates are phrases of two or three words with a = f(phrase) >= ``least``; the score is
    the lowest over the cuts of floor(10^6 a a / (l r)). A candidate goes if a longer one that holds it has ``covered_percent`` of
    its count or more. Products are decimals, exact for counts of up to 15 digits.

    Tasks count phrases of about three megabytes of text before any shuffle, so a hot phrase or language reaches a reducer
    as one row per task. Only bitmaps of fixed size are broadcast. A language's ranking is cut in ``SALTS`` parts first.

    Null texts are empty; a null language is ``und``. Rows that repeat count each time. An empty table gives no rows. Ties are
    decided by the phrase, so the result is the same at every run. Inside one chunk phrases are told apart by 64-bit hashes.
    Other columns are ignored.
    """
    counts, _ = frequent_phrases(docs, least, sample_share, bits)
    candidates = counts.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = (candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
            .select("lang", "phrase", "k", "a", "cut", _part(1, F.col("cut")).alias("left_part"),
                    _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right_part")))
    parts = counts.where(f"k between 1 and {LONGEST - 1}")
    joined = _with_count(cut(_with_count(cuts, parts, "left_part", "l")), parts, "right_part", "r")
    a, wide = F.col("a").cast("decimal(15,0)"), "decimal(19,0)"
    joined = joined.select("lang", "phrase", "k", "a", "cut", "l", "r", (F.lit(1_000_000).cast("decimal(7,0)") * (a * a)).alias("above"),
                           (F.col("l").cast(wide) * F.col("r").cast(wide)).alias("below"))
    scored = joined.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct(F.expr("above div below").alias("score"), "cut", "l", "r")).alias("own"))
    longer = (candidates.where("k = 3").select("lang", "a", F.explode(F.array(_part(1, 2), _part(2, 2))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered_percent))
    plain = kept.select("lang", "phrase", "a", "own.l", "own.r", "own.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = plain.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("k = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[ \t]+') IF x <> ''] AS ws FROM p),
g AS (SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) FROM w
      UNION ALL SELECT lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
u AS (SELECT lang, k, phrase, a, 1 AS cut, ws[1] AS x, array_to_string(ws[2:], ' ') AS y FROM c
      UNION ALL SELECT lang, k, phrase, a, 2, ws[1] || ' ' || ws[2], ws[3] FROM c WHERE k = 3),
s AS (SELECT u.lang, u.k, u.phrase, a, cut, fx.f AS l, fy.f AS r,
             CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(fx.f AS HUGEINT) * fy.f) AS BIGINT) AS score
      FROM u JOIN f fx ON fx.lang = u.lang AND fx.phrase = x JOIN f fy ON fy.lang = u.lang AND fy.phrase = y),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, ws[1] || ' ' || ws[2] AS phrase FROM c WHERE k = 3
      UNION ALL SELECT lang, a, ws[2] || ' ' || ws[3] FROM c WHERE k = 3) GROUP BY ALL),
q AS (SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank
      FROM m LEFT JOIN o ON o.lang = m.lang AND o.phrase = m.phrase WHERE o.longer IS NULL OR 100 * o.longer < 50 * m.a)
SELECT q.lang, rank, q.phrase, a, l, r, n, score FROM q JOIN n ON n.lang = q.lang WHERE rank <= 2000"""
