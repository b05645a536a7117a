"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recoflow.llm.common import components, cut, hashed_words, mix, pairs_once, python_rows, sifted, text_chunks, text_slices, windows_hash

WORDS, THRESHOLD_PERCENT = 5, 75
BANDS, ROWS = 40, 4
_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one of none has none."""
    out: list[np.ndarray] = []
    for _, _, data, bounds in text_chunks(texts):
        hashes, _, _, firsts = hashed_words(data, bounds, lower=True)
        n = np.diff(firsts)
        every = np.arange(max(len(hashes) - words + 1, 0))
        full = windows_hash(hashes, every, every + words)
        short = windows_hash(hashes, firsts[:-1], firsts[1:])
        for i, count in enumerate(n.tolist()):
            at = firsts[i]
            out.append(np.unique(full[at:at + count - words + 1]) if count >= words else short[i:i + 1] if count else full[:0])
    return out


def probes(bins: int, tries: int = 64) -> np.ndarray:
    """For each bin the bins it asks for a value when it is empty: the same hashed sequence for every document."""
    ids = np.arange(bins, dtype=_U)[:, None] * _U(0x100000001) + np.arange(1, tries + 1, dtype=_U)[None, :] * _U(0x9E3779B97F4A7C15)
    return (mix(ids) % _U(bins)).astype(np.int64)


def densified(values: np.ndarray, ask: np.ndarray) -> np.ndarray:
    """Fill each empty bin from the first full bin of its own probe sequence, so that empty bins borrow independently."""
    empty = np.flatnonzero(values == _EMPTY)
    if len(empty) == 0:
        return values
    full = values != _EMPTY
    hit = full[ask[empty]]
    found = hit.any(axis=1)
    source = ask[empty, hit.argmax(axis=1)]
    # With no full bin among the probes, walk on from the last probe to the next full bin.
    places = np.flatnonzero(full)
    late = ~found
    source[late] = places[np.searchsorted(places, ask[empty[late], -1]) % len(places)]
    out = values.copy()
    out[empty] = values[source]
    return out


def sketch_rows(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    bins = bands * rows
    ask = probes(bins)
    salt = mix(np.arange(1, bands + 1, dtype=_U) * _U(0xD6E8FEB86659FD93))
    for batch in text_slices(batches, 1):
        sets = shingle_sets(batch.column(1).to_pylist(), words)
        digest = np.zeros((len(sets), 2), _U)
        keys = np.zeros((len(sets), bands), _U)
        for i, members in enumerate(sets):
            if len(members) == 0:
                continue
            once = mix(members)
            digest[i] = once.sum(), mix(once ^ _U(0xA5A5A5A5A5A5A5A5)).sum()
            values = np.full(bins, _EMPTY)
            np.minimum.at(values, (once % _U(bins)).astype(np.int64), once)
            values = densified(values, ask).reshape(bands, rows)
            key = salt
            for r in range(rows):
                key = mix(key + values[:, r])
            keys[i] = key
        sizes = np.array([len(x) for x in sets], np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(sizes), pa.array(digest[:, 0].copy().view(np.int64)),
            pa.array(digest[:, 1].copy().view(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[sizes > 0].reshape(-1).view(np.int64)))],
            names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands"])


def overlap_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 2, 3):
        left = shingle_sets(batch.column(2).to_pylist(), words)
        right = shingle_sets(batch.column(3).to_pylist(), words)
        shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(shared, pa.int64()),
            pa.array([len(x) + len(y) - s for x, y, s in zip(left, right, shared)], pa.int64())],
            names=["a", "b", "shared", "together"])


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full shingle sets reach the similarity."""
    # Texts grow with the corpus, so they are merged at every size and never broadcast.
    rows = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
            .select("a", "b", "text_a", "text_b"))
    counted = rows.mapInArrow(lambda it: overlap_rows(it, words), "a long, b long, shared long, together long")
    return counted.where(F.lit(100) * F.col("shared") >= F.lit(percent) * F.col("together")).select("a", "b")


def shingle_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of the texts (the last column), with the columns before it."""
    for batch in (part for whole in batches for part in text_slices([whole], whole.num_columns - 1)):
        sets = shingle_sets(batch.column(batch.num_columns - 1).to_pylist(), words)
        sizes = [len(x) for x in sets]
        if sum(sizes):
            at = pa.array(np.repeat(np.arange(len(sets)), sizes))
            yield pa.RecordBatch.from_arrays([*(column.take(at) for column in batch.columns[:-1]), pa.array(np.concatenate(sets).view(np.int64))],
                                             names=[*batch.schema.names[:-1], "shingle"])


def shared_counts(texts: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id``, ``usable``: how many shingles of each text occur in another of these texts.

    Only those can be in an intersection, so a pair may link only if the smaller count reaches the overlap it needs.
    """
    sets = texts.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    rows = sets.mapInArrow(lambda it: shingle_rows(it, words), "id long, shingle long")
    once = rows.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("last")).where("id = last")
    return once.groupBy("id").agg(F.count("*").alias("lonely"))


def with_component(buckets: DataFrame, found: DataFrame) -> DataFrame:
    return (buckets.drop("component").join(found.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def split_buckets(buckets: DataFrame) -> DataFrame:
    """Only buckets that still hold several components."""
    open_keys = buckets.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return buckets.join(open_keys.select("key"), "key", "left_semi")


def grouped(buckets: DataFrame) -> DataFrame:
    """``id``, ``grp``: members that buckets connect, directly or over others, have the same group."""
    first = buckets.groupBy("key").agg(F.min("id").alias("a"))
    return components(buckets.join(first, "key").select("a", F.col("id").alias("b"))).select(F.col("node").alias("id"), F.col("component").alias("grp"))


class Differences:
    """The members of each group as differences to a base, the shingles that more than half of the group have.

    |x - y| + |y - x| is the same for the sets and for their differences D to one base, so x and y link exactly if
    2 (100 + p) |Dx & Dy| >= Qx + Qy with Q = (100 + p) |D| - (100 - p) n. Copies of one text share nearly all their shingles
    but few of their differences. Only a difference that another member has (``usable`` of them) can be shared.
    """

    def __init__(self, members: DataFrame, texts: DataFrame, words: int, percent: int):
        """``members``: ``id``, ``n`` (size of its set), ``grp``."""
        self.weight, self.spare = 100 + percent, 100 - percent
        own_texts = sifted(texts, members.select("id"))
        self.texts, self.words = own_texts.select(F.col("doc_id").alias("id"), "text").hint("merge"), words
        rows = self.rows_of(members)
        sizes = members.groupBy("grp").agg(F.count("*").alias("members"))
        seen = rows.groupBy("grp", "shingle").agg(F.count("*").alias("often")).where("often > 1").join(sizes, "grp")
        #: Shingles of two members or more; ``differ`` is the number of members that differ from the base in it.
        self.shingles = cut(seen.select("grp", "shingle", F.expr("2 * often > members").alias("base"),
                                        F.expr("if(2 * often > members, members - often, often)").alias("differ")))
        of_base = self.shingles.where("base").groupBy("grp").agg(F.count("*").alias("whole"), F.count_if(F.expr("differ > 1")).alias("whole_usable"))
        own = (rows.join(self.shingles.hint("merge"), ["grp", "shingle"]).groupBy("id")
               .agg(F.count_if("base").alias("held"), F.count_if(F.expr("base and differ > 1")).alias("held_usable"), F.count_if(F.expr("not base")).alias("extra")))
        facts = (members.join(of_base, "grp", "left").join(own, "id", "left").na.fill(0)
                 .select("id", "grp", "n", F.expr("whole + n - 2 * held").alias("size"), F.expr("extra + whole_usable - held_usable").alias("usable"))
                 .withColumn("q", F.expr(f"{self.weight} * size - {self.spare} * n")))
        #: ``room``: the largest ``q`` that a partner may have.
        self.facts = cut(facts.withColumn("room", F.expr(f"{2 * self.weight} * usable - q")))

    def rows_of(self, members: DataFrame) -> DataFrame:
        words = self.words
        return (members.select("id", "grp").join(self.texts, "id").select("id", "grp", "text")
                .mapInArrow(lambda it: shingle_rows(it, words), "id long, grp long, shingle long"))

    def stars(self) -> DataFrame:
        """Pairs that link without a shared difference are all connected over the member nearest to the base."""
        nearest = self.facts.groupBy("grp").agg(F.min_by(F.struct("id", "q"), F.struct("q", "id")).alias("c")).select("grp", F.col("c.id").alias("a"), F.col("c.q").alias("least"))
        return self.facts.join(nearest, "grp").where("q + least <= 0 and id <> a").select("a", F.col("id").alias("b"))

    def pairs(self, found: DataFrame) -> DataFrame:
        """All pairs of different components that need a shared difference and may have enough of them.

        Differences are ordered by how many members have them. If two members share k of theirs, the first
        ``usable - k + 1`` of both hold a common one (prefix filter); k is the least that any partner can ask for.
        """
        mine = with_component(self.facts, found)
        bounds = mine.groupBy("grp").agg(F.min("q").alias("least"), F.max("room").alias("most"), F.min("component").alias("low"), F.max("component").alias("high"))
        mine = cut(mine.join(bounds.where("low <> high"), "grp").where("room >= least and q <= most and usable > 0").drop("low", "high"))
        ids = mine.select("id", "grp")
        held = self.rows_of(ids)
        wide = self.shingles.where("differ > 1").hint("merge")
        extra = held.join(wide.where("not base"), ["grp", "shingle"]).select("id", "grp", "shingle", "differ")
        # Members times the base is at most twice the members' own shingles.
        missing = (ids.join(wide.where("base"), "grp").select("id", "grp", "shingle", "differ")
                   .join(held.select("id", "shingle").hint("merge"), ["id", "shingle"], "left_anti").select("id", "grp", "shingle", "differ"))
        # A partner of the size its threshold allows, whose usable differences reach what this one asks for.
        asked = F.expr(f"greatest(1, ceil((q + greatest(least, q - {2 * self.spare} * (100 * n div {100 - self.spare} + 1), 1 - q)) / {2 * self.weight}))")
        short = mine.withColumn("prefix", F.expr("usable + 1") - asked).where("prefix > 0")
        order = F.array_sort(F.collect_list(F.struct("differ", "shingle")))
        first = (extra.unionByName(missing).groupBy("id").agg(order.alias("own")).join(short, "id")
                 .select("id", "grp", "n", "q", "room", "component", F.explode(F.expr("slice(own, 1, int(prefix)).shingle")).alias("shingle")))
        first = cut(first)
        other = first.select("grp", "shingle", *[F.col(c).alias(f"other_{c}") for c in ("id", "n", "q", "room", "component")])
        near = F.expr("id < other_id and component <> other_component and q + other_q > 0 and q <= other_room and other_q <= room "
                      f"and 100 * least(n, other_n) >= {100 - self.spare} * greatest(n, other_n)")
        return first.join(other, ["grp", "shingle"]).where(near).select(F.col("id").alias("a"), F.col("other_id").alias("b"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = THRESHOLD_PERCENT, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for each row of ``docs`` (``doc_id``, ``text``).

    Texts with the same shingle set form one class first (an aggregate, so thousands of copies cost one row per task).
    Class representatives are hashed once into ``bands * rows`` bins; each band is a bucket key. A bucket emits a star,
    its centre against the other members, never all its pairs. Links are confirmed on the full sets of both texts. As
    a star can miss a link between two members, the members of buckets that are not yet one component are then joined by
    their differences to what most of their group share (``Differences``): one more star, and a prefix filter on the rarest
    differences. So no link inside a bucket is lost. A pair at the threshold shares no bucket with probability
    (1 - 0.75^4)^40 = 2.5e-7.

    Null or empty texts and texts without words: empty set, own component. A null ``doc_id`` takes no part: null
    component, kept. Rows that repeat a ``doc_id`` are one node and get the same component. Other columns are ignored.
    """
    sketches = cut(python_rows(docs, "doc_id", "text").mapInArrow(
        lambda it: sketch_rows(it, words, bands, rows),
        "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<long>"))
    known = sketches.where("doc_id is not null and n_shingles > 0")
    same = ["n_shingles", "digest_a", "digest_b"]
    classes = cut(known.groupBy(*same).agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")))
    copies = known.join(classes.where("copies > 1"), same).select(F.col("id").alias("a"), F.col("doc_id").alias("b"))

    keyed = (known.join(classes.select("id", *[F.col(c).alias(f"own_{c}") for c in same]),
                        (F.col("doc_id") == F.col("id")) & (F.col("n_shingles") == F.col("own_n_shingles"))
                        & (F.col("digest_a") == F.col("own_digest_a")) & (F.col("digest_b") == F.col("own_digest_b")), "left_semi")
             .select(F.col("doc_id").alias("id"), F.explode("bands").alias("key")))
    centres = keyed.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre <> last")
    buckets = cut(keyed.join(centres.select("key", "centre"), "key"))
    pairs = cut(pairs_once(buckets.select(F.col("centre").alias("a"), F.col("id").alias("b")), "a", "b"))
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    # Most texts share no bucket and leave before any exchange. A few that stay without need are dropped by the joins that follow;
    # an exact semi join here would be moved below the filter and deal out every text.
    texts = cut(sifted(python_rows(docs, "doc_id", "text"), wanted).distinct())
    links = cut(confirmed(pairs, texts, words, percent))
    # One round may leave a component in parts, which costs comparisons but loses none.
    found = cut(components(links, rounds=1))
    open_buckets = cut(split_buckets(with_component(buckets.select("key", "id"), found)))
    if not open_buckets.isEmpty():
        ids = open_buckets.select("id").distinct()
        sizes = known.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")).distinct()
        facts = (ids.join(sizes, "id").join(shared_counts(texts, ids, words), "id", "left")
                 .where(F.expr(f"(n - coalesce(lonely, 0)) * 100 >= {percent} * n")).select("id", "n"))
        # An id with several texts has no set of its own, so it meets the other members of its buckets one by one.
        several = texts.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("texts")).where("texts > 1").select("id")
        odd = cut(open_buckets.join(several, "id", "left_semi"))
        members = cut(split_buckets(open_buckets.join(facts, "id").join(several, "id", "left_anti")))
        differences = Differences(cut(members.select("id", "n").distinct().join(grouped(members), "id")), texts, words, percent)
        met = (odd.select("key", F.col("id").alias("a"), F.col("component").alias("own"))
               .join(open_buckets.withColumnRenamed("id", "b"), "key").where("own <> component").select("a", "b"))
        for fresh in (lambda: differences.stars().unionByName(met), lambda: differences.pairs(cut(components(links, rounds=1)))):
            candidates = cut(pairs_once(fresh(), "a", "b").join(pairs, ["a", "b"], "left_anti"))
            few = sifted(texts, candidates.select("a").union(candidates.select("b")))
            links = cut(links.unionByName(confirmed(candidates, few, words, percent)))
    whole = components(links.unionByName(copies))
    return (sketches.select("doc_id", "n_shingles")
            .join(whole.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` whose document stands for its group; of rows that repeat a ``doc_id`` the first by text stays."""
    from pyspark.sql import Window

    verdict = near_duplicates(docs, **parameters).where("kept").select("doc_id").distinct()
    stay = docs.join(verdict, docs["doc_id"].eqNullSafe(verdict["doc_id"]), "left_semi")
    place = "__place"
    while place in docs.columns:
        place += "_"
    ranked = stay.withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text"))))
    return ranked.where((F.col(place) == 1) | F.col("doc_id").isNull()).drop(place)
