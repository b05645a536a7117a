"""Benchmark decontamination: q-gram lemma filtering in overlapping diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recoflow.llm.common import text_chunks

Q, ERROR_PERCENT, BLOCK_CHARS = 8, 10, 1 << 22
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = [c if chr(c).isalnum() else 0x20 for c in range(128)]
_ORIGIN = 1 << 30
_SCATTER = np.uint64(0x9E3779B97F4A7C15)


def normalised(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with every run of ASCII marks and white space as one space, and where each byte stood."""
    plain = _PLAIN[data]
    blank = plain == 0x20
    keep = np.ones(len(plain), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    place = np.flatnonzero(keep)
    return plain[place], place


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """Each run of ``q`` bytes (at most 8) as one number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view("<u8").ravel()
    return eight[:max(len(data) - q + 1, 0)] & np.uint64((1 << 8 * q) - 1)


@dataclass
class Index:
    """Q-grams of one block of benchmark items; its size is bounded by the characters of a block."""

    ids: list
    items: list[np.ndarray]
    edits: np.ndarray
    least: np.ndarray
    known: np.ndarray
    shift: np.uint64
    values: np.ndarray
    first: np.ndarray
    item_of: np.ndarray
    place_of: np.ndarray
    start_of: np.ndarray
    q: int


def build_index(rows: list[tuple], q: int, percent: int) -> Index | None:
    ids, items = [], []
    for item_id, text in rows:
        plain, _ = normalised(np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8))
        plain = np.frombuffer(plain.tobytes().strip(), np.uint8)
        if len(plain) >= q:
            ids.append(item_id)
            items.append(plain)
    if not items:
        return None
    sizes = np.array([len(x) for x in items])
    # The lemma: an occurrence with k edits keeps size - q + 1 - k q of the grams. k is such that at least one is left.
    edits = np.minimum(sizes * percent // 100, (sizes - q) // q)
    least = sizes - q + 1 - edits * q
    every = [grams(x, q) for x in items]
    value = np.concatenate(every)
    item = np.repeat(np.arange(len(items)), [len(x) for x in every])
    place = np.concatenate([np.arange(len(x)) for x in every])
    order = np.lexsort((place, item, value))
    value, item, place = value[order], item[order], place[order]
    values, first = np.unique(value, return_index=True)
    bits = max(20, int(len(values) * 16).bit_length())
    shift = np.uint64(64 - bits)
    known = np.zeros(1 << bits, bool)
    known[(values * _SCATTER) >> shift] = True
    return Index(ids, items, edits, least, known, shift, values, np.append(first, len(value)), item, place,
                 np.concatenate([[0], np.cumsum([len(x) for x in every])]), q)


def banded_distance(item: np.ndarray, region: np.ndarray, width: int) -> tuple[int, int]:
    """Least edits that turn ``item`` into a stretch of ``region``, and where that ends; cell (i, i + d) for 0 <= d < width."""
    far = len(item) + len(region) + 1
    row = np.where(np.arange(width) <= len(region), 0, far)
    steps = np.arange(width)
    padded = np.concatenate([region, np.zeros(width + len(item) + 1, np.uint8)])
    for i in range(1, len(item) + 1):
        columns = i + steps
        best = row + np.where(columns > 0, padded[columns - 1] != item[i - 1], 1)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best[columns > len(region)] = far
        row = np.minimum.accumulate(best - steps) + steps
        row[columns > len(region)] = far
    at = int(row.argmin())
    return int(row[at]), len(item) + at


def candidates(text: np.ndarray, doc_of_start: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, int]]:
    """(text number, item, first diagonal, diagonals) of the bands that hold enough shared q-grams."""
    value = grams(text, index.q)
    hit = np.flatnonzero(index.known[(value * _SCATTER) >> index.shift])
    at = np.searchsorted(index.values, value[hit])
    at[at == len(index.values)] = 0
    same = index.values[at] == value[hit]
    hit, at = hit[same], at[same]
    if len(hit) == 0:
        return
    count = index.first[at + 1] - index.first[at]
    begin = np.repeat(index.first[at], count)
    post = begin + np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count)
    item = index.item_of[post]
    step = index.edits[item] + 1
    # Diagonals of a chunk belong to one text each, so band and item name a place in a text.
    place = index.place_of[post]
    band = (np.repeat(hit, count) - place + _ORIGIN) // step
    # A band covers its own step and the next one, so diagonals up to k apart are together in one. A gram of the item
    # counts once, however often the band has it.
    number, many = index.start_of[item] + place, int(index.start_of[-1])
    key = band * many + number
    key = np.sort(np.concatenate([key, key - many]))
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    band, item = key // many, np.searchsorted(index.start_of, key % many, "right") - 1
    first = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (item[1:] != item[:-1])]))
    size = np.diff(np.append(first, len(key)))
    band, item = band[first], item[first]
    for i in np.flatnonzero(size >= index.least[item]).tolist():
        step = int(index.edits[item[i]]) + 1
        diagonal = int(band[i]) * step - _ORIGIN
        # The band's rows may begin before and end after their text; the text with most of it counts.
        middle = diagonal + step + len(index.items[item[i]]) // 2
        doc = int(np.searchsorted(doc_of_start, max(middle, 0), "right")) - 1
        for near in {max(doc - 1, 0), min(doc, len(doc_of_start) - 2), min(doc + 1, len(doc_of_start) - 2)}:
            if doc_of_start[near] < diagonal + 2 * step + len(index.items[item[i]]) and doc_of_start[near + 1] > diagonal:
                yield near, int(item[i]), diagonal, 2 * step


def match_rows(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").lower() for t in batch.column(1).to_pylist()]
        rows, items, edits, begins, ends = [], [], [], [], []
        for first, _, data, bounds in text_chunks(texts):
            text, place = normalised(data)
            starts = np.searchsorted(place, bounds)
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            regions = []
            for doc, item, diagonal, width in candidates(text, starts, index):
                pattern, k = index.items[item], int(index.edits[item])
                low, high = max(int(starts[doc]), diagonal - k), min(int(starts[doc + 1]), diagonal + width + len(pattern) + k)
                if high - low < len(pattern) - k:
                    continue
                exact = text[low:high].tobytes().find(pattern.tobytes())
                if exact < 0:
                    regions.append((doc, item, low, high, width))
                elif (doc, item) not in best or low + exact < best[doc, item][1]:
                    best[doc, item] = (0, low + exact, low + exact + len(pattern))
            for doc, item, low, high, width in regions:
                # No place is better than an exact one, so its neighbouring bands need no alignment.
                if best.get((doc, item), (1,))[0] == 0:
                    continue
                pattern, k, region = index.items[item], int(index.edits[item]), text[low:high]
                found, end = banded_distance(pattern, region, width + 2 * k + 1)
                if found > k:
                    continue
                back, size = banded_distance(pattern[::-1], region[max(0, end - len(pattern) - k):end][::-1], 2 * k + 1)
                begin, end = low + end - size, low + end
                if (doc, item) not in best or (found, begin) < best[doc, item][:2]:
                    best[doc, item] = (found, begin, end)
            for (doc, item), (found, begin, end) in best.items():
                head = data[bounds[doc]:place[begin]]
                body = data[place[begin]:place[min(end, len(place)) - 1] + 1]
                rows.append(first + doc)
                items.append(index.ids[item])
                edits.append(found)
                begins.append(int((head & 0xC0 != 0x80).sum()))
                ends.append(begins[-1] + int((body & 0xC0 != 0x80).sum()))
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()), pa.array(edits, pa.int32()),
            pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], names=["doc_id", "item_id", "edits", "start", "end"])


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, error_percent: int = ERROR_PERCENT,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``start``, ``end``: items found in documents, one row per pair, at its best place.

    Texts are compared in lower case with each run of ASCII marks and white space as one space. An item is found where a
    stretch of the text is at most ``error_percent`` of the item's length away (edits, fewer for items under about ``q``
    squared characters). ``start`` and ``end`` count code points of the lower-cased text.

    Documents are read once per block of ``block_chars`` benchmark characters and never shuffled; a block's q-grams are
    broadcast, so their size is bounded by that parameter, whatever the benchmark's size (an item longer than a block is
    a block). Null and empty texts and items, and items shorter than ``q``, match nothing. Rows that repeat a ``doc_id``
    or ``item_id`` give a row for each place they differ in; equal rows are given once. A null id stays null.
    """
    spark = docs.sparkSession
    sized = benchmark.select("item_id", "text").withColumn("size", F.length("text")).where("size > 0")
    total = sized.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    found = None
    for block in range(blocks):
        # Blocks are cut by hash; rows stream to the driver one block at a time.
        part = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", "text")
        index = build_index([tuple(r) for r in part.toLocalIterator()], q, error_percent)
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(index)
        rows = docs.select("doc_id", "text").mapInArrow(
            lambda it, shared=shared: match_rows(it, shared.value), "doc_id long, item_id long, edits int, start long, end long")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, edits int, start long, end long")
    return found.distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item is found; rows that share a ``doc_id`` go together."""
    hit = matches(docs, benchmark, **parameters).select(F.col("doc_id").alias("hit_id")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id"]), "left_anti")
