"""Best-fit packing: bounded-space online best-fit over a bitset of open bins keyed by free space."""

from __future__ import annotations

import re
import sys
import threading
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from recoflow.llm.common import cut, text_slices

CAPACITY, OPEN_BINS, PIECES_PER_TASK = 2048, 1 << 15, 1 << 16
CACHE_WORDS = 1 << 20
#: Seconds after its last task in which a worker still remembers words.
CACHE_IDLE_S = 2.0
#: Bytes of text that are cut into units at a time.
SLICE_BYTES = 1 << 20
BOUNDARY = "<|endoftext|>"
# White space beyond ASCII, which the tokenizer drops like any other; U+001C to U+001F are no white space to it.
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

# Kinds of bytes. The tokenizer takes runs of letters, single digits and runs of anything else, so it cuts where kinds change and
# around digits. What may do otherwise is GLUE, at which no unit is cut: apostrophes (contractions), ``|`` (its special tokens)
# and all that is neither ASCII nor a letter of Latin-1.
SPACE, LETTER, MARK, DIGIT, GLUE = range(5)
KINDS = np.full(256, GLUE, np.uint8)
KINDS[:128] = MARK
KINDS[[0x20, 9, 10, 11, 12, 13]] = SPACE
KINDS[[*range(65, 91), *range(97, 123)]] = LETTER
KINDS[48:58] = DIGIT
KINDS[[0x27, 0x7C]] = GLUE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# The second byte of letters of Latin-1 in lower case (À to Þ have their small letter 32 places on); 0 where it makes no letter.
LATIN = np.zeros(256, np.uint8)
LATIN[0x80:0xC0] = [*range(0xA0, 0xB7), 0, *range(0xB8, 0xBF), *range(0x9F, 0xB7), 0, *range(0xB8, 0xC0)]


def _meetings(first: bool) -> np.ndarray:
    """For each two kinds that meet (left one times 8, right one): whether the right byte begins, or the left one ends a unit."""
    out = np.zeros(64, bool)
    for a in range(5):
        for b in range(5):
            between = SPACE in (a, b) or (GLUE not in (a, b) and (a != b or a == DIGIT))
            out[8 * a + b] = between and (b if first else a) != SPACE
    return out


BEGINS, ENDS = _meetings(True), _meetings(False)


def holders(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which units hold one of the places."""
    out = np.zeros(len(starts), bool)
    out[np.searchsorted(starts, places, "right") - 1] = True
    return out


def units(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The units of all texts one after another, the index of the first unit of each text (and the number of units), and which
    distinct units hold a GLUE byte.

    Units stand between white space, are cut wherever the tokenizer cuts for sure, and are in lower case if they hold no ``|``.
    The tokenizer never joins what stands in two units, so the ids of a text are those of its units one after another.
    """
    # A space after each text keeps it apart from the next.
    joined = pc.binary_join_element_wise(texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    bounds = np.frombuffer(joined.buffers()[1], np.int64)[:len(texts) + 1]
    raw = joined.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[:bounds[-1]]
    lower, kinds = LOWER[data], np.zeros(len(data) + 1, np.uint8)
    kind = kinds[1:]
    np.take(KINDS, data, out=kind)
    at = np.flatnonzero(data >= 0xC2)
    lead = data[at]
    if ((lead == 0xC2) | (lead >= 0xE1) & (lead <= 0xE3)).any():
        for found in WIDE_SPACE.finditer(raw):
            kind[found.start():found.end()] = SPACE
    at = at[lead == 0xC3]
    small = LATIN[data[at + 1]]
    at, small = at[small > 0], small[small > 0]
    kind[at] = kind[at + 1] = LETTER
    lower[at + 1] = small
    # The last byte is a space, so every unit begins and ends inside.
    meeting = kinds[:-1] * np.uint8(8) + kind
    starts, ends = np.flatnonzero(BEGINS[meeting]), np.flatnonzero(ENDS[meeting])
    full = kind != SPACE
    held = lower[full]
    bars = np.flatnonzero(data == 0x7C)
    if len(bars):
        # In lower case a unit could become a special token, which it is not.
        held = np.where(np.repeat(holders(starts, bars), ends - starts), data[full], held)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)]).dictionary_encode()
    glued = np.zeros(len(found.dictionary), bool)
    glued[found.indices.to_numpy()[holders(starts, np.flatnonzero(kind == GLUE))]] = True
    return found, np.searchsorted(starts, bounds), glued


class WordCache:
    """Token ids (as bytes) of units of texts (``units``), with a bounded number of remembered ones per worker.

    They are held in two generations of ``limit / 2``: a full one becomes the older, whose units come back when they are
    seen again, and the rest of the one before it is forgotten.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.boundary = self.tokenizer.token_to_id(BOUNDARY)
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, from one call: parts are set apart by a special token."""
        special = [p for p in parts if "<|" in p]
        if special:
            alone = {p: self._ids(p).tobytes() for p in special}
            rest = iter(self._encode([p for p in parts if p not in alone]))
            return [alone[p] if p in alone else next(rest) for p in parts]
        out: list[bytes] = []
        for k in range(0, len(parts), 4096):
            ids = self._ids(BOUNDARY.join(parts[k:k + 4096]))
            ends = np.flatnonzero(ids == self.boundary)
            raw = ids.tobytes()
            out += [raw[a:z] for a, z in zip([0, *((ends + 1) * 4).tolist()], [*(ends * 4).tolist(), len(raw)])]
        return out

    def _plain(self, parts: list[bytes]) -> list[bytes]:
        """The same for units without a GLUE byte. Each ends in a token with a word end, exactly one, so a space sets them apart."""
        out: list[bytes] = []
        for k in range(0, len(parts), 512):
            block = parts[k:k + 512]
            ids = self._ids(b" ".join(block).decode())
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(block):
                out += self._encode([p.decode() for p in block])
                continue
            raw = ids.tobytes()
            out += [raw[a:z] for a, z in zip([0, *(last[:-1] * 4).tolist()], (last * 4).tolist())]
        return out

    def _known(self, asked: list[bytes], glued: set[bytes]) -> list[bytes]:
        """Ids of distinct units."""
        got = list(map(self.words.get, asked))
        missing = [i for i, ids in enumerate(got) if ids is None]
        if missing:
            for i in missing:
                got[i] = self.older.get(asked[i])
            new = [i for i in missing if got[i] is None]
            plain, others = [i for i in new if asked[i] not in glued], [i for i in new if asked[i] in glued]
            learnt = self._plain([asked[i] for i in plain]) + self._encode([asked[i].decode("utf-8", "replace") for i in others])
            for i, ids in zip(plain + others, learnt):
                got[i] = ids
            self.words.update(zip([asked[i] for i in missing], [got[i] for i in missing]))
            if 2 * len(self.words) > self.limit:
                self.older, self.words = self.words, {}
        return got

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """The ids of each text."""
        if len(texts) == 0:
            return
        found, bounds, glued = units(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        asked = found.dictionary.to_numpy(zero_copy_only=False)
        ids = self._known(asked.tolist(), set(asked[glued].tolist())).__getitem__
        unit, places = found.indices.to_numpy().tolist(), bounds.tolist()
        for a, z in zip(places, places[1:]):
            yield b"".join(map(ids, unit[a:z]))


def worker_cache(path: str) -> WordCache:
    """The cache of this Python worker. This module reaches workers by value, anew for each task, so what should outlive
    a task is kept in a module of the worker's own."""
    held = vars(sys.modules.setdefault("_word_caches", types.ModuleType("_word_caches")))
    caches, uses = held.setdefault("caches", {}), held.setdefault("uses", {})
    uses[path] = uses.get(path, 0) + 1
    if path not in caches:
        caches[path] = WordCache(path)
    return caches[path]


def forget_when_idle(path: str, seconds: float) -> None:
    """The worker's cache goes unless a task asks for it again within ``seconds``: workers live on and serve other steps.

    A task that begins just then holds the cache itself; at worst the one after it learns its words again.
    """
    held = vars(sys.modules["_word_caches"])
    use = held["uses"][path]

    def forget() -> None:
        if held["uses"][path] == use:
            held["caches"].pop(path, None)

    timer = threading.Timer(seconds, forget)
    timer.daemon = True
    timer.start()


def piece_rows(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    cache = worker_cache(path)
    try:
        yield from pieces_of(batches, cache, end_id, capacity)
    finally:
        forget_when_idle(path, CACHE_IDLE_S)


def pieces_of(batches: Iterator[pa.RecordBatch], cache: WordCache, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    tail = np.array([end_id], "<u4").tobytes()
    for batch in text_slices(batches, 1, limit=SLICE_BYTES):
        rows, piece, start, length, crc = [], [], [], [], []
        for i, ids in enumerate(cache.encode(batch.column(1))):
            ids += tail
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                rows.append(i)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])


class OpenBins:
    """Open bins of one task. Bit ``f`` of ``free`` is set if some open bin has ``f`` places left."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.count, self.made = capacity, most, 0, 0
        self.free = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.free &= ~(1 << free)
        self.count -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset of an item: the fullest open bin that holds it, else a new one, for which the fullest may close."""
        fits = self.free >> size
        if fits:
            free = size + ((fits & -fits).bit_length() - 1)
            number = self._take(free)
        else:
            if self.count >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            free, number = self.capacity, self.made
            self.made += 1
        left = free - size
        if left:
            self.by_free[left].append(number)
            self.free |= 1 << left
            self.count += 1
        return number, self.capacity - free


def packed_rows(batches: Iterator[pa.RecordBatch], capacity: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    bins = OpenBins(capacity, open_bins)
    base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
    for batch in batches:
        placed = [bins.place(size) for size in batch.column("length").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([base + n for n, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
            names=[*batch.schema.names, "sequence_id", "offset"])


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``: each text's ids and ``end_id``, cut only beyond ``capacity``."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: piece_rows(it, tokenizer, end_id, capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Pieces of all rows of ``docs`` (``doc_id``, ``text``) with ``sequence_id`` and ``offset``.

    Pieces are dealt to tasks by a hash of document and piece, ``per_task`` to each; a task holds ``open_bins`` bins and
    streams its pieces, longest first, so its memory does not depend on the data. Tasks leave at most ``open_bins``
    bins part-filled each. The order is fixed by the data, so a task that runs again gives the same places.

    Null and empty texts are one piece with the end id alone. Rows that repeat a ``doc_id`` are packed like any others.
    A null ``doc_id`` stays null. Other columns are ignored.
    """
    parts = cut(pieces(docs, tokenizer, end_id, capacity))
    tasks = max(1, -(-parts.count() // per_task))
    dealt = (parts.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32"))
             .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32"))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.mapInArrow(lambda it: packed_rows(it, capacity, open_bins), schema)
