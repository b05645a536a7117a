"""Python workers hold a slice of a batch's texts at a time, not the texts of 10,000 rows."""

from __future__ import annotations

import sys
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from recoflow.llm import importance, near_dup, packing, substring_dedup
from recoflow.llm.common import SLICE_BYTES, struct_lists, text_slices

STRETCHES = pa.list_(pa.struct([("starts", pa.list_(pa.int64())), ("covered", pa.int64())]))
WANTED = pa.list_(pa.struct([("start", pa.int64()), ("count", pa.int32())]))


def texts(rows: int, words: int) -> list[str | None]:
    return [None if n % 50 == 7 else "" if n % 50 == 8 else " ".join(f"wörd{(n * i) % 977}x{i % 31}" for i in range(words)) for n in range(rows)]


def batch(own: list[str | None], last: pa.Array | None = None) -> pa.RecordBatch:
    columns = [pa.array(range(len(own)), pa.int64()), pa.array(own, pa.string())] + ([last] if last is not None else [])
    return pa.RecordBatch.from_arrays(columns, names=["row", "text", "more"][:len(columns)])


def with_lists(own: list[str | None], kind: pa.DataType) -> pa.RecordBatch:
    some = [([3, 60], 40), ([200], 35)] if kind == STRETCHES else [(2, 30), (90, 25)]
    return batch(own, pa.array([some if n % 3 and len(t or "") > 5000 else None for n, t in enumerate(own)], kind))


STEPS = {
    "segment_rows": (lambda b: substring_dedup.segment_rows(b, 35, 3), lambda own: batch(own)),
    "window_rows": (lambda b: substring_dedup.window_rows(b, 35), lambda own: with_lists(own, WANTED)),
    "cut_rows": (substring_dedup.cut_rows, lambda own: with_lists(own, STRETCHES)),
    "sketch_rows": (lambda b: near_dup.sketch_rows(b, 5, 40, 4), lambda own: batch(own)),
    "shingle_rows": (lambda b: near_dup.shingle_rows(b, 5), lambda own: batch(own)),
    "overlap_rows": (lambda b: near_dup.overlap_rows(b, 5), lambda own: pa.RecordBatch.from_arrays(
        [pa.array(range(len(own))), pa.array(range(len(own))), pa.array(own, pa.string()), pa.array(own[::-1], pa.string())], names=["a", "b", "x", "y"])),
    "weight_rows": (lambda b: importance.weight_rows(b, np.linspace(-1, 1, 1 << 12)), lambda own: batch(own)),
    "count_rows": (lambda b: importance.count_rows(b, 1 << 12), lambda own: pa.RecordBatch.from_arrays(
        [pa.array(own, pa.string()), pa.array([n % 2 if n % 5 else None for n in range(len(own))], pa.int32())], names=["text", "label"])),
}


@pytest.mark.parametrize("name", STEPS)
def test_memory_of_a_step_does_not_grow_with_the_batch(name):
    """Whole batches became Python objects: the peak grew with the batch."""
    step, made = STEPS[name]

    def peak(copies: int) -> int:
        rows = made(own * copies)
        tracemalloc.start()
        for _ in step(iter([rows])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    own = texts(300, 700)
    list(step(iter([made(own)])))  # tables that stay are made
    assert peak(4) < 1.3 * peak(1) + SLICE_BYTES


@pytest.mark.parametrize("name", STEPS)
def test_slices_change_no_result(name):
    step, made = STEPS[name]
    rows = made(texts(260, 600))
    whole = [row for out in step(iter([rows])) for row in out.to_pylist()]
    ones = [row for out in step(rows.slice(i, 1) for i in range(rows.num_rows)) for row in out.to_pylist()]
    if name == "count_rows":  # a count of all batches
        assert whole == ones and len(whole) > 100
    else:
        assert sorted(map(repr, whole)) == sorted(map(repr, ones)) and len(whole) > 100


def test_slices_hold_all_rows_in_order():
    own = ["é" * 90_000, None, "", "a", "b" * 700_000, "c", None, "d" * 10] + texts(500, 300)
    rows = with_lists(own, STRETCHES)
    slices = list(text_slices(iter([rows, rows.slice(0, 0), rows.slice(3, 9)]), 1))
    assert [row for part in slices for row in part.to_pylist()] == rows.to_pylist() + rows.slice(3, 9).to_pylist()
    for part in slices:
        sizes = [len((t or "").encode()) for t in part.column(1).to_pylist()]
        assert sum(sizes[:-1]) <= SLICE_BYTES
    plain = [[tuple(x.values()) for x in cell or []] for cell in rows.column(2).to_pylist()]
    assert struct_lists(rows.column(2)) == plain
    assert [cell for part in text_slices(iter([rows]), 1) for cell in struct_lists(part.column(2))] == plain
    assert struct_lists(rows.column(2).slice(0, 0)) == []


def test_an_idle_worker_forgets_its_words(monkeypatch):
    """The words of the packing step stayed in the workers while they served other steps."""
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setitem(sys.modules, "_word_caches", type(sys)("_word_caches"))
    monkeypatch.setattr(packing, "CACHE_IDLE_S", 0.5, raising=False)

    def task(pause: float = 0) -> list[dict]:
        def batches():
            yield batch(texts(20, 50))
            time.sleep(pause)
        return [row for out in packing.piece_rows(batches(), path, 0, 2048) for row in out.to_pylist()]

    def held() -> list:
        return [x for x in vars(sys.modules["_word_caches"])["caches"].values()]

    first = task()
    cache, = held()
    assert task(pause=1.5) == first  # longer than the cache is kept after the first task
    assert held() == [cache] and cache.words
    time.sleep(2)
    assert held() == []
    assert task() == first
