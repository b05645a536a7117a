"""Packing cuts texts into units by their bytes; the tokenizer sees a unit once, however often and with whatever marks it stands."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from recoflow.llm import packing

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", "S", "t", "re", "é", "É", "×", "÷", "ß", "ẞ", "ÿ", "Þ", "'", "'s", "'LL", "’", "|", "<", ">", "<|endoftext|>", "<|ENDOFTEXT|>",
        "</w>", "́", "̸", "=", "µ", "ª", "²", "½", "İ", "K", "Å", "Σ", "하", "漢字", "。", "ё", "😀", "1", "2",
        "٣", ".", ",,", "###", "-", " ", " ", "\n", "\xa0", "\x85", "　", " ", "​", "\x1c", "\x00", "\x7f"]


class Seen:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, plain: Tokenizer):
        self.plain, self.chars = plain, 0

    def encode(self, text: str, **how):
        self.chars += len(text)
        return self.plain.encode(text, **how)

    def __getattr__(self, name: str):
        return getattr(self.plain, name)


class Asked(dict):
    """A dictionary that counts how often it is asked."""

    times = 0

    def get(self, *args):
        self.times += 1
        return super().get(*args)


def expected(texts: list[str | None]) -> list[bytes]:
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_units_have_the_ids_of_whole_texts():
    rng = random.Random(5)
    texts: list[str | None] = [None, "", " \n"]
    for few in (BITS, BITS[:20], ["a", "É", ".", "'", "s", "1", "|", " "]):
        texts += ["".join(rng.choices(few, k=rng.choice([1, 2, 3, 6, 30]))) for _ in range(500)]
    texts += [chr(c) + chr(d) + "a." for c in range(1, 0x180) for d in (0x41, 0xC9, 0x2C)]
    whole = expected(texts)
    for limit, step in ((16, 97), (1 << 20, len(texts))):
        cache = packing.WordCache(TOKENIZER, limit)
        assert [ids for k in range(0, len(texts), step) for ids in cache.encode(texts[k:k + step])] == whole
    column = pa.array(texts)
    assert list(packing.WordCache(TOKENIZER).encode(column.slice(40, 300))) == whole[40:340]


def test_words_with_other_marks_are_not_learnt_again():
    """Words with more than one mark, or one that was not listed, went to the tokenizer each time."""
    stems = [f"{a}{b}lich" for a in ("ofth", "Nicht", "Éa", "rein") for b in "aeioubcdfghklmnp"]
    marks = ["", ".", ",", "###", "%%%", ".!!", ")", "...", "$$$", "&&&", ".***", "-", "\"", ";;", "?!", "@@"]
    texts = [" ".join(stem + mark for stem in stems) for mark in marks]
    cache = packing.WordCache(TOKENIZER)
    cache.tokenizer = Seen(cache.tokenizer)
    assert list(cache.encode(texts)) == expected(texts)
    assert cache.tokenizer.chars < 2 * sum(map(len, [*stems, *marks]))


def test_a_word_is_looked_up_once_a_slice():
    """Each place of a word was looked up in a dictionary too large for the processor's cache."""
    texts = [" ".join(f"Word{chr(97 + i % 26)}," for i in range(n)) for n in (10, 500, 3000)]
    cache = packing.WordCache(TOKENIZER)
    cache.words = Asked()
    assert list(cache.encode(texts)) == expected(texts)
    assert cache.words.times <= 2 * 27


def test_pieces_of_slices(monkeypatch):
    """The same pieces whatever the slices; a text longer than a slice, null and empty ones among them."""
    texts = ["a b", None, "", "One two, " * 3000, *[f"w{i} É. " * (i % 7) for i in range(200)]]
    rows = pa.RecordBatch.from_arrays([pa.array([*range(len(texts) - 1), None], pa.int64()), pa.array(texts)], names=["doc_id", "text"])

    def pieces(*batches: pa.RecordBatch) -> list[dict]:
        return [row for out in packing.pieces_of(iter(batches), packing.WordCache(TOKENIZER), 0, 2048) for row in out.to_pylist()]

    whole = pieces(rows, rows.slice(0, 0))
    assert [row["piece"] for row in whole if row["doc_id"] == 3] == list(range(-(-(9001) // 2048)))
    monkeypatch.setattr(packing, "SLICE_BYTES", 100)
    assert pieces(rows.slice(0, 7), rows.slice(7)) == whole
