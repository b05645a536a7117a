"""Exact substring de-duplication by recompression.

Words get 64-bit names from their content. Each round first names runs of equal symbols, then pairs of a left and a
right symbol, where the side of a symbol is a bit of its name. Names are content hashes, so all executors agree on them
without an exchange, and equal stretches of text get equal symbols except near their ends. For every symbol the words
that its shape depends on are tracked (its context); a window of text that holds a symbol's whole context shares that
symbol with every equal window, at the same place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recoflow.llm.common import cut, hashed_words, mix, sifted, struct_lists, text_chunks, text_slices, windows_hash, word_spans

WINDOW, ROUNDS = 35, 3
_U = np.uint64
_STOP = _U(0x9D39247E33776D41)


def recompress(words: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after ``rounds``: names, and the context of each as first word and word after the last (both never fall)."""
    names, low, high = words, np.arange(len(words)), np.arange(1, len(words) + 1)
    for turn in range(rounds):
        if len(names) == 0:
            break
        # Runs of equal symbols. A run depends on the symbols beside it, which end it.
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        last = np.append(first[1:], len(names)) - 1
        size = (last - first + 1).astype(_U)
        names_r = np.where(size > 1, mix(names[first] ^ mix(size + _U(turn))), names[first])
        low_r = np.where(first > 0, low[np.maximum(first - 1, 0)], -1)
        high_r = np.where(last + 1 < len(names), high[np.minimum(last + 1, len(names) - 1)], len(words) + 1)
        # Pairs of a left and a right symbol; pairs cannot overlap, as no symbol has both sides.
        side = (mix(names_r + _U(turn + 1)) & _U(1)).astype(bool)
        pair = np.zeros(len(names_r), bool)
        pair[:-1] = ~side[:-1] & side[1:]
        second = np.concatenate([[False], pair[:-1]])
        keep = np.flatnonzero(~second)
        follow = np.minimum(keep + 1, len(names_r) - 1)
        before = np.maximum(keep - 1, 0)
        paired = pair[keep]
        names = np.where(paired, mix(mix(names_r[keep]) + names_r[follow] * _U(3)), names_r[keep])
        low = np.where(paired | ~side[keep], low_r[keep], np.where(keep > 0, low_r[before], -1))
        high = np.where(paired, high_r[follow], np.where(side[keep], high_r[keep],
                        np.where(keep + 1 < len(names_r), high_r[follow], len(words) + 1)))
    return names, low, high


def anchors(words: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start an anchor name that equal windows share, and the number of the symbol it stands for.

    Among the symbols whose context lies in the window the one with the least hash of its context is taken, the leftmost
    of equals. A window without such a symbol is its own anchor (number -1).
    """
    n = len(words) - window + 1
    _, low, high = recompress(words, rounds)
    inside = (low >= 0) & (high <= len(words))
    low, high = low[inside], high[inside]
    starts = np.arange(n)
    own = windows_hash(words, starts, starts + window)
    if len(low) == 0:
        return own, np.full(n, -1)
    rank = windows_hash(words, low, high, 1)
    begin = np.searchsorted(low, starts, "left")
    end = np.searchsorted(high, starts + window, "right")
    width = end - begin
    # Least rank over sliding ranges: blocks of doubling length, two of which cover any range.
    best, block = np.arange(len(rank)), 1
    out = np.full(n, -1)
    while True:
        now = (width >= block) & (width < 2 * block)
        a, b = best[begin[now]], best[end[now] - block]
        out[now] = np.where(rank[b] < rank[a], b, a)
        if 2 * block > int(width.max(initial=0)):
            break
        a, b = best[:len(best) - block], best[block:]
        best = np.where(rank[b] < rank[a], b, a)
        block *= 2
    return np.where(out >= 0, rank[np.maximum(out, 0)], own), out


def joined_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words of the chunk with a stop before, between and after texts; and the place of the first word of each text."""
    hashes, _, _, firsts = hashed_words(data, bounds)
    words = np.full(len(hashes) + len(firsts), _STOP)
    place = np.arange(len(hashes)) + np.searchsorted(firsts[:-1], np.arange(len(hashes)), "right")
    words[place] = hashes
    return words, firsts + np.arange(1, len(firsts) + 1)


def segment_rows(batches: Iterator[pa.RecordBatch], window: int, rounds: int) -> Iterator[pa.RecordBatch]:
    """Stretches of neighbouring windows with one anchor: their name, a digest of all their words, and where they are.

    Equal stretches of one text are one row, so a text that repeats itself gives a row for each of its different stretches.
    """
    for batch in text_slices(batches, 1):
        for first, after, data, bounds in text_chunks(batch.column(1).to_pylist()):
            words, heads = joined_words(data, bounds)
            if len(words) < window:
                continue
            name, symbol = anchors(words, window, rounds)
            starts = np.arange(len(name))
            text = np.searchsorted(heads, starts, "right") - 1
            valid = (text >= 0) & (starts + window < heads[np.minimum(text + 1, len(heads) - 1)])
            valid &= text < len(heads) - 1
            new = np.ones(len(name), bool)
            new[1:] = (symbol[1:] != symbol[:-1]) | (symbol[1:] < 0) | (text[1:] != text[:-1]) | ~valid[:-1]
            opens = np.flatnonzero(new & valid)
            if len(opens) == 0:
                continue
            cuts = np.append(np.flatnonzero(new | ~valid), len(name))
            ends = cuts[np.searchsorted(cuts, opens, "right")]
            digest = (windows_hash(words, opens, ends + window - 1), windows_hash(words, opens, ends + window - 1, 1))
            names, texts, begin = name[opens], text[opens], opens - heads[text[opens]]
            order = np.lexsort((begin, digest[1], digest[0], names, texts))
            keys = np.stack([texts.astype(_U), names, *digest])[:, order]
            heads_of = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            one = order[heads_of]
            offsets = pa.array(np.append(heads_of, len(order)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(first + texts[one])), pa.array(names[one].view(np.int64)),
                pa.array(digest[0][one].view(np.int64)), pa.array(digest[1][one].view(np.int64)),
                pa.ListArray.from_arrays(offsets, pa.array(begin[order].astype(np.int64))), pa.array((ends - opens)[one].astype(np.int32))],
                names=["row", "anchor", "digest_a", "digest_b", "starts", "count"])


def window_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Every window of the wanted stretches: 128 bits of its words, its text and its start."""
    for batch in text_slices(batches, 1):
        wanted = struct_lists(batch.column(2))
        for first, after, data, bounds in text_chunks(batch.column(1).to_pylist()):
            words, _, _, firsts = hashed_words(data, bounds)
            lists = wanted[first:after]
            total = [sum(c for _, c in x) for x in lists]
            if not sum(total):
                continue
            local = np.concatenate([np.arange(s, s + c) for x in lists for s, c in x])
            starts = local + np.repeat(firsts[:-1], total)
            a, b = windows_hash(words, starts, starts + window), windows_hash(words, starts, starts + window, 1)
            yield pa.RecordBatch.from_arrays([
                pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                batch.column(0).take(pa.array(first + np.repeat(np.arange(after - first), total))),
                pa.array(local.astype(np.int64))], names=["a", "b", "row", "start"])


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words in the given stretches (starts and number of words)."""
    for batch in text_slices(batches, 1):
        texts, stretches = batch.column(1).to_pylist(), struct_lists(batch.column(2))
        counts, removed, digests, kept = [], [], [], []
        for text, ranges in zip(texts, stretches):
            raw = (text or "").encode("utf-8", "replace")
            data = np.frombuffer(raw, np.uint8)
            starts, ends = word_spans(data)
            change = np.zeros(len(starts) + 1, np.int64)
            for begins, count in ranges:
                for start in begins:
                    change[start] += 1
                    change[min(start + count, len(starts))] -= 1
            stay = np.cumsum(change[:-1]) == 0
            counts.append(len(starts))
            removed.append(int(len(starts) - stay.sum()))
            words = b" ".join([raw[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist())])
            digests.append(hashlib.sha256(words).hexdigest())
            kept.append(text if not removed[-1] else words.decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept, pa.string())],
            names=["rest", "n_words", "n_removed", "kept_sha256", "kept_text"])


def repeated_stretches(rows: DataFrame, window: int, rounds: int) -> DataFrame:
    """``row``, ``stretches``: all windows (as starts and number of covered words) whose words start anywhere else too."""
    every = cut(rows.mapInArrow(lambda it: segment_rows(it, window, rounds),
                                "row long, anchor long, digest_a long, digest_b long, starts array<long>, count int"))
    # Most anchors stand in one place alone. Their stretches leave before digests and places are dealt out; a few that pass the
    # sieve without need are classes of one copy, which are dropped below like any other.
    busy = every.groupBy("anchor").agg(F.sum(F.size("starts")).alias("places")).where("places > 1").select("anchor")
    segments = cut(sifted(every, busy, "anchor"))
    same = ["anchor", "digest_a", "digest_b"]
    # Equal stretches are one class, counted before the shuffle; copies of a text cost one row per class and task.
    classes = segments.groupBy(*same).agg(F.sum(F.size("starts")).alias("copies"),
                                          F.min(F.struct("row", F.get("starts", 0).alias("start"))).alias("one"))
    shared = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.max("copies").alias("most")).where("classes > 1 or most > 1")
    marked = cut(classes.join(shared.select("anchor", "classes"), "anchor").where("classes > 1 or copies > 1"))
    whole = (segments.join(marked.where("copies > 1").select(*same), same, "left_semi")
             .select("row", "starts", (F.col("count") + window - 1).alias("covered")))
    # Where one anchor has several classes, each class shows its windows once.
    once = (segments.join(marked.where("classes > 1").select(*same, "one", "copies"), same)
            .where((F.col("one.row") == F.col("row")) & (F.col("one.start") == F.get("starts", 0)))
            .groupBy("row").agg(F.collect_list(F.struct("one.start", "count")).alias("wanted")))
    windows = rows.join(once, "row").select("row", "text", "wanted").mapInArrow(
        lambda it: window_rows(it, window), "a long, b long, row long, start long")
    windows = cut(windows)
    twice = windows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    fine = windows.join(twice, ["a", "b"], "left_semi").select("row", F.array("start").alias("starts"), F.lit(window).alias("covered"))
    return (whole.unionByName(fine).groupBy("row")
            .agg(F.collect_list(F.struct("starts", F.col("covered").cast("long").alias("covered"))).alias("stretches")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``rest`` (all columns of ``docs`` but ``text``), ``n_words``, ``n_removed``, ``kept_sha256``, ``kept_text``, per row.

    A word goes if a window of ``window`` words that covers it starts anywhere else too, in this or another row; windows
    are those of the input. Stretches of windows with one anchor are compared as a whole first; only where an anchor has
    several surroundings are single windows named, once per distinct surrounding. Names that decide have 128 bits.

    Null and empty texts have no words; texts shorter than a window lose nothing. Rows are told apart by a hash of id
    and text, so rows that repeat a ``doc_id`` and rows without one are ordinary rows, and equal rows are copies of each
    other. ``kept_text`` is the unchanged text where nothing was removed, else the kept words joined by one space.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")
    source = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text", rest)
    stretches = repeated_stretches(source.select("row", "text"), window, rounds)
    joined = source.join(stretches, "row", "left").select("rest", "text", "stretches")
    schema = joined.select("rest").schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string").add("kept_text", "string")
    return joined.mapInArrow(cut_rows, schema)


def without_repeats(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with the repeated stretches cut out of ``text`` and ``n_chars`` (if any) brought in line; no row goes."""
    done = remove_repeats(docs, **parameters)
    own = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return done.select(*[(own[c] if c in own else F.col("rest").getField(c)).alias(c) for c in docs.columns])
