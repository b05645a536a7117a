"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows that tell quotation from abuse."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recoflow.llm.common import cut, fit_logistic

SAMPLE_ROWS, LEXICON_TERMS, LEAST_SHARE, LEAST_EVIDENCE = 20_000, 4096, 0.8, 12.0
PREFIXES = (5, 6, 7)
WINDOW = 6
WORD = re.compile(r"[^\W\d_]+(?:[0-9@$!*]+[^\W\d_]+)*")
QUOTES = re.compile("[\"“”„«»]")
# Marks often written for a letter.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})
CACHE_WORDS = 1 << 19


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def edits_allowed(term: str) -> int:
    """One edit for terms of five letters or more; shorter terms must match as they are."""
    return int(len(term) >= 5)


@dataclass
class Lexicon:
    """Tries of terms. ``prefixes`` are terms that words may go on from; ``known`` are ordinary words near a term."""

    terms: dict[str, float]
    prefixes: dict[str, float]
    known: set[str] = field(default_factory=set)

    def __post_init__(self):
        # One edit leaves the first or the last half of a term untouched, so there is a trie for the terms of each half
        # (and size of word), and a word is run through those of its own halves only.
        self.tries: dict[tuple[bool, str, int], dict] = {}
        for term in self.terms:
            if edits_allowed(term):
                half = len(term) // 2
                for size in range(len(term) - 1, len(term) + 2):
                    for key in ((True, term[:half], size), (False, term[-half:], size)):
                        node = self.tries.setdefault(key, {})
                        for letter in term:
                            node = node.setdefault(letter, {})
                        node[""] = term
        self.sizes = sorted({len(half) for _, half, _ in self.tries})
        self.longest = max(map(len, self.terms), default=0)
        self.cache: dict[str, tuple[float, bool]] = {}

    def nearest(self, word: str) -> tuple[str, int] | None:
        """The term with the fewest edits: the automaton's states (one row of edits per trie node) follow the trie."""
        best: tuple[int, str] | None = None
        size = len(word)
        tries = [t for n in self.sizes for t in (self.tries.get((True, word[:n], size)), self.tries.get((False, word[-n:], size))) if t]
        stack = [(trie, list(range(size + 1))) for trie in tries]
        while stack:
            node, row = stack.pop()
            for letter, child in node.items():
                if letter == "":
                    if row[-1] <= 1 and (best is None or (row[-1], child) < best):
                        best = (row[-1], child)
                    continue
                new = [row[0] + 1]
                for j, own in enumerate(word):
                    new.append(min(row[j] + (own != letter), row[j + 1] + 1, new[j] + 1))
                if min(new) <= 1:
                    stack.append((child, new))
        return (best[1], best[0]) if best else None

    def weight(self, word: str) -> tuple[float, bool]:
        """How much a word speaks for toxicity, and whether it had to be read as misspelled."""
        if word in self.cache:
            return self.cache[word]
        found = (self.terms[word], False) if word in self.terms else self._misspelled(word)
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[word] = found
        return found

    def _misspelled(self, word: str) -> tuple[float, bool]:
        for n in PREFIXES:
            if word[:n] in self.prefixes:
                return self.prefixes[word[:n]], False
        plain = word.translate(LEET)
        if plain != word and plain in self.terms:
            return self.terms[plain], True
        if word not in self.known and 4 <= len(plain) <= self.longest + 1:
            near = self.nearest(plain)
            if near:
                return self.terms[near[0]] * 0.8 ** near[1], True
        return 0.0, False

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        """Abuse, quoted and misspelled weight, and hits per hundred words.

        A hit is quoted if a quotation mark stands before it and one after it within the window's characters.
        """
        text = (text or "").lower()
        abuse = quoted = misspelled = hits = 0.0
        words = WORD.findall(text)
        if not any(self.weight(w)[0] for w in set(words)):
            return 0.0, 0.0, 0.0, 0.0
        for m in WORD.finditer(text):
            value, fuzzy = self.weight(m[0])
            if value:
                hits += 1
                before, after = text[max(0, m.start() - 8 * WINDOW):m.start()], text[m.end():m.end() + 8 * WINDOW]
                if len(QUOTES.findall(before)) % 2 and QUOTES.search(after):
                    quoted += value
                else:
                    abuse += value
                    misspelled += value * fuzzy
        return np.log1p(abuse), np.log1p(quoted), np.log1p(misspelled), hits * 100 / max(len(words), 20)


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each word or (marked by a star) prefix, by label, of a few texts at a time."""
    for part in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
        counts: dict[str, list[int]] = {}
        for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            words = set(words_of(text))
            for term in words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}:
                counts.setdefault(term, [0, 0])[label] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array([c[1] for c in counts.values()], pa.int64()),
                                          pa.array([c[0] for c in counts.values()], pa.int64())], names=["term", "toxic", "clean"])


def near_rows(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = [w for w in batch.column(0).to_pylist() if lexicon.weight(w)[1]]
        yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["term"])


def feature_rows(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [lexicon.features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["key", "features"])


def learn(texts: DataFrame, lexicon_terms: int = LEXICON_TERMS) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and weights from labelled texts (``text``, ``label``), a bounded sample.

    Terms and prefixes are those whose texts are toxic for the most part; at most ``lexicon_terms`` of each come to the
    driver, the strongest first. Ordinary words near a term are learned as known words.
    """
    spark = texts.sparkSession
    counts = cut(texts.mapInArrow(count_rows, "term string, toxic long, clean long")
                 .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    share = (F.col("toxic") + 0.5) / (F.col("toxic") + F.col("clean") + 1.0)
    # Evidence: the log likelihood ratio of the term's own share of toxic texts against that of all texts.
    base = F.lit((texts.agg(F.avg("label")).first()[0] or 0.0) * 0.998 + 0.001)
    evidence = F.col("toxic") * F.log(share / base) + F.col("clean") * F.log((1 - share) / (1 - base))
    strong = (counts.where((share >= LEAST_SHARE) & (evidence >= LEAST_EVIDENCE))
              .withColumn("strength", share * F.log1p(F.col("toxic").cast("double"))))
    words, stems = ({r["term"].rstrip("*"): r for r in strong.where(F.col("term").endswith("*") == star)
                     .orderBy(F.desc("strength"), "term").limit(lexicon_terms).collect()} for star in (False, True))
    # A prefix counts as one only if it has clearly more texts than any single word with it.
    most: dict[str, int] = {}
    for word, row in words.items():
        for n in PREFIXES:
            most[word[:n]] = max(most.get(word[:n], 0), row["toxic"])
    prefixes = {p: float(r["strength"]) for p, r in stems.items() if r["toxic"] >= 1.5 * most.get(p, 0)}
    lexicon = Lexicon({w: float(r["strength"]) for w, r in words.items() if not any(w[:n] in prefixes for n in PREFIXES)}, prefixes)
    shared = spark.sparkContext.broadcast(lexicon)
    ordinary = counts.where((F.col("clean") > 0) & ~F.col("term").endswith("*")).select("term")
    lexicon.known = {r[0] for r in ordinary.mapInArrow(lambda it: near_rows(it, shared.value), "term string").limit(SAMPLE_ROWS).collect()}
    lexicon.cache = {}
    final = spark.sparkContext.broadcast(lexicon)
    rows = texts.select("label", "text").mapInArrow(
        lambda it: feature_rows(it, final.value), "key int, features array<double>").toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(-1, 4)
    w = fit_logistic(x, rows["key"].to_numpy(float), ridge=1e-5)
    # A quoted or misspelled term speaks for toxicity too, a quoted one less than an open one, however few were seen.
    w[0] = max(w[0], 0.0)
    w[1] = float(np.clip(w[1], 0.0, 0.5 * w[0]))
    w[2] = max(w[2], 0.0)
    w[3] = max(w[3], 0.0)
    return lexicon, w


def toxicity_scores(docs: DataFrame, training: DataFrame, sample_rows: int = SAMPLE_ROWS,
                    lexicon_terms: int = LEXICON_TERMS) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of each row of ``docs``, learned from ``training`` (``doc_id``, ``label`` 0/1).

    At most ``sample_rows`` training rows, the first by a hash of the id, are used; their labels are broadcast to find
    their texts. Lexicon and weights are bounded by parameters and broadcast. Only the text enters a score.

    Null and empty texts score as texts without any term. Repeated training rows count once (a toxic label wins); rows
    that repeat a ``doc_id`` are scored each; a null ``doc_id`` stays null. Without training rows every score is 0.5.
    """
    from recoflow.llm.common import labelled_sample

    sample = cut(labelled_sample(training, "label", sample_rows))
    texts = cut(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label"))
    lexicon, w = learn(texts, lexicon_terms)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = docs.select("doc_id", "text").mapInArrow(
        lambda it: feature_rows(it, shared.value), "doc_id long, features array<double>")
    logit = F.lit(float(w[4]))
    for i in range(4):
        logit = logit + F.lit(float(w[i])) * F.col("features")[i]
    return rows.select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"))
