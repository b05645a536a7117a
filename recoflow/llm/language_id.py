"""Language identification: unigram piece models per language over a fixed vocabulary, summed over all segmentations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from recoflow.llm.common import _BYTE_POWERS, _BYTES, cut, mix

UNKNOWN = "und"
#: Rounds of expectation and maximisation, and pseudo-counts that each language takes from all languages' pieces.
ROUNDS, SHARED_COUNTS = 3, 100.0
#: Least probability of a piece, and factor a byte: together with MOST_BYTES they keep every sum inside a double.
LEAST, PER_BYTE = 1e-7, 3.0
#: A run of letters with more UTF-8 bytes than MOST_BYTES is scored as stretches of STRETCH letters.
MOST_BYTES, STRETCH = 48, 12
#: Words whose scores a task keeps, words per lattice, characters taken at a time: memory only, results do not depend on
#: them unless a run of letters is longer than SLICE.
KEPT_WORDS, LATTICE_WORDS, SLICE = 1 << 18, 1 << 14, 1 << 20
_LETTER = regex.compile(r"\p{L}")
_GAP = regex.compile(r"[^\p{L}\p{M}]")
_U = np.uint64


def pieces_of(model: str) -> list[bytes]:
    """The pieces of a public sentencepiece model that lower-case words can hold (a space stands for the word's begin), and all bytes."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    found = {bytes([b]) for b in range(256)}
    for i in range(len(processor)):
        piece = processor.id_to_piece(i)
        letters = piece[1:] if piece.startswith("▁") else piece
        if piece == "▁" or (regex.fullmatch(r"[\p{L}\p{M}]+", letters) and letters == letters.lower()):
            found.add((" " + letters if piece.startswith("▁") else letters).encode())
    return sorted(found)


def letters() -> np.ndarray:
    """Which code points are letters or marks, one bit each."""
    found = np.zeros(0x110000, bool)
    found[[ord(c) for c in regex.findall(r"[\p{L}\p{M}]", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))]] = True
    return np.packbits(found)


def slices(texts: list[str | None]) -> Iterator[tuple[list[int], str]]:
    """Texts in lower case joined by line ends, about ``SLICE`` characters at a time, and the number of the text of each line.

    A longer text is cut where a word ends; a run of over ``SLICE`` letters is cut inside.
    """
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > SLICE:
                gap = _GAP.search(text, at + SLICE, at + 2 * SLICE)
                end = gap.start() if gap else min(end, at + 2 * SLICE)
            owners.append(i)
            parts.append(text[at:end])
            size += end - at
            at = end
            if size >= SLICE:
                yield owners, "\n".join(map(_one_line, parts)) + "\n"
                owners, parts, size = [], [], 0
    if parts:
        yield owners, "\n".join(map(_one_line, parts)) + "\n"


def _one_line(text: str) -> str:
    return text.replace("\n", " ")


class Words:
    """The words (runs of letters and their marks) of joined lines: where they stand, their line, and a hash of each."""

    def __init__(self, text: str, letter: np.ndarray):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        full = np.zeros(len(points) + 1, bool)
        full[:-1] = (letter[points >> 3] >> (7 - (points & 7)).astype(np.uint8)) & 1
        turns = np.flatnonzero(full[1:] != full[:-1]) + 1
        if full[0]:
            turns = np.concatenate([[0], turns])
        self.starts, self.ends = turns[0::2], turns[1::2]
        self.line = np.searchsorted(np.flatnonzero(points == 10), self.starts)
        up, down = _BYTE_POWERS.take(len(points) + 1)
        sums = np.zeros(len(points) + 1, _U)
        np.cumsum((points.astype(_U) + _U(0x9E3779B97F4A7C15)) * _U(0xFF51AFD7ED558CCD) * up[:-1], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(_U))
        self.text = text

    def distinct(self, hashes: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The distinct words, the place of one occurrence of each, their counts, and for every word the number of its own."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)]
        at = order[new]
        inverse = np.empty(len(hashes), np.int64)
        inverse[order] = np.cumsum(new) - 1
        counts = np.diff(np.concatenate([np.flatnonzero(new), [len(ordered)]]))
        words = [self.text[a:z] for a, z in zip(self.starts[at].tolist(), self.ends[at].tolist())]
        return words, at, counts, inverse


def spoken(words: list[str]) -> np.ndarray:
    """Whether each holds a letter; a run of marks alone is no word."""
    return np.fromiter((w.isalpha() or _LETTER.search(w) is not None for w in words), bool, len(words))


def units(word: str) -> list[bytes]:
    """A word as bytes with its begin mark; a very long one in stretches, of which the first has the mark."""
    whole = (" " + word).encode("utf-8", "replace")
    if len(whole) <= MOST_BYTES:
        return [whole]
    return [((" " if i == 0 else "") + word[i:i + STRETCH]).encode("utf-8", "replace") for i in range(0, len(word), STRETCH)]


class Vocabulary:
    """Hashes of all pieces and of their prefixes; a prefix that is no piece has the number -1."""

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray, longest: int):
        self.longest, self.size = longest, int(numbers.max()) + 1
        # The leading bits of a hash give the first place to look; few hashes share them.
        lead = (hashes >> _U(44)).astype(np.int64)
        self.first = np.searchsorted(lead, np.arange(1 << 20)).astype(np.int32)
        self.probes = int(np.bincount(lead).max())
        self.hashes = np.concatenate([hashes, np.zeros(self.probes, _U)])
        self.numbers = np.concatenate([numbers, np.full(self.probes, -1)]).astype(np.int32)

    @staticmethod
    def arrays(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """What a vocabulary is made of, as plain arrays that workers read without this class."""
        numbers: dict[bytes, int] = {}
        for i, piece in enumerate(pieces):
            for n in range(1, len(piece)):
                numbers.setdefault(piece[:n], -1)
            numbers[piece] = i
        hashes = np.array([Lattice.hashes(np.frombuffer(p, np.uint8)[:, None])[1](0, len(p), np.zeros(1, np.int64))[0] for p in numbers], _U)
        order = np.argsort(hashes)
        return hashes[order], np.array(list(numbers.values()), np.int64)[order], max(map(len, numbers))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each is known, and its number."""
        at = self.first[(hashes >> _U(44)).astype(np.int64)]
        known = self.hashes[at] == hashes
        for _ in range(1, self.probes):
            at = at + ~known
            known = self.hashes[at] == hashes
        return known, self.numbers[at]


class Lattice:
    """All segmentations into pieces of words of one length: for each begin and size of a piece, the words that have one there."""

    def __init__(self, words: list[bytes], vocabulary: Vocabulary):
        self.length, self.count = len(words[0]), len(words)
        data = np.ascontiguousarray(np.frombuffer(b"".join(words), np.uint8).reshape(self.count, self.length).T)
        hash_of = self.hashes(data)[1]
        #: (begin, size, words, pieces), by begin.
        self.edges: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for begin in range(self.length):
            live = np.arange(self.count)
            for size in range(1, min(vocabulary.longest, self.length - begin) + 1):
                known, number = vocabulary.find(hash_of(begin, size, live))
                live, number = live[known], number[known]
                if not len(live):
                    break
                piece = number >= 0
                if piece.any():
                    self.edges.append((begin, size, live[piece], number[piece]))

    @staticmethod
    def hashes(data: np.ndarray):
        """Prefix sums of bytes [place, word], and the hash of a piece by begin, size and words."""
        up, down = _BYTE_POWERS.take(len(data) + 1)
        sums = np.zeros((len(data) + 1, data.shape[1]), _U)
        np.cumsum(_BYTES[data] * up[:-1, None], axis=0, out=sums[1:])
        return sums, lambda begin, size, words: mix((sums[begin + size][words] - sums[begin][words]) * down[begin] + _U(size))

    def forward(self, weights: list[np.ndarray]) -> np.ndarray:
        """[place, word, …]: sums over the segmentations before each place; ``weights`` has an array for each edge."""
        value = np.zeros((self.length + 1, self.count, *weights[0].shape[1:]))
        value[0] = 1.0
        for (begin, size, words, _), weight in zip(self.edges, weights):
            value[begin + size][words] += value[begin][words] * weight
        return value

    def backward(self, weights: list[np.ndarray]) -> np.ndarray:
        value = np.zeros((self.length + 1, self.count, *weights[0].shape[1:]))
        value[self.length] = 1.0
        for (begin, size, words, _), weight in zip(reversed(self.edges), reversed(weights)):
            value[begin][words] += value[begin + size][words] * weight
        return value

    def log_probability(self, model: np.ndarray) -> np.ndarray:
        """[word, language]: log of the sum over all segmentations; ``model`` is [piece, language]."""
        weights = [model[pieces] * np.exp(PER_BYTE * size) for _, size, _, pieces in self.edges]
        return np.log(self.forward(weights)[-1]) - PER_BYTE * self.length


def lattices(words: list[bytes], vocabulary: Vocabulary, step: int) -> Iterator[tuple[np.ndarray, Lattice]]:
    """The words by length, at most ``step`` at a time, with their places in the list."""
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.argsort(sizes, kind="stable")
    bounds = np.searchsorted(sizes[order], np.arange(1, int(sizes.max(initial=0)) + 2))
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        for begin in range(a, z, step):
            part = order[begin:min(begin + step, z)]
            yield part, Lattice([words[i] for i in part.tolist()], vocabulary)


def word_rows(batches: Iterator[pa.RecordBatch], letter: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of words by language, of a slice of a task's texts at a time."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        names = sorted(set(langs))
        at = {lang: i for i, lang in enumerate(names)}
        number = np.array([at[x] for x in langs], np.int64)
        for owners, text in slices(batch.column(0).to_pylist()):
            words = Words(text, letter)
            if not len(words.starts):
                continue
            lang = number[np.array(owners)][words.line]
            found, place, counts, _ = words.distinct(mix(words.hashes + lang.astype(_U)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()).take(pa.array(lang[place])), pa.array(found, pa.string()), pa.array(counts)],
                names=["lang", "word", "n"]).filter(pa.array(spoken(found)))


def expected_rows(batches: Iterator[pa.RecordBatch], arrays: tuple, langs: list[str], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Expected counts of pieces by language, the segmentations weighed by their probability; ``model`` is [language, piece]."""
    vocabulary = Vocabulary(*arrays)
    at, sums, flat = {lang: i for i, lang in enumerate(langs)}, np.zeros(model.size), model.reshape(-1)
    for batch in batches:
        parts = [units(w) for w in batch.column(1).to_pylist()]
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        lang = np.array([at[x] for x in batch.column(0).to_pylist()], np.int64)[row]
        n = batch.column(2).to_numpy()[row]
        for place, lattice in lattices([u for p in parts for u in p], vocabulary, LATTICE_WORDS):
            base = lang[place] * model.shape[1]
            cells = [base[words] + pieces for _, _, words, pieces in lattice.edges]
            weights = [flat[cell] * np.exp(PER_BYTE * size) for cell, (_, size, _, _) in zip(cells, lattice.edges)]
            ahead, behind = lattice.forward(weights), lattice.backward(weights)
            share = n[place] / ahead[-1]
            expected = [ahead[begin][words] * weight * behind[begin + size][words] * share[words]
                        for (begin, size, words, _), weight in zip(lattice.edges, weights)]
            sums += np.bincount(np.concatenate(cells), np.concatenate(expected), minlength=model.size)
    used = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["cell", "expected"])


def smoothed(expected: np.ndarray) -> np.ndarray:
    """Probabilities [language, piece] from expected counts; what a language lacks it takes from all languages together."""
    pool = expected.sum(axis=0) + 1.0
    counts = expected + SHARED_COUNTS * pool / pool.sum()
    model = np.maximum(counts / counts.sum(axis=1, keepdims=True), LEAST)
    return model / model.sum(axis=1, keepdims=True)


class Scorer:
    """Log probabilities of words per language; the words of a task are kept up to a bound and then learned again."""

    def __init__(self, vocabulary: Vocabulary, model: np.ndarray):
        self.vocabulary, self.model = vocabulary, np.ascontiguousarray(model.T)
        self.limit = max(1024, KEPT_WORDS * 4 // max(4, len(model)))
        self.step = max(64, LATTICE_WORDS * 4 // max(4, len(model)))
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model)))

    def __call__(self, words: list[str]) -> np.ndarray:
        """[word, language] of distinct words."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.limit:
            self.known, self.scores, new = {}, self.scores[:0], words
        if new:
            parts = [units(w) for w in new]
            flat = [u for part in parts for u in part]
            scores = np.empty((len(flat), self.scores.shape[1]))
            for place, lattice in lattices(flat, self.vocabulary, self.step):
                scores[place] = lattice.log_probability(self.model)
            begins = np.cumsum([0, *[len(p) for p in parts[:-1]]])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.scores = np.concatenate([self.scores, np.add.reduceat(scores, begins, axis=0)])
        return self.scores[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]


def label_rows(batches: Iterator[pa.RecordBatch], arrays: tuple, langs: list[str], model: np.ndarray, prior: np.ndarray,
               letter: np.ndarray) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(Vocabulary(*arrays), model) if langs else None
    for batch in batches:
        total, found = np.tile(prior, (batch.num_rows, 1)), np.zeros(batch.num_rows, bool)
        for owners, text in slices(batch.column(1).to_pylist()) if scorer else ():
            words = Words(text, letter)
            if not len(words.starts):
                continue
            names, _, _, inverse = words.distinct(words.hashes)
            real, owner = spoken(names), np.array(owners)[words.line]
            scores = scorer(names) * real[:, None]
            found[owner[real[inverse]]] = True
            for g in range(len(langs)):
                total[:, g] += np.bincount(owner, scores[inverse, g], minlength=batch.num_rows)
        if scorer:
            best = total.argmax(axis=1)
            sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            labels = [langs[b] if f else UNKNOWN for b, f in zip(best.tolist(), found.tolist())]
        else:
            labels, sure = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.string()), pa.array(np.where(found, sure, 0.0))],
                                         names=["doc_id", "lang_pred", "score"])


def learn(training: DataFrame, model: str, rounds: int = ROUNDS) -> tuple[tuple, list[str], np.ndarray, np.ndarray]:
    """Arrays of the vocabulary, languages, piece probabilities [language, piece] and log shares of documents, from ``text`` and ``lang``.

    All words of all training rows count: tasks count them by language, one shuffle adds them up, and each round turns the
    table of words into expected counts of pieces. What reaches the driver is bounded by pieces times languages.
    """
    known = training.where(F.col("lang").isNotNull()).select("text", "lang")
    documents = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    langs = sorted(documents)
    vocabulary = Vocabulary.arrays(pieces_of(model))
    prior = np.log(np.array([documents[x] for x in langs], float) / max(1, sum(documents.values())))
    size = Vocabulary(*vocabulary).size
    probability = np.full((len(langs), size), 1 / size)
    if not langs:
        return vocabulary, langs, probability, prior
    letter = training.sparkSession.sparkContext.broadcast(letters())
    words = cut(known.mapInArrow(lambda it: word_rows(it, letter.value), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    for _ in range(rounds):
        shared = training.sparkSession.sparkContext.broadcast((vocabulary, langs, probability))
        rows = (words.mapInArrow(lambda it: expected_rows(it, *shared.value), "cell long, expected double")
                .groupBy("cell").agg(F.sum("expected").alias("expected")).toArrow())
        expected = np.zeros(probability.size)
        expected[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
        probability = smoothed(expected.reshape(probability.shape))
    return vocabulary, langs, probability, prior


def identify(docs: DataFrame, training: DataFrame, model: str, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of each row of ``docs``, learned from ``training`` (``text``, ``lang``).

    A text's probability in a language is the product over its words of the sum over all ways to cut the word into pieces of
    the public vocabulary ``model``, of the products of the pieces' probabilities. The language with the largest product, times its
    share of the training documents, is predicted; ``score`` is its share of all languages' products.

    Texts that are null or hold no letter are ``und`` with score 0, as all texts are where nothing could be learned. Case, digits
    and marks do not count. Ties go to the first language by name. Rows that repeat are judged (and learned from) each; a null
    ``doc_id`` stays null. Very long texts are read in slices, whole. Other columns are ignored.
    """
    learned = docs.sparkSession.sparkContext.broadcast((*learn(training, model, rounds), letters()))
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: label_rows(it, *learned.value), "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept from learning: the checksum of the id is divisible by five; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0
