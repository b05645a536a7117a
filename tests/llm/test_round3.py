"""Hard negatives, phrase collocations and language identification against brute force, and on rows that are null, empty, long or repeated."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from recoflow.llm import collocations, hard_negatives, language_id
from recoflow.llm.common import table
from recoflow.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
INF, NAN = float("inf"), float("nan")


def mined(rows, every=100, positives=5, negatives=10):
    """Straight from the contract, over (id, label, vector)."""
    usable = [(i, lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in rows
              if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor in sorted({r for r in usable if r[0] % every == 0}):
        scored = sorted(((sum(a * b for a, b in zip(anchor[2], v)), i, lab) for i, lab, v in usable if i != anchor[0] and len(v) == len(anchor[2])),
                        key=lambda x: (-x[0], x[1]))
        for ps, pid, _ in [x for x in scored if x[2] == anchor[1]][:positives]:
            good = [x for x in scored if x[2] != anchor[1] and 30 * ps <= 100 * x[0] <= 90 * ps][:negatives]
            out += [(anchor[0], pid, k + 1, nid, ps, ns) for k, (ns, nid, _) in enumerate(good)]
    return sorted(out)


def check_mined(spark, rows, **parameters):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("shard", F.lit("x")).withColumn("twin", F.lit(1))
    got = hard_negatives.mine(frame, **parameters).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_hard_negatives(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(6, 12)) / 3
    rows = [(i, int(i % 3), (base[i % 6] + r.normal(size=12) / 6).tolist()) for i in range(460)]
    check_mined(spark, rows, shard_rows=90)
    # Ties: one vector that most rows share; negative and zero scores; components too large for 64-bit sums of a whole shard.
    check_mined(spark, [(i, i % 2, [0.5, -0.25, 0.0]) for i in range(330)] + [(400, 1, [-1.0, 1.0, 0.0]), (401, 1, [1.0, -1.0, 2.0]), (500, 0, [0.0] * 3)])
    large = [(600, 0, [3.0e5, -1.0]), (601, 0, [3.0e5, 1.0]), (602, 1, [1.5e5, 7.0]), (603, 1, [9.0e4, 0.1]), (604, 1, [2.0, 0.3]), (700, 0, [1.0, 1.0])]
    check_mined(spark, large + [(i, i % 2, [0.01 * i, 0.3]) for i in range(1, 40)])
    odd = [(None, 1, [1.0, 2.0]), (100, None, [1.0, 2.0]), (200, 1, None), (300, 1, [1.0, None]), (400, 1, [NAN, 1.0]), (500, 1, [INF, 1.0]),
           (600, 1, [1.0, 1.0]), (600, 1, [1.0, 1.0]), (601, 1, [1.0, 1.0]), (602, 2, [0.5, 0.5]), (602, 2, [0.5, 0.5]), (700, 1, [1.0]), (701, 1, [1.0]),
           (702, 3, [0.5]), (800, 1, []), (801, 1, []), (802, 2, [])]
    check_mined(spark, odd)
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<double>")
    assert hard_negatives.mine(empty).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, 1, [1.0])], empty.schema)).count() == 0


def test_hard_negative_scores_beyond_64_bits(spark):
    rows = [(100, 0, [2.0 ** 40, 1.0]), (101, 0, [2.0 ** 40, 2.0]), (102, 0, [2.0 ** 40, 1.0]), (103, 1, [2.0 ** 39, 1.0]), (104, 1, [2.0 ** 39, 3.0]), (105, 1, [1.0, 1.0])]
    got = hard_negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    # The order is exact although no score fits a long.
    assert [(r.positive_id, r.rank, r.negative_id) for r in sorted(got)] == [(101, 1, 104), (101, 2, 103), (102, 1, 104), (102, 2, 103)]
    assert {r.positive_score for r in got} == {r.negative_score for r in got} == {2 ** 63 - 1}


def test_bit_planes_give_inner_products():
    r = np.random.default_rng(7)
    for width in (1, 8, 13):
        a, c = r.integers(-300, 300, (5, width)), r.integers(-70, 300, (40, width))
        assert (hard_negatives.BitPlanes(c).scores(hard_negatives.subset_sums(a), 0, 40) == c @ a.T).all()


PIECE, PHRASE_WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
LOWER = {65 + i: 97 + i for i in range(26)}


def phrases(rows, least=10, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = PHRASE_WORD.findall(piece)
            total[lang or "und" if lang is None else lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        scored = []
        for p, a in candidates.items():
            if 100 * longer[p] >= 50 * a:
                continue
            score, _, l, r = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrase_rows(spark):
    r = np.random.default_rng(3)
    words = ["the", "of", "New", "york", "city", "a", "b", "c", "Ünï", "x1", "漢字", "w" * 70]
    chance = np.array([8, 6, 3, 3, 2, 4, 2, 2, 1, 1, 1, 1]) / 34
    rows = []
    for i in range(260):
        line = " ".join(r.choice(words, p=chance, size=int(r.integers(0, 30))))
        rows.append((line.replace(" a ", ", a ").replace(" b ", "\t b\x0b "), ["en", "de", None, ""][i % 4]))
    rows += [(None, "en"), ("", "en"), (" \t ", "fr"), (". , ;", "fr"), ("same same " * 400, "en"), ("rare pair", "fr"), ("one", None)]
    rows += [("all of one kind of text", "en")] * 40
    return rows


@pytest.mark.parametrize("share, bits, least", [(16, 1 << 26, 10), (2, 1024, 10), (3, 1 << 20, 25), (1000, 1 << 26, 10)])
def test_collocations(spark, share, bits, least):
    rows = phrase_rows(spark)
    frame = spark.createDataFrame(rows, "text string, lang string").select("*", F.lit(1).alias("k"), F.lit("p").alias("phrase"), F.lit(2).alias("n"))
    got = collocations.collocations(frame, least=least, sample_share=share, bits=bits)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == phrases(rows, least)


def test_collocations_cut_and_nothing(spark):
    frame = spark.createDataFrame(phrase_rows(spark), "text string, lang string")
    top = collocations.collocations(frame, top=3)
    assert sorted(map(tuple, top.select(*COLUMNS).collect())) == phrases(phrase_rows(spark), top=3)
    assert collocations.collocations(frame.where("lang = 'xx'")).count() == 0


def test_passes_go_on_until_closed(spark):
    """Phrases whose parts the sample does not hold need further passes, of triples one more than of pairs."""
    rows = [(f"alpha beta gamma{'' if i % 2 else ' '}", "en") for i in range(40)] + [(f"filler{i} text", "en") for i in range(400)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    hashes = [r[0] for r in frame.where("text like 'alpha%'").select(F.xxhash64("text")).distinct().collect()]
    share = next(n for n in range(50, 500) if all(h % n for h in hashes))
    known, passes = collocations.frequent_phrases(frame, sample_share=share)
    assert passes == 3
    assert {(r.phrase, r.n) for r in known.where("k > 1").collect()} == {("alpha beta", 40), ("beta gamma", 40), ("alpha beta gamma", 40)}


def segmentations(word, pieces):
    if not word:
        return [()]
    return [(p, *rest) for n in range(1, len(word) + 1) if (p := word[:n]) in pieces for rest in segmentations(word[n:], pieces)]


def test_all_segmentations_are_summed():
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"abc", b" abca", b"ca", b"b\xc3", b"\xc3\xa9"})
    vocabulary = language_id.Vocabulary(*language_id.Vocabulary.arrays(pieces))
    at = {p: i for i, p in enumerate(pieces)}
    model = np.random.default_rng(2).dirichlet(np.ones(len(pieces)), size=3)
    words = [b" abcab", b" a", b" bb", b" abc\xc3\xa9", b" ababab"]
    for place, lattice in language_id.lattices(words, vocabulary, 2):
        scores = lattice.log_probability(np.ascontiguousarray(model.T))
        for row, i in enumerate(place.tolist()):
            for g in range(3):
                total = sum(math.prod(model[g, at[p]] for p in s) for s in segmentations(words[i], at))
                assert math.isclose(scores[row, g], math.log(total), rel_tol=1e-9)


def test_expected_counts_weigh_segmentations():
    import pyarrow as pa

    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"abc"})
    arrays, at = language_id.Vocabulary.arrays(pieces), {p: i for i, p in enumerate(pieces)}
    model = np.random.default_rng(4).dirichlet(np.ones(len(pieces)), size=2)
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y", "y"]), pa.array(["abab", "ab", "abc"]), pa.array([3, 1, 2])], names=["lang", "word", "n"])
    got = np.zeros(model.size)
    for rows in language_id.expected_rows(iter([batch]), arrays, ["x", "y"], model):
        got[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    expected = np.zeros_like(model)
    for g, word, n in ((0, b" abab", 3), (1, b" ab", 1), (1, b" abc", 2)):
        ways = [(s, math.prod(model[g, at[p]] for p in s)) for s in segmentations(word, at)]
        for s, p in ways:
            for piece in s:
                expected[g, at[piece]] += n * p / sum(w for _, w in ways)
    assert np.allclose(got.reshape(model.shape), expected)


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op11_language_id"](spark, sf_dir).toPandas().merge(table(spark, sf_dir, "documents").select("doc_id", "lang").toPandas())
    held = found[found.held_out]
    assert len(found) == 1000 and len(held) > 150 and (held.lang == held.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all()


def test_language_of_odd_texts(spark):
    training = spark.createDataFrame([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("the house", "en"), (None, "en"), ("", "de"), ("12", "de"),
                                      ("no language", None), ("книга и дом", "ru")], "text string, lang string")
    texts = [None, "", "12 + 3", "\u0301", "The Dog", "die katze!", "КНИГА", "x" * 2_000_000, "und " * 300_000, "Die\u00a0Katze", "word " * 70, "e\u0301"]
    docs = spark.createDataFrame([(None if i == 5 else i, t) for i, t in enumerate(texts)] + [(4, "The Dog")], "doc_id long, text string").select(
        "*", F.lit("q").alias("lang"), F.lit(0).alias("score"), F.lit("p").alias("lang_pred"))
    rows = language_id.identify(docs, training, MODEL).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 1
    assert [got[i].lang_pred for i in (0, 1, 2, 3)] == ["und"] * 4 and {got[i].score for i in (0, 1, 2, 3)} == {0.0}
    assert (got[4].lang_pred, got[None].lang_pred, got[6].lang_pred, got[8].lang_pred, got[9].lang_pred) == ("en", "de", "ru", "de", "de")
    assert all(got[i].lang_pred in ("en", "de", "ru") for i in (7, 10, 11))
    assert {r.lang_pred for r in language_id.identify(docs, training.where("lang = 'none'"), MODEL).collect()} == {"und"}
    assert language_id.identify(docs.where("doc_id > 99"), training, MODEL).count() == 0


def test_slices_lose_nothing():
    letter = language_id.letters()
    texts = ["Ab cd\nEf", None, "", "é" + "x " * 10, "word " * (language_id.SLICE // 3), "9 Ωmega\u0301"]
    seen = defaultdict(list)
    for owners, text in language_id.slices(texts):
        words = language_id.Words(text, letter)
        for a, z, line in zip(words.starts.tolist(), words.ends.tolist(), words.line.tolist()):
            seen[owners[line]].append(text[a:z])
    assert {i: w for i, w in seen.items()} == {0: ["ab", "cd", "ef"], 3: ["éx", *["x"] * 9], 4: ["word"] * (language_id.SLICE // 3), 5: ["ωmega\u0301"]}
