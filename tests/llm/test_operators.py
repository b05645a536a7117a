"""Each operator against brute force or its SQL twin on the small tables, and on rows that are null, empty, long or repeated."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from recoflow.llm import (decontamination, html_template, importance, kd_search, licenses, near_dup, packing, substring_dedup,
                          tool_calls, toxicity)
from recoflow.llm.common import components, table
from recoflow.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(20_000))
COPY = " ".join(f"same{i}" for i in range(60))
ODD = [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "one two", "en"), (5, COPY, "en"), (6, COPY, "en"), (6, COPY, "en"),
       (7, "one one " * 40, "en"), (8, LONG, "en"), (None, "lost words here", None), (9, "Ünïcode “quotes” 漢字 \U0001f600 text", "de")]
SCHEMA = "doc_id long, text string, lang string"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns whose names the operators use themselves."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    return rows.select("*", F.lit("x").alias("row"), F.lit(1).alias("component_id"), F.lit(2).alias("kept"), F.lit("s").alias("source"),
                       F.length("text").cast("long").alias("n_chars"), F.lit(0).alias("stay_id"), F.lit(0).alias("hit_id"))


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where(F.lit(False))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")


def cells(frame):
    return sorted(map(repr, frame.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    theirs = duck.execute(ORACLES[name]).df()
    ours = QUERIES[name](spark, sf_dir).toPandas()[list(theirs.columns)]
    assert cells(ours.astype(object).where(ours.notna(), None)) == cells(theirs.astype(object).where(theirs.notna(), None))


def windows_removed(texts, size=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone |= set(range(i, i + size))
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


def check_substrings(docs):
    rows = docs.select("doc_id", "text").collect()
    expected = sorted((repr(r.doc_id), *x) for r, x in zip(rows, windows_removed([r.text for r in rows])))
    got = substring_dedup.remove_repeats(docs).select("rest.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((repr(r[0]), *r[1:]) for r in got) == expected


def test_substrings(spark, sf_dir, odd, nothing):
    check_substrings(table(spark, sf_dir, "documents"))
    check_substrings(odd)
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert substring_dedup.without_repeats(odd).columns == odd.columns


def shingles(text):
    w = WORD.findall((text or "").translate({65 + i: 97 + i for i in range(26)}))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def check_near(docs):
    rows = [(r.doc_id, shingles(r.text)) for r in docs.select("doc_id", "text").collect()]
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [(i, s) for i, s in rows if i is not None and s]
    for k, (a, x) in enumerate(known):
        for b, y in known[:k]:
            if min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    expected = sorted((repr(i), len(s), repr(None if i is None else find(i)), i is None or find(i) == i) for i, s in rows)
    got = near_dup.near_duplicates(docs).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in got) == expected


def test_near_duplicates(spark, sf_dir, odd, nothing):
    check_near(table(spark, sf_dir, "documents"))
    check_near(odd)
    assert near_dup.near_duplicates(nothing).count() == 0
    stay = near_dup.keep_one(odd)
    assert stay.columns == odd.columns
    assert sorted(repr(r.doc_id) for r in stay.collect()) == ["1", "2", "3", "4", "5", "7", "8", "9", "None"]


def near_copies(count, changes, size, seed, first=0):
    """Texts of ``size`` words that each differ from one base in about ``changes`` words of their own."""
    import random

    rng = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(size)]
    out = []
    for i in range(count):
        words = list(base)
        for at in rng.sample(range(size), rng.choice(changes)):
            words[at] = f"c{rng.randrange(40)}" if rng.random() < 0.5 else f"o{seed}y{i}z{at}"
        out.append((first + i, " ".join(words)))
    return out


def test_near_copies_below_and_above_the_threshold(spark):
    rows = (near_copies(60, (0, 1, 2, 3, 4, 5), 80, 1) + near_copies(60, (3, 4), 100, 2, 1000)
            + near_copies(60, (4, 5, 6), 120, 3, 2000) + near_copies(40, (2, 3), 60, 4, 3000))
    # An id with two texts of different groups, and a text twice under one id.
    rows += [(5000, rows[70][1]), (5000, rows[130][1]), (5001, rows[5][1]), (5001, rows[5][1])]
    check_near(spark.createDataFrame(rows, "doc_id long, text string"))


def candidate_pairs(spark, count):
    docs = spark.createDataFrame(near_copies(count, (6, 7), 150, 7), "doc_id long, text string").cache()
    members = docs.select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("grp"), F.lit(146).cast("long").alias("n"))
    found = near_dup.Differences(members, docs, 5, 75)
    none = spark.createDataFrame([], "node long, component long")
    return found.pairs(none).select("a", "b").distinct().count()


def test_candidates_of_copies_below_the_threshold_stay_few(spark):
    # Similarities of 0.55 to 0.7: all 44,850 pairs of 300 copies would share a bucket.
    assert candidate_pairs(spark, 300) < 300


def test_densification_borrows_from_full_bins():
    ask = near_dup.probes(16)
    values = np.full(16, near_dup._EMPTY)
    values[3] = 7
    assert set(near_dup.densified(values, ask)) == {7}


def test_search_with_repeated_ids_and_large_components(spark):
    """A query that repeats loses none of its neighbours to its own rows; sums beyond 64 bits keep their order."""
    rng = np.random.default_rng(6)
    rows = [(20, [1.0, 1.0])] * 60 + [(i, [float(x) for x in rng.integers(-9, 9, 2)]) for i in range(101, 161) if i % 20]
    rows += [(40, [300000.0, 1.0]), (41, [3e6, -2.0]), (60, [2.0 ** 25, 1.5]), (61, [2.0 ** 31 + 256, 1.0]), (80, [1e20, 1.0])]
    whole = [(i, [int(64 * x) for x in v]) for i, v in rows]
    clip = lambda s: max(-1 << 63, min((1 << 63) - 1, s))
    expected = []
    for q, a in dict((i, v) for i, v in whole if i % 20 == 0).items():
        near = sorted((-clip(sum(x * y for x, y in zip(a, v))), i) for i, v in whole if i != q)[:20]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (1 << 16, 16):
        assert sorted(map(tuple, kd_search.top_k(vectors, shard_rows=shard_rows).collect())) == sorted(expected)


def test_packing_splits_where_the_tokenizer_does(spark):
    """Separators of str.split that are no white space, every other white space, and words told apart by one generation."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = [f"a{chr(c)}b {chr(c)} c{chr(c)}" for c in [*range(1, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200D), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]
    texts += [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(30)] + ["same words again"] * 5 + texts[:9]
    expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for limit in (16, 1 << 20):
        cache = packing.WordCache(TOKENIZER, limit)
        assert [ids for k in range(0, len(texts), 7) for ids in cache.encode(texts[k:k + 7])] == expected
        assert len(cache.words) + len(cache.older) <= limit + 7 * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids_crc32 for r in packing.pack(docs, TOKENIZER).collect()}
    assert got == {i: zlib.crc32(ids + bytes(4)) for i, ids in enumerate(expected)}


def test_words_outlive_a_task():
    first = packing.worker_cache(TOKENIZER)
    assert packing.worker_cache(TOKENIZER) is first


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_packing(spark, sf_dir, odd, nothing):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for docs in (table(spark, sf_dir, "documents"), odd):
        rows = packing.pack(docs, TOKENIZER).collect()
        expected = Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
            expected.update((r.doc_id, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes()))
                            for k, at in enumerate(range(0, len(ids), 2048)))
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
        by = {}
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == by.get(r.sequence_id, 0)
            by[r.sequence_id] = r.offset + r.length
        assert max(by.values()) <= 2048
        assert len(by) <= -(-sum(r.length for r in rows) // 2048) * 1.1 + 1
    assert packing.pack(nothing, TOKENIZER).count() == 0


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(s) for s in (6, 7, 3, 9, 8, 4, 1)] == [(0, 0), (1, 0), (1, 7), (2, 0), (3, 0), (0, 6), (3, 8)]


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination(spark, odd, nothing):
    item = "The quick brown foxes of the northern hills were seen jumping over eleven lazy dogs at dawn"
    plain = lambda t: decontamination.normalised(np.frombuffer(t.lower().encode(), np.uint8))[0].tobytes().strip()
    cases = [item, item.upper().replace(" ", ",  "), item.replace("eleven", "twelve"), item[:40] + item[48:], item.replace("quick brown", "slow grey green"),
             "no match here at all", "the the the the the the the the the the the the the the the the the the the the the"]
    docs = spark.createDataFrame([(i, f"Some words before. {c} And some after!") for i, c in enumerate(cases)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short"), (1, item)], "item_id long, text string")
    k = min(len(plain(item)) * 10 // 100, (len(plain(item)) - 8) // 8)
    expected = {(i, distance(plain(item), plain(c))) for i, c in enumerate(cases) if distance(plain(item), plain(c)) <= k}
    rows = decontamination.matches(docs, bench).collect()
    assert {(r.doc_id, r.edits) for r in rows} == expected and len(rows) == len(expected)
    first = next(r for r in rows if r.doc_id == 0)
    assert f"Some words before. {item} And"[first.start:first.end] == item
    assert decontamination.matches(odd, bench).count() == 0
    assert decontamination.matches(nothing, bench).count() == 0
    assert decontamination.matches(docs, bench.where("item_id > 1")).count() == 0
    assert decontamination.decontaminated(odd, bench).columns == odd.columns
    assert decontamination.decontaminated(odd, bench).count() == len(ODD)


def test_blocks_of_the_benchmark_change_nothing(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    assert sorted(decontamination.matches(docs, bench).collect()) == sorted(decontamination.matches(docs, bench, block_chars=3000).collect())


def test_importance(spark, sf_dir, odd, nothing, labels):
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stay = {r.doc_id for r in importance.sample_by_importance(docs, marks).collect()}
    judged = [(r.quality, r.doc_id in stay) for r in marks.collect()]
    assert sum(q == s for q, s in judged) >= 0.95 * len(judged)
    assert importance.sample_by_importance(docs, marks, k=50).count() == 50
    assert importance.keep_sampled(odd, labels).columns == odd.columns
    assert importance.sample_by_importance(odd, labels, k=100).count() == len(ODD)
    assert importance.sample_by_importance(nothing, labels).count() == 0
    assert importance.sample_by_importance(odd, labels.where("doc_id > 99")).count() <= len(ODD)


def test_top_k_bound_is_exact(spark):
    rows = spark.range(500).select("id", (F.pmod(F.col("id") * 7919, F.lit(101)) / 7 - 6.0).alias("key"))
    values = sorted((r.key for r in rows.collect()), reverse=True)
    for k in (1, 17, 250, 499, 500, 900):
        bound = values[min(k, 500) - 1]
        assert sorted(r.key for r in importance.selected(rows, "key", k).collect()) == sorted(v for v in values if v >= bound - 1e-9)


def test_toxicity(spark, sf_dir, odd, nothing, labels):
    ours = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.01").toPandas()
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = ours[ours.held_out].merge(marks, on="doc_id")
    order = held.score.rank()
    ones = held.toxic == 1
    auc = (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert auc > 0.85 and ours.score.between(0, 1).all()
    training = labels.select("doc_id", F.col("toxic").alias("label"))
    assert toxicity.toxicity_scores(odd, training).count() == len(ODD)
    assert toxicity.toxicity_scores(nothing, training).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(odd, training.where("doc_id > 99")).collect()} == {0.5}


def test_lexicon_reads_misspelled_and_quoted_terms():
    lexicon = toxicity.Lexicon({"stupid": 3.0, "scum": 2.0}, {"idiot": 4.0}, {"stupor"})
    assert lexicon.weight("stupid") == (3.0, False) and lexicon.weight("stuupid")[1] and lexicon.weight("5tup1d")[1]
    assert lexicon.weight("idiotic") == (4.0, False) and lexicon.weight("scam") == (0.0, False) and lexicon.weight("clear") == (0.0, False)
    terms = ["stupid", "pathetic", "worthless"]
    other = toxicity.Lexicon({t: 1.0 for t in terms}, {})
    for word in ("stupid", "stpid", "xstupid", "stupidx", "pathetik", "worthles", "wothless", "wrtless", "patetik", "stupi"):
        near = min((distance_whole(word, t), t) for t in terms)
        assert (other.nearest(word) is not None) == (near[0] <= 1)
    said = 'he said "you stupid man" to me'
    assert lexicon.features(said)[0] == 0 and lexicon.features(said)[1] > 0 and lexicon.features("you stupid man")[0] > 0
    assert lexicon.features(None) == (0.0, 0.0, 0.0, 0.0)


def distance_whole(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_licenses(odd, nothing, spark):
    mit = licenses.KNOWN[11][1].replace("Copyright (c) <year> <copyright holders>", "COPYRIGHT 2024 Somebody").upper()
    docs = spark.createDataFrame([(1, mit), (2, "Words.\nReleased under the MIT license!\nsourced"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.line_licenses, r.n_license_lines) for r in licenses.scan(docs).collect()}
    assert got == {1: ("MIT", "", 0), 2: (None, "MIT", 1), 3: (None, "", 0)}
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(nothing).count() == 0


def test_html(spark, sf_dir):
    page = ('<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><a href="/">Menu</a></nav><div class="cookie-notice">Accept</div>'
            '<article><h1>Head &amp; line</h1><p><b>One <i>t</i>wo<br>three&nbsp; four<p>Five <div class="ad">Buy</div><form><input>Mail</form>'
            '<section class="comments"><p>First!</section></article><aside>Side</aside><footer>&copy; us</footer></body></html>')
    pages = spark.createDataFrame([(1, "http://a.b/1", page), (2, "http://a.b/2", page.replace("Five", "Six")), (3, "http://A.b/3", None), (4, None, ""),
                                   (5, "odd", "<p>Only text &am"), (1, "http://a.b/1", page), (6, "http://c.d/", "<article><p>Cut off <b")],
                                  "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("x"))
    got = sorted((r.rest.page_id, r.text, r.n_chars) for r in html_template.extract(pages).collect())
    one = "Head & line One two three four Five"
    assert got == [(1, one, len(one)), (1, one, len(one)), (2, one.replace("Five", "Six"), len(one) - 1), (3, "", 0), (4, "", 0),
                   (5, "Only text &am", 13), (6, "Cut off", 7)]
    assert html_template.extract(pages.where("page_id > 9")).count() == 0
    rows = QUERIES["op3_html_template"](spark, sf_dir).toPandas().set_index("page_id").text
    for r in table(spark, sf_dir, "pages").collect():
        assert "©" not in rows[r.page_id] and rows[r.page_id]


def test_search(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-40, 40, 6) / 32]) for i in range(300)] + [(i, [0.5] * 6) for i in range(300, 400)]
    rows += [(500, None), (520, [None] * 6), (540, [float("nan")] * 6), (560, [float("inf")] * 6), (580, [1.0, 2.0]), (581, [1.0, 1.0]), (None, [1.0] * 6), (600, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1))
    good = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = []
    for q in (i for i in good if i % 20 == 0):
        near = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:20]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    for shard_rows in (1 << 16, 64):
        assert sorted(map(tuple, kd_search.top_k(vectors, shard_rows=shard_rows).collect())) == sorted(expected)
    assert kd_search.top_k(vectors.where("vec_id > 999")).count() == 0


def test_tool_calls(spark, sf_dir):
    calls = spark.createDataFrame([
        (1, 0, "a", "lookup", '{"words": 2.0, "query": "x"}'), (1, 0, "a", "lookup", '{"words": 2.0, "query": "x"}'),
        (1, 2, "b", "lookup", '{"query": "y", "words": 1, "after": {"$ref": "a"}}'), (1, 4, "c", "summarise", '{"text": "z", "after": {"$ref": "b"}, "more": 1}'),
        (1, 5, "d", "lookup", '{"query": "", "after": {"$ref": "e"}}'), (1, 5, "e", "lookup", '{"query": "q", "words": 1, "after": {"$ref": "d"}}'),
        (1, 6, "f", "nothing", None), (1, 7, "g", "lookup", "{"), (2, 0, "a", "summarise", '{"text": "t", "after": {"$ref": "b"}}'), (None, 0, "a", "x", None), (3, 0, None, "x", None)],
        "conv_id long, turn long, call_id string, name string, arguments string")
    results = spark.createDataFrame([(1, "a", 1, "ok"), (1, "a", 3, "late"), (9, "a", 1, "stray"), (1, "b", 3, None)], "conv_id long, call_id string, turn long, content string")
    got = {(r.conv_id, r.call_id): r for r in tool_calls.link(calls, results).collect()}
    assert {k: r.level for k, r in got.items()} == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): None, (1, "e"): None, (1, "f"): 0, (1, "g"): 0, (2, "a"): 0}
    assert got[1, "a"].json == '{"arguments":{"query":"x","words":2},"id":"a","level":0,"name":"lookup","result":"ok"}' and got[1, "a"].n_results == 2
    assert got[1, "c"].errors == "$.more: unknown" and got[1, "f"].errors == "unknown tool" and got[1, "g"].errors == "$: not JSON"
    assert got[1, "d"].errors == "$.words: missing; $.query: too short; reference cycle" and got[2, "a"].errors == "unknown reference b"
    assert tool_calls.link(calls.where("conv_id > 9"), results).count() == 0
    chat = table(spark, sf_dir, "conversations")
    rows = QUERIES["op1_tool_calls"](spark, sf_dir).collect()
    texts = {(r.conv_id, r.turn): r.text for r in chat.collect()}
    assert len(rows) == chat.where("role = 'user'").count()
    for r in rows:
        assert texts[r.conv_id, r.turn] in (tool_calls.json.loads(r.arguments).get(k) for k in ("query", "text"))
        assert r.result == texts.get((r.conv_id, r.turn + 1)) and r.level == r.turn % 8 // 2


def test_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf_dir).cache()
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= kept.count(), name
        kept = out
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().collect()} == {r.doc_id for r in kept.select("doc_id").collect()}


def test_html_template_texts_are_no_slots(spark):
    def page(host, i, body):
        return f"http://{host}/{i}", f"<html><body><nav>Menu {i}</nav>{body}</body></html>"

    rows = [page("news.x", i, f"<article><div class='story'><p>Story {i}</p><p>Sign up here</p><p>{'Often' if i < 3 else f'Own {i}'}</p></div></article>") for i in range(8)]
    # A layout that a quarter of the host's pages has, with a text of its own.
    rows += [page("news.x", 10 + i, f"<article><section class='review'><p>Review {i}</p><p>Our test rules</p></section></article>") for i in range(3)]
    # Copies of one page, and two pages that share a text, do not make a template.
    rows += [(f"http://copy.x/{i}", "<article><p>Same</p></article>") for i in range(4)]
    rows += [page("two.x", i, f"<article><p>Part {i}</p><p>Shared</p></article>") for i in range(2)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = [r.text for r in sorted(html_template.extract(pages).collect(), key=lambda r: r.rest.page_id)]
    assert got == ([f"Story {i} " + ("Often" if i < 3 else f"Own {i}") for i in range(8)] + [f"Review {i}" for i in range(3)]
                   + ["Same"] * 4 + [f"Part {i} Shared" for i in range(2)])


def test_whole_licences_with_and_without_heading(spark):
    texts = {p.stem: p.read_text() for p in licenses.TEXTS.glob("*.txt")}
    assert set(texts) == {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"}
    cases = list(texts.items())
    mit = licenses.KNOWN[11][1].split("\n", 2)[2]
    cases += [("MIT", mit), ("MIT", f"The MIT License (MIT)\n\nCopyright (c) 2015 Somebody\n\n{mit}")]
    cases += [("BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright (c) 2020, Somebody\nAll rights reserved.\n\n{texts['BSD-3-Clause']}")]
    cases += [("MPL-2.0", texts["MPL-2.0"].split("\n\n", 1)[1]), ("Apache-2.0", texts["Apache-2.0"].split("\n\n", 1)[1])]
    cases += [("All-rights-reserved", "All rights reserved."), (None, texts["Apache-2.0"][:5000])]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(cases))] == [name for name, _ in cases]
    line = licenses.scan(spark.createDataFrame([(1, "Words.\nAll rights reserved.")], docs.schema)).first()
    assert (line.license, line.line_licenses) == (None, "All-rights-reserved")
