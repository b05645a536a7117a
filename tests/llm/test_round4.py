"""Texts that share no bucket leave before an exchange; equal stretches of one text are one row."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa

from recoflow.llm import common, near_dup, substring_dedup


def test_sifted_keeps_every_wanted_row_and_few_others(spark):
    rows = spark.range(-500, 500).selectExpr("id AS doc_id", "id AS __other").unionByName(
        spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id, 0L AS __other"))
    kept = common.sifted(rows, spark.range(-500, 500, 50).selectExpr("id * 1 AS wanted"))
    ids = [row.doc_id for row in kept.collect()]
    assert kept.columns == rows.columns
    assert set(range(-500, 500, 50)) <= set(ids) and 20 <= len(ids) <= 22
    assert common.sifted(rows, spark.range(0)).count() == 0


def test_sifted_lets_more_rows_pass_with_few_places(spark, monkeypatch):
    monkeypatch.setattr(common, "SIFT_BITS", 16)
    kept = common.sifted(spark.range(300).withColumnRenamed("id", "doc_id"), spark.range(100)).select("doc_id").collect()
    assert set(range(100)) <= {row.doc_id for row in kept}


def test_near_duplicates_deals_out_only_texts_that_share_a_bucket(spark, monkeypatch):
    """All texts were dealt out for a semi join."""
    words = [f"w{i}" for i in range(60)]
    texts = {0: words, 1: [*words[:-1], "end"]} | {i: [f"d{i}x{j}" for j in range(60)] for i in range(2, 200)}
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in texts.items()], "doc_id long, text string")
    written = []

    def cut(df, plain=near_dup.cut):
        plan = df._jdf.queryExecution().executedPlan().toString()
        written.append((df.columns, plan, plain(df)))
        return written[-1][2]

    monkeypatch.setattr(near_dup, "cut", cut)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = {row.doc_id: row for row in near_dup.near_duplicates(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan, held = next(x[1:] for x in written if x[0] == ["doc_id", "text"])
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(row.doc_id for row in held.collect())[:2] == [0, 1] and held.count() <= 4
    assert rows[1].component_id == 0 and not rows[1].kept and sum(row.kept for row in rows.values()) == 199


def test_equal_stretches_of_one_text_are_one_row(spark):
    """A text that repeats itself gave a row for each place, all of which the semi join returned."""
    line = " ".join(f"l{i}" for i in range(7))
    texts = [" ".join([line] * 60), " ".join(["same"] * 200), " ".join([line] * 30) + " " + " ".join(f"x{i}" for i in range(60)),
             " ".join(f"y{i}" for i in range(90)), "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["row", "text"])
    rows = [row for out in substring_dedup.segment_rows(iter([batch]), 35, 3) for row in out.to_pylist()]
    assert len({(r["row"], r["anchor"], r["digest_a"], r["digest_b"]) for r in rows}) == len(rows)
    windows = Counter((r["row"], start + i) for r in rows for start in r["starts"] for i in range(r["count"]))
    assert windows == Counter((i, at) for i, text in enumerate(texts) for at in range(len((text or "").split()) - 34))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["rest"].doc_id: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs).collect()}
    seen = Counter(tuple(words[at:at + 35]) for text in texts for words in [(text or "").split()] for at in range(len(words) - 34))
    for i, text in enumerate(texts):
        words = (text or "").split()
        gone = {at + k for at in range(len(words) - 34) if seen[tuple(words[at:at + 35])] > 1 for k in range(35)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert got[i] == (len(words), len(gone), kept if gone else text)
