"""Stretches whose anchor stands in one place leave before they are dealt out."""

from __future__ import annotations

from recoflow.llm import common, substring_dedup


def test_lone_stretches_are_not_dealt_out(spark, monkeypatch):
    """All stretches were dealt out by name and digest, three times."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join([*[f"a{n}x{i}" for i in range(400)], passage if n < 3 else "end", *[f"b{n}x{i}" for i in range(400)]]) for n in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = []

    def cut(df, plain=substring_dedup.cut):
        written.append(plain(df))
        return written[-1]

    monkeypatch.setattr(substring_dedup, "cut", cut)
    rows = {row.doc_id: row for row in substring_dedup.without_repeats(docs).collect()}
    every, few = [df for df in written if "digest_a" in df.columns and "starts" in df.columns][:2]
    places = every.groupBy("anchor").count()
    shared = every.join(places.where("count > 1"), "anchor", "left_semi").select(*few.columns)
    assert shared.count() > 0 and shared.exceptAll(few).count() == 0
    assert few.count() <= shared.count() + 5 and every.count() > 10 * few.count()
    for n in range(40):
        assert rows[n].text == (texts[n].replace(passage + " ", "") if n < 3 else texts[n])


def test_sieve_of_few_places_changes_no_result(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [" ".join([f"a{n}", passage, *[f"b{n % 3}x{i}" for i in range(40 + n)]]) for n in range(12)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(substring_dedup.without_repeats(docs).collect())
    monkeypatch.setattr(common, "SIFT_BITS", 8)
    assert sorted(substring_dedup.without_repeats(docs).collect()) == rows
