"""Rounds of components: the state is counted while the links are written."""

from __future__ import annotations

import random

from recoflow.llm import common


def test_components_count_their_state_as_they_write(spark, monkeypatch):
    """Each round read its links again in a job of its own."""
    written = []
    monkeypatch.setattr(common, "cut", lambda df, plain=common.cut: written.append(df) or plain(df))
    pick = random.Random(5)
    links = [(pick.randrange(400), pick.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(90)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    counted = []
    first = type(frame).first
    monkeypatch.setattr(type(frame), "first", lambda df: counted.append(df) or first(df))
    found = common.components(frame)
    assert len(written) > 3 and not counted
    least = {}
    for _ in range(500):
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least.get(a, a), least.get(b, b))
    rows = found.collect()
    assert len(rows) == len(least) and {row.node: row.component for row in rows} == least


def test_components_of_no_links(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert common.components(spark.createDataFrame([(3, 3)], "a long, b long")).collect() == []
