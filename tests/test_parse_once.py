"""Supplier payloads are dealt out before they are parsed, and parsed once."""

from __future__ import annotations

import pytest

from recoflow.plans import queries, tables
from recoflow.plans.queries import QUERIES


@pytest.mark.parametrize("name", ["payload_results", "upsert_outcomes"])
def test_results_do_not_parse_again(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "raw_payload" not in plan


def test_payloads_of_one_file_are_dealt_out(spark, sf_dir, monkeypatch):
    """One small file is one task, and all its payloads were parsed in it."""
    monkeypatch.setattr(tables, "table", lambda s, d, name, read=tables.table: read(s, d, name).coalesce(1))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else few rows are merged again
    try:
        payloads = queries.t.raw_payloads(spark, sf_dir)
        assert payloads.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
