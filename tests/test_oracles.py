"""Every registered query against its SQL twin in DuckDB."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from recoflow.plans.oracles import ORACLES
from recoflow.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
ROWS_ONLY = {"als_recall"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return round(value, 9) if isinstance(value, float) else str(value)


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_cell(v) for v in row) for row in frame.itertuples(index=False, name=None)),
                  key=lambda row: tuple((v is None, str(v)) for v in row))


def test_only_iterative_queries_lack_a_twin():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    ours, theirs = QUERIES[name](spark, sf_dir).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)


def test_entry(spark):
    best = entry(spark)
    assert best.columns[:3] == ["user_id", "rank", "item_id"]
    assert best.count() > 0


def test_als_lists_are_dense_and_descending(spark, sf_dir):
    frame = QUERIES["als_recall"](spark, sf_dir).toPandas()
    assert set(frame["source"]) == {"ALS"} and set(frame["model_version"]) == {"als_20240131000000"}
    for _, rows in frame.groupby("user_id"):
        rows = rows.sort_values("rank_position")
        assert list(rows["rank_position"]) == list(range(1, len(rows) + 1))
        assert (rows["score"].diff().dropna() <= 1e-9).all()
        assert rows["item_id"].is_unique
