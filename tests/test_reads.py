"""Reads of single users and items, serving of one user, transitions, latest windows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recoflow.operators import events, ledger, preference, profile, recall, windows
from recoflow.plans import tables
from recoflow.sources import readers
from recoflow.streaming import orders as order_stream


@pytest.fixture(scope="module")
def matrix(spark, sf_dir):
    return tables.preference_matrix(spark, sf_dir).cache()


def test_reads_are_sorted_by_score(matrix):
    rows = preference.of_user(matrix, 3).collect()
    assert {r.user_id for r in rows} == {3}
    scores = [r.preference_score for r in rows]
    assert scores == sorted(scores, reverse=True) and scores
    assert {r.item_id for r in preference.of_item(matrix, rows[0].item_id).collect()} == {rows[0].item_id}


def test_window_reads_are_newest_first(spark, sf_dir):
    daily = windows.behavior_aggregate(tables.behavior_events(spark, sf_dir), "1 day")
    rows = preference.aggregates_of_user(daily, 2, datetime(2024, 1, 10)).collect()
    starts = [r.window_start for r in rows]
    assert starts == sorted(starts, reverse=True) and min(starts) > datetime(2024, 1, 10)


def test_serving_one_user_equals_serving_all(spark, sf_dir, matrix):
    lists, catalog = tables.recall_lists(spark, sf_dir), tables.item_catalog(spark, sf_dir)
    everyone = recall.serve(lists, "als_v2", catalog, matrix, 5).filter("user_id = 4").collect()
    mine = recall.serve_user(lists, "als_v2", catalog, matrix, 4, 5).collect()
    assert sorted(everyone) == sorted(mine) and 0 < len(mine) <= 5
    ranks = [r.rank_position for r in mine]
    assert ranks == sorted(ranks)
    seen = {r.item_id for r in preference.of_user(matrix, 4).collect()}
    assert not seen & {r.item_id for r in mine}


def test_serving_follows_the_registry(spark, sf_dir, matrix):
    lists, catalog = tables.recall_lists(spark, sf_dir), tables.item_catalog(spark, sf_dir)
    lists = lists.withColumn("rank_position", F.when(F.col("model_version") == "als_v1", F.col("rank_position") + 100).otherwise(F.col("rank_position")))
    def registry(*rows):
        return spark.createDataFrame(rows, "model_name string, current_version string, status string")

    def served(*rows, models=None):
        got = recall.serve_active(lists, registry(*rows), catalog, matrix, 5, models).filter("user_id = 4")
        return sorted((r.model_name, r.item_id, r.rank_position) for r in got.collect())

    second = recall.serve(lists, "als_v2", catalog, matrix, 5).filter("user_id = 4").collect()
    first = recall.serve(lists, "als_v1", catalog, matrix, 5).filter("user_id = 4").collect()
    both = sorted([("m", r.item_id, r.rank_position) for r in second] + [("n", r.item_id, r.rank_position) for r in first])
    rows = ("m", "als_v2", "ACTIVE"), ("n", "als_v1", "ACTIVE"), ("o", "als_v1", "RETIRED"), ("p", None, "ACTIVE"), ("q", "gone", "ACTIVE")
    assert served(*rows) == both and both
    assert served(*rows, models=["n", "o"]) == [r for r in both if r[0] == "n"]


def test_newest_version(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "model_version string, created_at int")
    assert recall.newest_version(rows).first().model_version == "b"


def test_latest_window_and_top_items_agree(spark, sf_dir):
    scores = windows.item_scores(tables.behavior_events(spark, sf_dir), "12 hours")
    two_steps = windows.top_items(windows.latest_window(scores), 3).select("user_id", "item_id", "rank")
    one_step = windows.latest_top_items(scores, 3).select("user_id", "item_id", "rank")
    assert sorted(two_steps.collect()) == sorted(one_step.collect())


def test_bot_rule_on_both_thresholds(spark):
    now = datetime(2024, 1, 1, 12)
    rows = [(1, "VIEW", now)] * 51 + [(2, "VIEW", now)] * 50 + [(3, "VIEW", now)] * 600 + [(3, "CLICK", now)] * 401
    rows += [(4, "VIEW", now - timedelta(hours=2))] * 60 + [(4, "VIEW", now)]
    df = spark.createDataFrame(rows, "user_id int, behavior_type string, event_time timestamp_ntz")
    got = {r.user_id: r.is_bot for r in profile.bot_users(df, now).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False}


def test_event_checks(spark):
    now = datetime(2024, 1, 2)
    rows = [(0, 1, "VIEW", None, now), (1, 0, "VIEW", None, now), (1, 1, "LOOK", None, now), (1, 1, "VIEW", None, None),
            (1, 1, "VIEW", None, now + timedelta(seconds=1)), (1, 1, "RATE", 9.0, now), (1, 1, "rate", 5.0, now)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "id int, user_id int, item_id int, behavior_type string, rating double, "
                               "event_time timestamp_ntz")
    got = [r[0] for r in df.orderBy("id").select(events.reject_reason(now)).collect()]
    assert got == ["USER_ID", "ITEM_ID", "BEHAVIOR_TYPE", "EVENT_TIME", "FUTURE", "RATING", None]
    assert events.valid_events(df, now).count() == 2


def test_conditional_transition(spark):
    rows = spark.createDataFrame([(1, "UNPAID", 1), (2, "PAYING", 1), (3, "UNPAID", 1)], "order_no int, status string, updated_at int")
    asked = spark.createDataFrame([(1, 5), (2, 5)], "order_no int, updated_at int")
    moved = ledger.conditional_transition(rows, asked, "UNPAID", "PAYING").orderBy("order_no").collect()
    assert [tuple(r) for r in moved] == [(1, "PAYING", 5), (2, "PAYING", 1), (3, "UNPAID", 1)]


def test_ttl_dedup_on_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text("\n".join(
        f'{{"topic":"t","event_id":"{e}","occurred_at":"2024-01-01T00:00:0{i}"}}' for i, e in enumerate("aabca")))
    schema = "topic string, event_id string, occurred_at timestamp_ntz"
    stream = order_stream.within_ttl(readers.file_stream(spark, str(source), schema))
    query = (stream.writeStream.format("memory").queryName("ttl_dedup").outputMode("append")
             .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "chk")).start())
    query.awaitTermination(60)
    assert sorted(r.event_id for r in spark.table("ttl_dedup").select("event_id").collect()) == ["a", "b", "c"]


def test_portrait_of_a_new_visitor(spark):
    profiles = spark.createDataFrame([(1, " ", None, None, "", None)],
                                     "user_id int, nickname string, gender string, age_range string, region string, "
                                     "preference_tags string")
    summary = spark.createDataFrame([(2, "VIEW", 3), (2, "PURCHASE", 1)], "user_id int, behavior_type string, total_count int")
    texts = {r.user_id: r.portrait for r in profile.user_portraits(profiles, summary).collect()}
    assert "- 昵称：未设置\n- 性别：未知\n- 年龄段：未知\n- 地域：未知\n- 行为记录：暂无（新用户）\n" in texts[1]
    assert "新访客\n- 近 7 天行为分布：\n  - 浏览：3 次\n  - 购买：1 次\n- 行为模式：比价型" in texts[2]


def test_tags_of_one_day(spark, sf_dir):
    e = tables.behavior_events(spark, sf_dir)
    shares = profile.active_hour_tags(e, 24).groupBy("user_id").agg(F.sum("confidence").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in shares)
