"""Tumbling-window aggregates of behaviour events and the top lists made from them.

The same functions serve batch tables and streams: on a stream, pass a watermark.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from recoflow.functions.scoring import preference_score
from recoflow.operators.events import moment

WINDOW_LENGTH = "30 seconds"
WATERMARK = "1 minute"
TOP_N = 10


def _watermarked(events: DataFrame, watermark: str | None) -> DataFrame:
    return events.withWatermark("event_time", watermark) if watermark else events


def behavior_aggregate(events: DataFrame, length: str = WINDOW_LENGTH, watermark: str | None = None) -> DataFrame:
    """Events and mean rating per window, user and behaviour type."""
    return (
        _watermarked(events, watermark)
        .groupBy(F.window("event_time", length).alias("w"), "user_id", "behavior_type")
        .agg(F.count(F.lit(1)).alias("event_count"), F.avg("rating").alias("avg_rating"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "user_id", "behavior_type", "event_count", F.round("avg_rating", 2).alias("avg_rating"),
        )
    )


def preference_delta(events: DataFrame, length: str = WINDOW_LENGTH, watermark: str | None = None) -> DataFrame:
    """Score and interactions per window, user and item; groups without a positive score vanish."""
    score = preference_score(F.col("behavior_type"), F.col("rating"))
    return (
        _watermarked(events, watermark)
        .groupBy(F.window("event_time", length).alias("w"), "user_id", "item_id")
        .agg(F.round(F.sum(score), 2).alias("score_delta"), F.count(F.lit(1)).alias("interaction_delta"))
        .filter(F.col("score_delta") > 0.0)
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "user_id", "item_id", "score_delta", "interaction_delta",
        )
    )


def item_scores(events: DataFrame, length: str = WINDOW_LENGTH, watermark: str | None = None) -> DataFrame:
    """Score per window, user and item."""
    delta = preference_delta(events, length, watermark)
    return delta.select("window_start", "window_end", "user_id", "item_id", F.col("score_delta").alias("score"))


def latest_window(scores: DataFrame) -> DataFrame:
    """Rows of each user's latest window.

    The latest end per user is an aggregate joined back on user and end, so the rows of a busy user
    spread over their windows instead of meeting in one task.
    """
    latest = scores.groupBy("user_id").agg(F.max("window_end").alias("window_end"))
    return scores.join(latest, ["user_id", "window_end"], "left_semi")


def top_items(scores: DataFrame, n: int = TOP_N) -> DataFrame:
    """Best n items per user and window: score descending, then item id."""
    ranking = Window.partitionBy("user_id", "window_start", "window_end").orderBy(F.desc("score"), F.asc("item_id"))
    return scores.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= n)


def latest_top_items(scores: DataFrame, n: int = TOP_N) -> DataFrame:
    """Best n items of each user's latest window.

    Sorted by window end first, the n best rows of a user begin with those of the latest window. So
    one top-n per user does both steps, and a map task forwards at most n rows of a user.
    """
    per_user = Window.partitionBy("user_id")
    ranking = per_user.orderBy(F.desc("window_end"), F.desc("score"), F.asc("item_id"))
    ranked = scores.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= n)
    latest = ranked.withColumn("_latest", F.max("window_end").over(per_user))
    return latest.filter(F.col("window_end") == F.col("_latest")).drop("_latest")


def item_lists(ranked: DataFrame) -> DataFrame:
    """One row per user and window with the ranked items as an array (at most n per list)."""
    item = F.struct(F.col("rank").alias("rank"), F.col("item_id").alias("itemId"), F.round("score", 2).alias("score"))
    return ranked.groupBy("user_id", "window_start", "window_end").agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )


def recommendation_messages(ranked: DataFrame, generated_at: datetime | Column) -> DataFrame:
    """Messages of the recommendation topic: key = user, value = JSON with the ranked items."""
    at = generated_at if isinstance(generated_at, Column) else moment(generated_at)
    body = F.struct(
        F.col("user_id").alias("userId"), at.alias("generatedAt"),
        F.col("window_start").alias("windowStart"), F.col("window_end").alias("windowEnd"), "items",
    )
    return item_lists(ranked).select(F.col("user_id").cast("string").alias("key"), F.to_json(body).alias("value"))
