"""Serving of versioned recall lists and upkeep of the model registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from recoflow.operators.merge import upsert
from recoflow.operators.skew import pick_row

MODEL_NAME = "user-cf-als"
REGISTRY_COLUMNS = ["model_name", "current_version", "previous_version", "status", "updated_at"]


def active_version(registry: DataFrame, model_name: str = MODEL_NAME) -> str:
    """Version that is being served; an error when there is none."""
    row = (
        registry.filter((F.col("model_name") == model_name) & (F.col("status") == "ACTIVE"))
        .select("current_version").first()
    )
    if row is None or row[0] is None:
        raise LookupError(f"No active model version for {model_name}")
    return row[0]


def known_versions(registry: DataFrame, model_name: str = MODEL_NAME) -> list[str]:
    """Current and previous version whatever the status (at most two)."""
    row = registry.filter(F.col("model_name") == model_name).select("current_version", "previous_version").first()
    return [] if row is None else [version for version in row if version is not None]


def of_version(recall: DataFrame, version: str) -> DataFrame:
    """Recall rows of one version; a partition filter when the table is partitioned by it."""
    return recall.filter(F.col("model_version") == version)


def on_shelf(recall: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add item details; items missing from the catalog are gone.

    The catalog grows with the business, so the join carries no broadcast hint: Spark decides by the
    size it measures.
    """
    return recall.join(catalog.select("item_id", "name", "category", "price", "tags"), "item_id")


def unseen(recall: DataFrame, preference: DataFrame) -> DataFrame:
    """Drop items the user has already interacted with."""
    return recall.join(preference.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def first_per_user(recall: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows per user in rank order; the original rank stays."""
    position = F.row_number().over(Window.partitionBy("user_id").orderBy("rank_position"))
    return recall.withColumn("_position", position).filter(F.col("_position") <= limit).drop("_position")


def serve(recall: DataFrame, version: str, catalog: DataFrame, preference: DataFrame, limit: int) -> DataFrame:
    """Recall for all users: active version, on the shelf, not seen, limited after the filters."""
    rows = of_version(recall, version).select("user_id", "item_id", "rank_position", "score")
    return first_per_user(on_shelf(unseen(rows, preference), catalog), limit).select(
        "user_id", "item_id", "rank_position", "score", "name", "category", "price", "tags"
    )


def serve_active(recall: DataFrame, registry: DataFrame, catalog: DataFrame, preference: DataFrame, limit: int,
                 models: Sequence[str] | None = None) -> DataFrame:
    """``serve`` with the version that the registry names, for all active models or the given ones; adds ``model_name``.

    The version is joined, not fetched while the plan is made: a model that switches between plan and run is served by its new
    version, and Spark prunes the partitions of the others. A model without an active version serves nothing.
    """
    active = registry.filter((F.col("status") == "ACTIVE") & F.col("current_version").isNotNull())
    active = active if models is None else active.filter(F.col("model_name").isin(list(models)))
    versions = active.select("model_name", F.col("current_version").alias("model_version"))
    rows = unseen(recall.join(versions, "model_version").select("model_name", "user_id", "item_id", "rank_position", "score"), preference)
    position = F.row_number().over(Window.partitionBy("model_name", "user_id").orderBy("rank_position"))
    best = on_shelf(rows, catalog).withColumn("_position", position).filter(F.col("_position") <= limit)
    return best.select("model_name", "user_id", "item_id", "rank_position", "score", "name", "category", "price", "tags")


def serve_user(recall: DataFrame, version: str, catalog: DataFrame, preference: DataFrame,
               user_id: int, limit: int) -> DataFrame:
    """Recall list of one user in rank order."""
    mine = F.col("user_id") == user_id
    return serve(recall.filter(mine), version, catalog, preference.filter(mine), limit).orderBy("rank_position")


def for_users(recall: DataFrame, version: str, users: DataFrame) -> DataFrame:
    """Recall of the listed users, ordered by user and rank."""
    return (
        of_version(recall, version).join(users.select("user_id").distinct(), "user_id", "left_semi")
        .orderBy("user_id", "rank_position")
    )


def by_category(catalog: DataFrame, category: str, low: object = None, high: object = None) -> DataFrame:
    """Items of a category, optionally within a price range (both ends included, either may be open)."""
    rows = catalog.filter(F.col("category") == category)
    if low is not None:
        rows = rows.filter(F.col("price") >= F.lit(low))
    return rows if high is None else rows.filter(F.col("price") <= F.lit(high))


def switch_version(registry: DataFrame, releases: DataFrame, status: str = "ACTIVE") -> DataFrame:
    """Publish new versions: the current one becomes the previous one.

    ``releases`` has model_name, new_version and updated_at, one row per model.
    """
    current = registry.select("model_name", F.col("current_version").alias("previous_version"))
    incoming = releases.join(current, "model_name", "left").select(
        "model_name", F.col("new_version").alias("current_version"), "previous_version",
        F.lit(status).alias("status"), "updated_at",
    )
    return upsert(registry.select(*REGISTRY_COLUMNS), incoming, ["model_name"])


def purge_recall(recall: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Recall rows that stay; nothing is purged when no version is known."""
    return recall.filter(F.col("model_version").isin(list(keep))) if keep else recall


def newest_version(versions: DataFrame) -> DataFrame:
    """Newest model version by creation time."""
    return versions.orderBy(F.desc("created_at"), F.desc("model_version")).limit(1)


def latest_per_key(table: DataFrame, key: str, time_column: str, id_column: str) -> DataFrame:
    """Latest row per key by time, then id."""
    return pick_row(table, [key], F.struct(time_column, id_column))
