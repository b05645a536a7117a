"""ALS training, publication of recall lists and upkeep of versions."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from recoflow.operators import recall as recall_ops
from recoflow.operators.events import moment
from recoflow.session import cut_lineage, shared_checkpoint_dir
from recoflow.sources import sinks

SOURCE = "ALS"
MAX_INT = 2**31 - 1


@dataclass(frozen=True)
class AlsSettings:
    """Hyper-parameters and training filter; the seed makes runs repeatable."""

    rank: int = 20
    max_iter: int = 10
    reg_param: float = 0.05
    alpha: float = 20.0
    top_k: int = 50
    window_days: int = 90
    min_interactions: int = 1
    min_score: float = 0.1
    seed: int = 42
    blocks: int | None = None


ROWS_PER_BLOCK, LEAST_BLOCKS = 2_000_000, 10


def training_rows(preference: DataFrame, now: datetime, settings: AlsSettings = AlsSettings()) -> DataFrame:
    """Recent, strong enough preferences."""
    since = moment(now - timedelta(days=settings.window_days))
    return preference.filter(
        (F.col("last_window_end") >= since)
        & (F.col("interaction_count") >= settings.min_interactions)
        & (F.col("preference_score") >= settings.min_score)
    )


def ratings(rows: DataFrame) -> DataFrame:
    """ALS input of its own ids: user_id, item_id, float rating; rows without an id or a score are no input."""
    scored = rows.select("user_id", "item_id", F.col("preference_score").cast("float").alias("rating"))
    return scored.dropna()


def wide(rows: DataFrame, column: str) -> bool:
    """Whether some id does not fit the integers that ALS takes."""
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return ends.low is not None and (ends.low < -MAX_INT - 1 or ends.high > MAX_INT)


def narrowed(rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Ratings with integer ids, and a map (id, dense_id) for each column whose own ids are too wide."""
    maps = {}
    for column in ("user_id", "item_id"):
        if wide(rows, column):
            maps[column] = cut_lineage(dense_ids(rows, column))
            rows = rows.join(maps[column], column).drop(column).withColumnRenamed("dense_id", column)
    return rows.select(*[F.col(c).cast("int").alias(c) for c in ("user_id", "item_id")], "rating"), maps


def widened(recommended: DataFrame, maps: dict[str, DataFrame]) -> DataFrame:
    """Recall rows with the ids they came with."""
    for column, ids in maps.items():
        own = ids.select(F.col("dense_id").cast("bigint").alias(column), F.col(column).alias("_own"))
        recommended = recommended.join(own, column).withColumn(column, F.col("_own")).drop("_own")
    return recommended


def block_count(rows: DataFrame, settings: AlsSettings) -> int:
    """Blocks of users and of items: as set, or as many as keep a block's ratings at ``ROWS_PER_BLOCK``."""
    return settings.blocks or max(LEAST_BLOCKS, -(-rows.count() // ROWS_PER_BLOCK))


def dense_ids(rows: DataFrame, column: str) -> DataFrame:
    """Map of a wide id column to 0, 1, 2, … for catalogs whose ids do not fit an integer.

    Ids are sorted by range, numbered inside each partition, and shifted by the partition sizes, so
    no partition sees more than its own ids. The sorted ids are materialised first, because both
    passes must see the same partitions.
    """
    ids = cut_lineage(
        rows.select(column).distinct().repartitionByRange(column).sortWithinPartitions(column)
        .withColumn("_part", F.spark_partition_id())
    )
    sizes = {r[0]: r[1] for r in ids.groupBy("_part").count().collect()}
    offset, start = {}, 0
    for part in sorted(sizes):
        offset[part], start = start, start + sizes[part]
    if start > MAX_INT:
        raise ValueError(f"{column} has more than {MAX_INT} distinct values")
    shifts = rows.sparkSession.createDataFrame(list(offset.items()), "_part int, _offset bigint")
    position = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    numbered = ids.withColumn("_position", position).join(F.broadcast(shifts), "_part")
    return numbered.select(column, (F.col("_position") + F.col("_offset")).cast("int").alias("dense_id"))


def user_count(rows: DataFrame) -> int:
    """Distinct users; training without any is an error."""
    count = rows.select("user_id").distinct().count()
    if count == 0:
        raise ValueError("No training data available for ALS")
    return count


def train_als(rows: DataFrame, settings: AlsSettings = AlsSettings()) -> ALSModel:
    """Implicit-feedback ALS with nonnegative factors."""
    shared_checkpoint_dir(rows.sparkSession)
    blocks = block_count(rows, settings)
    als = ALS(
        userCol="user_id", itemCol="item_id", ratingCol="rating", rank=settings.rank, maxIter=settings.max_iter,
        regParam=settings.reg_param, alpha=settings.alpha, implicitPrefs=True, nonnegative=True,
        coldStartStrategy="drop", seed=settings.seed, numUserBlocks=blocks, numItemBlocks=blocks,
        checkpointInterval=5,
    )
    return als.fit(rows)


def recommend_all(model: ALSModel, top_k: int = 50) -> DataFrame:
    """Best items per user; items the user has seen are not left out here."""
    return model.recommendForAllUsers(top_k)


def flatten_recall(recommendations: DataFrame, version: str, created_at: datetime) -> DataFrame:
    """One row per user and item with the rank from the position in the list."""
    return (
        recommendations.select("user_id", F.posexplode("recommendations").alias("pos", "r"))
        .select(
            F.lit(version).alias("model_version"), F.col("user_id").cast("bigint").alias("user_id"),
            F.col("r.item_id").cast("bigint").alias("item_id"), (F.col("pos") + 1).cast("int").alias("rank_position"),
            F.col("r.rating").cast("double").alias("score"), F.lit(SOURCE).alias("source"),
            moment(created_at).alias("created_at"), moment(created_at).alias("updated_at"),
        )
    )


def version_name(now: datetime) -> str:
    return now.strftime("als_%Y%m%d%H%M%S")


def als_recall(preference: DataFrame, now: datetime, settings: AlsSettings = AlsSettings()) -> DataFrame:
    """Train and list recommendations without publishing."""
    rows, maps = narrowed(cut_lineage(ratings(training_rows(preference, now, settings))))
    return recall_rows(train_als(rows, settings), maps, now, settings)


def recall_rows(model: ALSModel, maps: dict[str, DataFrame], now: datetime, settings: AlsSettings) -> DataFrame:
    flat = flatten_recall(recommend_all(model, settings.top_k), version_name(now), now)
    return widened(flat, maps).select(*flat.columns)


def list_invariants(lists: DataFrame) -> DataFrame:
    """Per version and user what holds of every recall list whatever its scores: ranks are 1 to ``items``, scores never
    rise, no item comes twice. One shuffle on the user; lists hold ``top_k`` rows at most."""
    above = Window.partitionBy("model_version", "user_id").orderBy("rank_position")
    marked = lists.select(
        "model_version", "user_id", "item_id", "rank_position",
        F.coalesce(F.col("score") <= F.lag("score").over(above), F.col("score").isNotNull()).alias("_falls"))
    return marked.groupBy("model_version", "user_id").agg(
        F.count(F.lit(1)).alias("items"),
        ((F.min("rank_position") == 1) & (F.max("rank_position") == F.count(F.lit(1)))
         & (F.sum("rank_position") * 2 == F.count(F.lit(1)) * (F.count(F.lit(1)) + 1))).alias("ranks_dense"),
        F.every("_falls").alias("scores_fall"),
        (F.size(F.collect_set("item_id")) == F.count(F.lit(1))).alias("items_distinct"))


@dataclass(frozen=True)
class TrainingResult:
    """Outcome of a training run; ``steps`` are the stages it went through."""

    model_name: str
    model_version: str
    previous_version: str | None
    top_k: int
    user_count: int
    recall_rows: int
    steps: list[str] = field(default_factory=list)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    schema = ("model_name string, current_version string, previous_version string, status string, "
              "updated_at timestamp_ntz")
    stored = sinks.read_table(spark, path)
    return spark.createDataFrame([], schema) if stored is None else stored


def train_and_publish(
    preference: DataFrame, recall_path: str, registry_path: str, now: datetime,
    model_name: str = recall_ops.MODEL_NAME, settings: AlsSettings = AlsSettings(),
) -> TrainingResult:
    """Train, write the recall rows, then switch the active version.

    The version changes only after all rows are written; a run that fails leaves the old one active.
    """
    spark = preference.sparkSession
    steps = ["LOADING_DATA"]
    known = recall_ops.known_versions(read_registry(spark, registry_path), model_name)
    rows = cut_lineage(ratings(training_rows(preference, now, settings)))
    users = user_count(rows)
    steps.append("FITTING_MODEL")
    rows, maps = narrowed(rows)
    model = train_als(rows, settings)
    version = version_name(now)
    steps.append("WRITING_RECALL")
    written = sinks.append_recall(recall_rows(model, maps, now, settings), recall_path)
    steps.append("SWITCHING_VERSION")
    release = spark.createDataFrame([(model_name, version, now)],
                                    "model_name string, new_version string, updated_at timestamp_ntz")
    switched = recall_ops.switch_version(read_registry(spark, registry_path), release)
    sinks.replace_table(switched, registry_path)
    steps.append("SUCCEEDED")
    return TrainingResult(model_name, version, known[0] if known else None, settings.top_k, users, written, steps)


def clean_up_recall(spark: SparkSession, recall_path: str, registry_path: str,
                    model_name: str = recall_ops.MODEL_NAME) -> int:
    """Drop recall versions other than the current and the previous one; returns the rows removed."""
    keep = recall_ops.known_versions(read_registry(spark, registry_path), model_name)
    return sinks.drop_recall_versions(spark, recall_path, keep)
