"""Sinks: keyed upserts into partitioned tables, appends, messages and dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recoflow.operators.merge import upsert
from recoflow.session import cut_lineage

MAX_PARTITION_VALUES = 1000


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """Parquet table at a path, None when nothing has been written yet."""
    try:
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def touched_partitions(stored: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a table in the partitions a batch falls into.

    Up to ``MAX_PARTITION_VALUES`` partition values become a filter that prunes folders before they
    are read; for more of them the values stay distributed and a semi join takes over. A null is a value like any other.
    """
    values = batch.select(*partition_by).distinct()
    listed = values.limit(MAX_PARTITION_VALUES + 1).collect()
    if len(listed) > MAX_PARTITION_VALUES:
        same = [stored[name].eqNullSafe(values[name]) for name in partition_by]
        return stored.join(values, reduce(and_, same), "left_semi")
    if len(partition_by) == 1:
        known = [row[0] for row in listed if row[0] is not None]
        condition = F.col(partition_by[0]).isin(known)
        return stored.filter(condition if len(known) == len(listed) else F.col(partition_by[0]).isNull() | condition)
    rows = [reduce(and_, [F.col(name).eqNullSafe(F.lit(row[name])) for name in partition_by]) for row in listed]
    return stored.filter(reduce(or_, rows, F.lit(False)))


def upsert_table(
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order: Column | None = None,
) -> None:
    """Replace or add rows of a Parquet table by key, rewriting only the touched partitions.

    The partition columns must follow from the key, so that a key never moves. Writing the same
    batch twice leaves the same table, which makes replays of a micro-batch harmless.
    """
    spark = incoming.sparkSession
    batch = cut_lineage(incoming)
    if batch.isEmpty():
        return
    # With the types of the batch: those of partition columns are else guessed from folder names.
    stored = read_table(spark, path, batch.schema)
    merged = batch
    if stored is not None:
        current = touched_partitions(stored, batch, partition_by).select(*batch.columns)
        merged = cut_lineage(upsert(current, batch, keys, order))
    elif order is not None:
        merged = upsert(batch.limit(0), batch, keys, order)
    (
        merged.repartition(*partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole table. The rows are materialised first, so ``df`` may read from ``path``."""
    (
        cut_lineage(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by).parquet(path)
    )


def write_by_mode(df: DataFrame, path: str, mode: str, primary_key: str | None = None,
                  partition_by: Sequence[str] = (), order: Column | None = None) -> None:
    """Write with a declared mode: APPEND, REPLACE or UPSERT on the primary key."""
    if mode == "APPEND":
        append_table(df, path, partition_by)
    elif mode == "REPLACE":
        replace_table(df, path, partition_by)
    elif mode == "UPSERT":
        if primary_key is None:
            raise ValueError("UPSERT needs a primary key")
        if partition_by:
            upsert_table(path, df, [primary_key], partition_by, order)
        else:
            stored = read_table(df.sparkSession, path)
            current = df.limit(0) if stored is None else stored.select(*df.columns)
            replace_table(upsert(current, df, [primary_key], order), path)
    else:
        raise ValueError(f"unknown write mode: {mode}")


def append_recall(recall: DataFrame, path: str) -> int:
    """Append recall rows partitioned by version and return their number.

    The rows are materialised once and then counted and written.
    """
    rows = cut_lineage(recall)
    append_table(rows, path, ["model_version"])
    return rows.count()


def drop_recall_versions(spark: SparkSession, path: str, keep: Sequence[str]) -> int:
    """Remove partitions of versions that are not kept; returns how many rows went away.

    Version folders are deleted through the file system of the table, no data is rewritten.
    """
    if not keep:
        return 0
    stored = read_table(spark, path)
    if stored is None:
        return 0
    old = stored.filter(~F.col("model_version").isin(list(keep))).groupBy("model_version").count().collect()
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in old:
        files.delete(jvm.org.apache.hadoop.fs.Path(folder, f"model_version={row[0]}"), True)
    return sum(row[1] for row in old)


def kafka_write(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish (key, value[, headers]) rows."""
    columns = [c for c in ("key", "value", "headers") if c in messages.columns]
    writer = messages.select(*columns).write.format("kafka").option("kafka.bootstrap.servers", servers)
    if "headers" in columns:
        writer = writer.option("includeHeaders", "true")
    writer.option("topic", topic).options(**options).save()


def message_files(messages: DataFrame, path: str) -> None:
    """Append messages as JSON lines."""
    messages.write.mode("append").json(path)


def dead_letter_messages(letters: DataFrame) -> DataFrame:
    """Order dead letters as messages with headers ``x-original-topic`` and ``x-error-reason``."""
    headers = F.array(
        F.struct(F.lit("x-original-topic").alias("key"), F.encode("original_topic", "UTF-8").alias("value")),
        F.struct(F.lit("x-error-reason").alias("key"), F.encode("error_reason", "UTF-8").alias("value")),
    )
    return letters.select(F.col("payload").alias("value"), headers.alias("headers"))
