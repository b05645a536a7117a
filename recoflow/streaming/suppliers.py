"""Streaming normalisation of raw supplier payloads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from recoflow.operators import supplier
from recoflow.operators.merge import newer_wins
from recoflow.schemas import RAW_PAYLOAD_MESSAGE
from recoflow.session import cut_lineage
from recoflow.sources.sinks import read_table, touched_partitions, upsert_table

KEYS = ["supplier_id", "erp_type", "source_record_id"]
BUCKETS = 64


@dataclass(frozen=True)
class SupplierPaths:
    records: str
    dead_letters: str
    checkpoints: str


def decode_payloads(messages: DataFrame) -> DataFrame:
    """Raw payload messages (columns seq, value, maybe partition) to payload rows.

    Offsets count within a partition, so the partition is part of a message's place; 0 where messages carry none.
    """
    m = F.from_json(F.col("value").cast("string"), RAW_PAYLOAD_MESSAGE)
    partition = F.coalesce("partition", F.lit(0)) if "partition" in messages.columns else F.lit(0)
    return messages.select("seq", partition.cast("int").alias("partition"), m.alias("m")).select(
        "seq", "partition", F.col("m.supplierId").alias("supplier_id"), F.col("m.supplierCode").alias("supplier_code"),
        F.col("m.erpType").alias("erp_type"), F.col("m.rawPayload").alias("raw_payload"),
        F.col("m.pageToken").alias("page_token"), F.col("m.nextPageToken").alias("next_page_token"),
        F.col("m.pulledAt").alias("pulled_at"), F.col("m.recordCount").alias("record_count"),
    )


def supplier_sink(paths: SupplierPaths, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Per micro-batch: parse, merge records by pull time, file dead letters.

    Records are bucketed by supplier, so a batch rewrites only the buckets of its suppliers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = cut_lineage(supplier.parse_payloads(decode_payloads(batch)))
        rows = supplier.records(parsed, keep=("seq", "partition"))
        # Arrival order inside a batch: payload offset first, then its partition, then the position inside the payload.
        rows = rows.withColumn("arrival", F.struct("seq", "partition", "item_index")).drop("seq", "partition", "item_index")
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("supplier_id"), F.lit(buckets)).cast("int"))
        stored = read_table(spark, paths.records)
        if stored is not None:
            stored = touched_partitions(stored, rows, ["bucket"])
        merged = newer_wins(rows, KEYS, "pulled_at", "arrival", F.current_timestamp(), stored)
        upsert_table(paths.records, merged, KEYS, ["bucket"])
        letters = supplier.dead_letters(parsed, F.current_timestamp()).withColumn(
            "batch_id", F.lit(batch_id).cast("bigint"))
        if not letters.isEmpty():
            letters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
                paths.dead_letters)

    return write


def start_supplier_stream(messages: DataFrame, paths: SupplierPaths, available_now: bool = False,
                          trigger: str = "10 seconds", buckets: int = BUCKETS) -> StreamingQuery:
    when = {"availableNow": True} if available_now else {"processingTime": trigger}
    return (
        messages.writeStream.option("checkpointLocation", paths.checkpoints).trigger(**when)
        .foreachBatch(supplier_sink(paths, buckets)).start()
    )
