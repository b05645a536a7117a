"""Session settings and lineage helpers shared by jobs, streams and tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job should run with on a cluster. Shuffle partition counts are left to AQE, which
# coalesces small partitions and splits skewed join partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Files behind cut lineages go away with the DataFrames that used them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "recoflow", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the library's settings; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def one_process(master: str) -> bool:
    """``local`` and ``local[…]``; ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is accepted only for a ``local`` master, where driver and executors
    are one process.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not one_process(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="recoflow-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that it survives lost executors."""
    shared_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
