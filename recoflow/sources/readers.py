"""Batch and streaming sources."""

from __future__ import annotations

import csv
import fnmatch
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recoflow.schemas import BEHAVIOR_MESSAGE

# Fixed value: the largest cap that may be asked of a topic.
KAFKA_LIMIT = 10_000


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Topic as a stream that starts at the newest offset and survives lost data."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for name, value in {"startingOffsets": "latest", "failOnDataLoss": "false", **options}.items():
        reader = reader.option(name, value)
    return reader.load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files: int | None = None) -> DataFrame:
    """Folder of message files as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).load(path)


def decode_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Behaviour messages to columns.

    Text that is no JSON and rows without a user vanish. A malformed time becomes null instead of
    stopping the query; ``unreadable_events`` shows those rows.
    """
    e = F.from_json(F.col(value).cast("string"), BEHAVIOR_MESSAGE)
    return _event_columns(messages.select(e.alias("e"))).filter(F.col("user_id").isNotNull())


def _event_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("e.eventId").alias("event_id"), F.col("e.userId").alias("user_id"), F.col("e.itemId").alias("item_id"),
        F.col("e.behaviorType").alias("behavior_type"), F.col("e.rating").alias("rating"),
        F.col("e.sessionId").alias("session_id"), F.col("e.deviceInfo").alias("device_info"),
        F.try_to_timestamp(F.col("e.timestamp")).alias("event_time"),
    )


def unreadable_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that ``decode_events`` cannot use, with the reason."""
    e = F.from_json(F.col(value).cast("string"), BEHAVIOR_MESSAGE)
    reason = (
        F.when(F.col("e.userId").isNull(), F.lit("NO_USER"))
        .when(F.try_to_timestamp(F.col("e.timestamp")).isNull(), F.lit("BAD_TIME"))
    )
    return messages.withColumn("e", e).withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        F.col(value).cast("string").alias("value"), "reason")


def jdbc_query(spark: SparkSession, url: str, sql: str, partition_column: str | None = None,
               bounds: tuple[int, int] | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """Result of a query that runs in the database; with bounds it is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column is None:
        reader = reader.option("query", sql)
    else:
        reader = (
            reader.option("dbtable", f"({sql}) source").option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
        )
    return reader.options(**options).load()


def kafka_batch(spark: SparkSession, servers: str, topic: str, max_records: int | None = None, **options: str) -> DataFrame:
    """Records of a topic as text with partition, offset and time; with ``max_records`` only the first by time."""
    if max_records is not None and not 1 <= max_records <= KAFKA_LIMIT:
        raise ValueError(f"max_records must be between 1 and {KAFKA_LIMIT}")
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for name, value in {"startingOffsets": "earliest", "endingOffsets": "latest", **options}.items():
        reader = reader.option(name, value)
    records = message_columns(reader.load())
    return records if max_records is None else records.orderBy("timestamp", "partition", "offset").limit(max_records)


def message_columns(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset", "timestamp",
    )


def glob_matches(text: Column, pattern: str) -> Column:
    """Key pattern with ``*``, ``?`` and ``[…]``; plain prefixes stay prefix tests that can be pushed down."""
    if re.fullmatch(r"[^*?\[\]\\]*\*", pattern):
        return text.startswith(pattern[:-1])
    return text.rlike("(?s)^" + _glob_regex(pattern) + "$")


def _glob_regex(pattern: str) -> str:
    translated = fnmatch.translate(pattern)
    return re.sub(r"^\(\?s:(.*)\)\\[zZ]$", r"\1", translated, flags=re.S)


def key_value_dump(dump: DataFrame, pattern: str = "*", max_keys: int | None = None,
                   order: Sequence[str] = ("key",), max_items: int | None = None) -> DataFrame:
    """Keys of an exported key-value store with their value as text.

    ``dump`` has key, type, text, fields, items. Hashes become JSON objects, sets JSON arrays, lists
    and sorted sets JSON arrays, of their first ``max_items`` elements where that is given. ``max_keys``
    keeps the first keys by ``order``.
    """
    kind, items = F.col("type"), F.coalesce("items", _no_items())
    value = (
        F.when(kind == "string", F.col("text"))
        .when(kind == "hash", F.to_json(F.coalesce("fields", F.create_map().cast("map<string,string>"))))
        .when(kind.isin("list", "zset"), F.to_json(items if max_items is None else F.slice(items, 1, max_items)))
        .when(kind == "set", F.to_json(items))
        .otherwise(F.concat(F.lit("(unsupported type: "), F.coalesce(kind, F.lit("unknown")), F.lit(")")))
    )
    found = dump.filter(glob_matches(F.col("key"), pattern)).select(
        "key", F.coalesce(kind, F.lit("unknown")).alias("type"), value.alias("value"))
    if max_keys is None:
        return found
    return found.orderBy(*order).limit(max_keys)


def _no_items() -> Column:
    return F.array().cast("array<string>")


def parse_sheet(lines: DataFrame, header_row_index: int = 0, max_rows: int | None = None,
                delimiter: str = ",") -> DataFrame:
    """Sheet exported as delimited text: ``lines`` has line_no (from 0) and text.

    The header comes from the given row, an empty header cell is called ``column_i``, all values are
    text, missing cells are empty, blank lines are skipped. A cell in double quotes may hold the delimiter
    and doubled quotes, but no line break. Only the header line visits the driver.
    """
    header = lines.filter(F.col("line_no") == header_row_index).select("text").first()
    if header is None or header[0] is None:
        return lines.select("line_no").limit(0)
    titles = [title.strip() or f"column_{i}" for i, title in enumerate(next(csv.reader([header[0]], delimiter=delimiter), []))]
    cells = F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(titles))), {"sep": delimiter, "escape": '"'})
    body = lines.filter((F.col("line_no") > header_row_index) & (F.trim("text") != ""))
    if max_rows is not None:
        body = body.orderBy("line_no").limit(max_rows)
    return body.select("line_no", *[
        F.coalesce(cells[f"c{i}"], F.lit("")).alias(title) for i, title in enumerate(titles)])


def read_sheet(spark: SparkSession, path: str, header_row_index: int = 0, max_rows: int | None = None,
               delimiter: str = ",") -> DataFrame:
    """One exported sheet file; the line number is the order of the lines in the file.

    A sheet is a single small document, so it is read as a whole file and split into lines.
    """
    lines = (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "text"))
    )
    return parse_sheet(lines, header_row_index, max_rows, delimiter)


def describe_tables(spark: SparkSession, database: str | None = None, sample_rows: int = 2) -> DataFrame:
    """Columns and sample rows of every table; a table that cannot be read keeps its error.

    This is catalog metadata: one row per column, and at most ``sample_rows`` rows per table.
    """
    rows = []
    for table in spark.catalog.listTables(database):
        name = table.name if table.isTemporary or not database else f"{database}.{table.name}"
        error, samples = None, []
        try:
            samples = [r[0] for r in spark.table(name).limit(sample_rows).select(F.to_json(F.struct("*"))).collect()]
        except Exception as problem:  # noqa: BLE001 - the error is part of the description
            error = str(problem).splitlines()[0]
        try:
            columns = spark.catalog.listColumns(name)
        except Exception as problem:  # noqa: BLE001
            columns, error = [], error or str(problem).splitlines()[0]
        for position, c in enumerate(columns):
            rows.append((table.name, position, c.name, c.dataType, c.nullable, c.description, samples, error))
        if not columns and error:
            rows.append((table.name, None, None, None, None, None, samples, error))
    schema = ("table_name string, position int, column_name string, data_type string, nullable boolean, "
              "remarks string, sample_rows array<string>, sample_error string")
    return spark.createDataFrame(rows, schema)
