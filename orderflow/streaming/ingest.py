"""Incremental ingest: landing files and the inference log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_landing(spark: SparkSession, directory: str, schema: T.StructType,
                 fmt: str = "parquet", options: Mapping[str, object] | None = None) -> DataFrame:
    """Stream of the files of a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    return reader.options(**dict(options or {})).load(directory)


def parse_entries(stream: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Columns of log entries that a message bus delivers as JSON text or bytes."""
    entry = F.from_json(F.col(column).cast("string"), schema)
    return stream.select(entry.alias("_entry")).select("_entry.*")


def append_stream(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once, and stop when all input is read."""
    return (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_landing(spark: SparkSession, directory: str, schema: T.StructType, checkpoint: str,
                   out: str, fmt: str = "parquet", options: Mapping[str, object] | None = None
                   ) -> DataFrame:
    """Load the files that no earlier run has seen and return the whole table."""
    stream = read_landing(spark, directory, schema, fmt, options)
    append_stream(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(schema).parquet(out)


def with_event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Zone-less timestamps as instants, which watermarks ask for."""
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def deduplicated(stream: DataFrame, key: str, ts_col: str, delay: str) -> DataFrame:
    """First row per key; repeats up to `delay` later are dropped, state stays bounded."""
    return (
        with_event_time(stream, ts_col)
        .withWatermark(ts_col, delay)
        .dropDuplicatesWithinWatermark([key])
    )


def ingest_log(stream: DataFrame, key: str, ts_col: str, delay: str, checkpoint: str, out: str
               ) -> DataFrame:
    """Append the inference log without repeated entries and return the whole table.

    `stream` may come from files or from a message bus; only its source
    options differ.
    """
    rows = deduplicated(stream, key, ts_col, delay)
    append_stream(rows, out, checkpoint).awaitTermination()
    return stream.sparkSession.read.schema(rows.schema).parquet(out)
