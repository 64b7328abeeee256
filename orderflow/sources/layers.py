"""Layer tables: replace-write, partition replace, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.workspace import drop_folder, shuffles_freed

# The layers of the pipeline, from source copies to features.
LAYERS = ("raw", "staging", "intermediate", "marts", "seeds")


def layer_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return f"{root}/{layer}/{table}"


def write_layer(
    df: DataFrame, root: str, layer: str, table: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace a whole layer table and return it as read back.

    Rows are clustered by the partition columns first, with AQE free to split
    a large partition over several tasks, so no task opens every directory.
    """
    path = layer_path(root, layer, table)
    out = df.hint("rebalance", *partition_by) if partition_by else df
    with shuffles_freed(df.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *partition_by
        ).parquet(path, compression="zstd")
    return read_layer(df.sparkSession, root, layer, table, df)


def read_layer(
    spark: SparkSession, root: str, layer: str, table: str, like: DataFrame | None = None
) -> DataFrame:
    """A layer table; with `like` its declared schema is used, nothing is inferred."""
    path = layer_path(root, layer, table)
    reader = spark.read if like is None else spark.read.schema(like.schema)
    return reader.parquet(path)


def _data_files(spark: SparkSession, path: str) -> frozenset[str]:
    """Names of the files directly below `path`; empty when it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return frozenset()
    return frozenset(status.getPath().getName() for status in fs.listStatus(target))


def replace_partitions(
    df: DataFrame, path: str, days: Sequence[date], day_col: str = "day"
) -> list[date]:
    """Make the requested days of the table at `path` hold exactly the rows of `df`.

    Dynamic overwrite replaces the days that have rows. A requested day
    without rows would keep its old files, so the days whose files did not
    change are removed afterwards; the check reads file listings of the
    requested days only and the input is computed once. Other days are never
    touched, rows of other days are not written. Returns the emptied days.
    """
    spark = df.sparkSession
    folders = {day: f"{path}/{day_col}={day.isoformat()}" for day in sorted(set(days))}
    before = {day: _data_files(spark, folder) for day, folder in folders.items()}
    with shuffles_freed(spark):
        (
            df.where(F.col(day_col).isin(list(folders)))
            .hint("rebalance", day_col)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(day_col)
            .parquet(path)
        )
    emptied = [
        day for day, folder in folders.items()
        if before[day] and _data_files(spark, folder) == before[day]
    ]
    for day in emptied:
        drop_folder(spark, folders[day])
    return emptied


def latest_by(df: DataFrame, keys: Sequence[str], order_col: str,
              tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The newest row per key, ties decided by further columns.

    Row copies that agree in all of these are one row. The largest struct is
    found with partial aggregation, so a key with many copies is no hot spot.
    """
    rest = [c for c in df.columns if c not in (*keys, order_col, *tie_breakers)]
    newest = F.max(F.struct(order_col, *tie_breakers, *rest)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
