"""Raw CSV files: every column a string, no inference."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_raw(spark: SparkSession, directory: str, table: str, columns: Sequence[str],
             line_breaks: bool = False) -> DataFrame:
    """One CSV table as strings.

    Handles a UTF-8 byte order mark and doubled quotes. Files are read in splits. With
    `line_breaks` quotes may hold line breaks, which makes one file one split, so
    such a table should arrive as many files: `table` may be a file `<table>.csv` or a
    folder of them.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", line_breaks)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .csv(f"{directory}/{table}.csv")
    )


def read_raw_tables(
    spark: SparkSession, directory: str, columns: Mapping[str, Sequence[str]],
    line_breaks: Collection[str] = (),
) -> dict[str, DataFrame]:
    """All declared raw tables of a folder, by name; `line_breaks` names those with line breaks in quotes."""
    return {
        table: read_raw(spark, directory, table, names, table in line_breaks)
        for table, names in columns.items()
    }
