"""Closing a stream: markers that drive the watermarks of its inputs past the last row.

A watermark only moves with the rows that arrive, so the last windows and the last unmatched rows
of a finished stream stay in its state. An input that reads markers next to its rows can be
closed: one row per input with a late enough time moves the watermark, the batch behind it emits
everything that was held back, and the marker itself never shows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

#: Column that tells a marker from a row.
CLOSES = "_closes"


@dataclass(frozen=True)
class Markers:
    """Folder of the markers of one input, its columns, the one that holds the event time, and values of others."""

    folder: str
    schema: T.StructType
    ts_col: str
    values: Mapping[str, object] = field(default_factory=dict)

    def _write(self, spark: SparkSession, rows: list[tuple]) -> None:
        spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def open(self, spark: SparkSession) -> Markers:
        """Make the folder readable; no marker is in it."""
        self._write(spark, [])
        return self

    def close(self, spark: SparkSession, at: datetime) -> None:
        """Add a marker of time `at`; rows before `at` less the delay of the watermark come late from then on."""
        known = {**self.values, self.ts_col: at}
        self._write(spark, [tuple(known.get(f.name) for f in self.schema)])


def closable(stream: DataFrame, folder: str, ts_col: str, values: Mapping[str, object] | None = None
             ) -> tuple[DataFrame, Markers]:
    """The stream with markers from `folder` and a column `CLOSES`; a marker has a time and `values`, otherwise NULLs.

    The key of a join needs a value, any one: rows without a key are dropped before the watermark sees them.
    """
    spark = stream.sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema])
    markers = Markers(folder, schema, ts_col, values or {}).open(spark)
    marks = spark.readStream.schema(schema).parquet(folder).withColumn(CLOSES, F.lit(True))
    return stream.withColumn(CLOSES, F.lit(False)).unionByName(marks), markers


def run_and_close(start: Callable[[], StreamingQuery], inputs: Sequence[Markers], at: datetime, spark: SparkSession) -> None:
    """Run a query that ends when its input is read, close its inputs, and run it again from its checkpoint.

    Rows and markers never share a batch, so no row is late because of a marker. A run that was
    interrupted may be repeated: one more marker changes nothing.
    """
    start().awaitTermination()
    for markers in inputs:
        markers.close(spark, at)
    start().awaitTermination()


def is_row(stream: DataFrame):
    """Condition that holds for everything but markers."""
    return ~F.col(CLOSES) if CLOSES in stream.columns else F.lit(True)
