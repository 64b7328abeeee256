"""Running sums over an ordered value without a window over all rows.

Rank statistics (ROC, average precision, KS) and point-in-time history need,
for every value, the sums over all smaller values of its group. Groups may be
huge, so a window per group would end in one task. Here a group is cut into
ordered buckets: the window that sees the data is partitioned by (group,
bucket), and only bucket totals are accumulated per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_INF = float("inf")
_BUCKETS_PER_PARTITION = 8
_MIN_BUCKETS, _MAX_BUCKETS = 64, 4096


def default_buckets(df: DataFrame) -> int:
    """Several buckets per shuffle partition, so that they spread evenly; within fixed bounds."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(_BUCKETS_PER_PARTITION * width, _MIN_BUCKETS), _MAX_BUCKETS)


def equi_depth_edges(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Inner edges that cut `value` into ranges of about equal row count.

    One pass over one column; the driver gets at most `buckets` numbers. A
    value holding many rows takes several quantiles and is kept once, so the
    rows strictly between two edges stay below rows / buckets.
    """
    n = buckets or default_buckets(df)
    probabilities = [i / n for i in range(1, n)]
    edges = df.select(F.col(value).cast("double").alias(value)).approxQuantile(
        value, probabilities, 1.0 / (4 * n)
    )
    return sorted(set(edges))


def bucket_by_edges(df: DataFrame, value: str, edges: Sequence[float], output: str) -> DataFrame:
    """Add the index of the half-open range [edge_i, edge_i+1) that holds `value`."""
    inner = list(edges) or [0.0]
    binner = Bucketizer(
        splits=[-_INF, *inner, _INF], inputCol=value, outputCol=output, handleInvalid="keep"
    )
    return binner.transform(df).withColumn(output, F.col(output).cast("int"))


def cumulative_counts(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    bucket: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One row per (by, value): `s` at the value and `s_before` over smaller values.

    `bucket` is an expression that never decreases with `value`; without it
    `value` must be a double and is cut at equi-depth edges. Rows with a NULL
    value take no part. Bucket totals enter the inner window as a leading row
    with NULL value, so no join is needed and NULL group keys are safe.
    """
    keys = list(by)
    rows = df.where(F.col(value).isNotNull())
    if bucket is None:
        edges = equi_depth_edges(rows, value, buckets)
        rows = bucket_by_edges(rows, value, edges, "_bucket")
    else:
        rows = rows.withColumn("_bucket", bucket)

    points = rows.groupBy(*keys, "_bucket", value).agg(*[F.sum(s).alias(s) for s in sums])

    totals = points.groupBy(*keys, "_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    across = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    value_type = points.schema[value].dataType
    offsets = totals.select(
        *keys,
        "_bucket",
        F.lit(None).cast(value_type).alias(value),
        *[F.coalesce(F.sum(s).over(across), F.lit(0)).alias(s) for s in sums],
    )

    within = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(F.col(value).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        points.unionByName(offsets)
        .select(
            *keys,
            value,
            *sums,
            *[F.sum(s).over(within).alias(f"{s}_before") for s in sums],
        )
        .where(F.col(value).isNotNull())
    )
