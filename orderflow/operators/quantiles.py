"""Exact quantiles of many columns at once, whatever the number of rows.

A quantile is the value at a rank. Sketches enclose every wanted rank in a narrow interval of
values; the next pass counts how many rows lie below and inside each interval, which both proves
that the rank is inside and gives its rank there, and draws new sketches inside. When the
intervals of a pass hold few rows, their values are counted and the ranks are read off. Every pass
aggregates before its shuffle; no task and no driver call sees more than sketches and such counts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.workspace import materialize

_INF = math.inf
_LARGEST = math.nextafter(_INF, 0.0)
#: Points of a sketch, the distance of a rank from the truth that it allows for, and its accuracy.
_POINTS = 256
_MARGIN = 2.0 / _POINTS
_ACCURACY = 1_000
#: Rows of an interval that are counted value by value.
FEW_ROWS = 50_000


@dataclass(frozen=True)
class Interval:
    """Values from `lo` to `hi`, both inside, which hold the quantiles `wanted` (ranks from 1 over all rows)."""

    lo: float
    hi: float
    wanted: tuple[int, ...]


def rank(i: int, n: int, rows: int) -> int:
    """Rank from 1 of the i-th of n quantiles: the first row with at least i/n of the rows up to it."""
    return max(1, -(-i * rows // n))


def _merged(intervals: Sequence[Interval]) -> list[Interval]:
    out: list[Interval] = []
    for one in sorted(intervals, key=lambda x: (x.lo, x.hi)):
        if out and one.lo <= math.nextafter(out[-1].hi, _INF):
            last = out.pop()
            one = Interval(last.lo, max(last.hi, one.hi), tuple(sorted({*last.wanted, *one.wanted})))
        out.append(one)
    return out


def _number(c: str) -> Column:
    """The column as a double; NULL for NaN, 0.0 for -0.0, infinities as the largest doubles."""
    value = F.col(c).cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.least(value + 0.0, F.lit(_LARGEST)), F.lit(-_LARGEST)))


def _placed(df: DataFrame, intervals: Mapping[str, Sequence[Interval]]) -> DataFrame:
    """(feature, bin, value) of every number; bin 2i + 1 is the i-th interval, even bins lie between them."""
    cols = list(intervals)
    splits = []
    for c in cols:
        inner = sorted({x for one in intervals[c] for x in (one.lo, math.nextafter(one.hi, _INF))} - {_INF})
        splits.append([-_INF, *(inner or [0.0]), _INF])
    rows = df.select(*[_number(c).alias(c) for c in cols])
    bins = [f"_bin_{i}" for i in range(len(cols))]
    binned = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=bins, handleInvalid="keep").transform(rows)
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(b).cast("int").alias("bin"), F.col(c).alias("value"))
        for c, b in zip(cols, bins, strict=True)
    ]
    long = binned.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")
    return long.where("value is not null")


def _start(df: DataFrame, cols: Sequence[str], n: int) -> tuple[dict[str, int], dict[str, list[Interval]]]:
    """Rows of each column and the whole range of its numbers, which holds every rank."""
    numbers = {c: _number(c) for c in cols}
    row = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(numbers.values())],
        *[F.min(v).alias(f"lo{i}") for i, v in enumerate(numbers.values())],
        *[F.max(v).alias(f"hi{i}") for i, v in enumerate(numbers.values())],
    ).first()
    rows = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    whole = {
        c: [Interval(row[f"lo{i}"], row[f"hi{i}"], tuple(sorted({rank(j, n, rows[c]) for j in range(1, n)})))]
        for i, c in enumerate(cols)
        if rows[c]
    }
    return rows, whole


def _narrowed(one: Interval, below: int, inside: int, points: Sequence[float]) -> list[Interval]:
    """Intervals inside `one` around each of its ranks, by the sketch of its rows."""
    found = []
    for wanted in one.wanted:
        share = (wanted - below) / inside
        lo = points[max(0, math.floor((share - _MARGIN) * _POINTS))]
        hi = points[min(_POINTS, math.ceil((share + _MARGIN) * _POINTS))]
        found.append(Interval(max(lo, one.lo), min(hi, one.hi), (wanted,)))
    return found


def exact_quantiles(df: DataFrame, cols: Sequence[str], n: int, few: int = FEW_ROWS) -> DataFrame:
    """(feature, position, edge): the i-th of `n` quantiles, i from 1 to n - 1, of every column.

    It is the smallest value that at least i/n of the column's rows do not exceed. Null and NaN are
    left out; infinities count as the largest doubles; a column without numbers has no rows. Equal
    quantiles repeat.
    """
    rows, sought = _start(df, cols, n)
    small: dict[str, list[Interval]] = {c: v for c, v in sought.items() if rows[c] <= few}
    sought = {c: v for c, v in sought.items() if c not in small}
    points = [i / _POINTS for i in range(_POINTS + 1)]
    inside = F.when(F.col("bin") % 2 == 1, F.col("value"))
    while sought:
        table = _placed(df, sought).groupBy("feature", "bin").agg(
            F.count("*").alias("n"), F.percentile_approx(inside, points, _ACCURACY).alias("points")
        )
        bins = {(r["feature"], r["bin"]): r for r in table.collect()}  # one row a bin
        following: dict[str, list[Interval]] = {}
        for c, intervals in sought.items():
            below = 0
            for i, one in enumerate(intervals):
                below += bins[c, 2 * i]["n"] if (c, 2 * i) in bins else 0
                held = bins[c, 2 * i + 1]
                if not all(below < w <= below + held["n"] for w in one.wanted):
                    raise RuntimeError(f"a sketch of {c!r} was further off than its margin")
                closer = _merged(_narrowed(one, below, held["n"], held["points"]))
                below += held["n"]
                if held["n"] <= few or closer == [one]:
                    small.setdefault(c, []).append(one)
                else:
                    following.setdefault(c, []).extend(closer)
        sought = {c: _merged(v) for c, v in following.items()}
    return _read_off(df, small, rows, n)


def _read_off(df: DataFrame, small: Mapping[str, Sequence[Interval]], rows: Mapping[str, int], n: int) -> DataFrame:
    """The values at the wanted ranks, from counts of the values inside the intervals."""
    spark = df.sparkSession
    intervals = {c: _merged(found) for c, found in small.items()}
    if not intervals:
        return spark.createDataFrame([], "feature string, position int, edge double")
    values = materialize(
        _placed(df, intervals).groupBy("feature", "bin", F.when(F.col("bin") % 2 == 1, F.col("value")).alias("value")).agg(F.count("*").alias("n")),
        "quantile-counts",
    )
    totals = values.groupBy("feature", "bin").agg(F.sum("n").alias("total"))
    before = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # bins of a column
    below = totals.select(F.col("feature").alias("_f"), F.col("bin").alias("_b"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("below"))
    up_to = Window.partitionBy("feature", "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        values.where("value is not null")
        .withColumn("upto", F.sum("n").over(up_to))
        .join(F.broadcast(below), (F.col("feature") == F.col("_f")) & (F.col("bin") == F.col("_b")))  # one row a bin
        .select("feature", "value", (F.col("below") + F.col("upto") - F.col("n")).alias("after"), (F.col("below") + F.col("upto")).alias("upto"))
    )
    wanted = [(c, i, rank(i, n, rows[c])) for c in intervals for i in range(1, n)]
    places = spark.createDataFrame(wanted, "name string, position int, rank long")
    hit = (F.col("feature") == F.col("name")) & (F.col("rank") > F.col("after")) & (F.col("rank") <= F.col("upto"))
    return ranked.join(F.broadcast(places), hit).select("feature", "position", F.col("value").alias("edge"))  # n rows a column
