"""Visibility, training window, splits and the training dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.hashing import unit_hash


def visible_as_of(df: DataFrame, ts_col: str, today: date) -> DataFrame:
    """Rows that exist on `today`: time up to and including that day.

    The bound is a plain comparison with a constant, so it reaches the scan.
    """
    return df.where(F.col(ts_col) < F.date_add(F.lit(today), 1))


@dataclass(frozen=True)
class WindowBounds:
    """First day of the window and the day after its last one."""

    start: date
    end: date

    def tags(self) -> dict[str, str]:
        return {"window_start": self.start.isoformat(), "window_end": self.end.isoformat()}


def window_bounds(end: date, months: int) -> WindowBounds:
    """The `months` calendar months before `end` (exclusive, day kept within the month)."""
    index = end.year * 12 + end.month - 1 - months
    year, month = divmod(index, 12)
    following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (following - date(year, month + 1, 1)).days
    return WindowBounds(date(year, month + 1, min(end.day, last_day)), end)


def within(df: DataFrame, bounds: WindowBounds, ts_col: str, month_col: str | None = None) -> DataFrame:
    """Rows inside the bounds; with `month_col`, the months outside are never read where that partitions the table."""
    column = F.col(ts_col)
    rows = df.where((column >= F.lit(bounds.start)) & (column < F.lit(bounds.end)))
    if month_col:
        last = bounds.end - timedelta(days=1)
        month = F.col(month_col)
        rows = rows.where((month >= F.lit(bounds.start.replace(day=1))) & (month <= F.lit(last.replace(day=1))))
    return rows


def training_window(
    df: DataFrame, ts_col: str, end: date, months: int, month_col: str | None = None
) -> tuple[DataFrame, WindowBounds]:
    """Rows of the rolling window and its bounds, to be recorded with the model."""
    bounds = window_bounds(end, months)
    return within(df, bounds, ts_col, month_col), bounds


def is_holdout(key: Column | str, seed: int, frac: float) -> Column:
    """True for the rows whose key hashes into the first `frac` of the unit interval."""
    return unit_hash(key, "split", seed) < F.lit(frac)


def hash_split(df: DataFrame, key: str, seed: int, frac: float) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) by key hash: stable under reruns, new rows and repartitioning."""
    holdout = is_holdout(key, seed, frac)
    return df.where(~holdout), df.where(holdout)


def time_split(df: DataFrame, ts_col: str, cutoff: date) -> tuple[DataFrame, DataFrame]:
    """(train, holdout): the holdout starts on the cutoff day."""
    return df.where(F.col(ts_col) < F.lit(cutoff)), df.where(F.col(ts_col) >= F.lit(cutoff))


def training_dataset(
    mart: DataFrame,
    label: str,
    key: str,
    ts_col: str,
    window: WindowBounds | None = None,
    split: str = "hash",
    seed: int = 42,
    test_frac: float = 0.2,
    cutoff: date | None = None,
    month_col: str | None = None,
) -> DataFrame:
    """Labelled rows of the window with a column `split` = 'train' or 'holdout'."""
    rows = mart.where(F.col(label).isNotNull())
    if window:
        rows = within(rows, window, ts_col, month_col)
    if split == "hash":
        holdout = is_holdout(key, seed, test_frac)
    elif split == "time" and cutoff:
        holdout = F.col(ts_col) >= F.lit(cutoff)
    else:
        raise ValueError("split is 'hash', or 'time' with a cutoff day")
    return rows.withColumn("split", F.when(holdout, "holdout").otherwise("train"))


def parts(dataset: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) of a training dataset, without the helper column."""
    return tuple(
        dataset.where(F.col("split") == name).drop("split") for name in ("train", "holdout")
    )


def add_seeds(df: DataFrame, key: str, seeds: Sequence[int], frac: float) -> DataFrame:
    """Holdout rows of every seed in one pass, marked by column `seed`."""
    member = [F.when(is_holdout(key, s, frac), F.lit(s)) for s in seeds]
    return df.withColumn("seed", F.explode(F.array_compact(F.array(*member))))
