"""Lookup joins to reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def with_lookup(df: DataFrame, lookup: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join to a reference table that holds each key once.

    No broadcast hint: the planner compares the table's size with its
    broadcast limit, at planning and again at run time, and a table that has
    outgrown it is joined by shuffle with skewed keys split.
    """
    return df.join(lookup, key if isinstance(key, str) else list(key), "left")
