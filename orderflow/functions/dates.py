"""Date parts of a timestamp or date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(c: Column | str) -> Column:
    """First day of the month."""
    return F.trunc(_col(c), "MM")


def month_index(c: Column | str) -> Column:
    """Months since year 0; consecutive months differ by one."""
    return F.year(_col(c)) * 12 + F.month(_col(c))


def date_parts(c: Column | str, prefix: str) -> list[Column]:
    """Month, quarter, day of week (Monday = 0) and day of month."""
    return [
        F.month(_col(c)).alias(f"{prefix}_month"),
        F.quarter(_col(c)).alias(f"{prefix}_quarter"),
        F.weekday(_col(c)).alias(f"{prefix}_dow"),
        F.dayofmonth(_col(c)).alias(f"{prefix}_day"),
    ]
