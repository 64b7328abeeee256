"""Raw strings to typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.casts import cast_failed, safe_cast


@dataclass(frozen=True)
class Field:
    """Target column, its type, the raw column (same name by default) and a time format."""

    name: str
    type: str
    raw: str | None = None
    fmt: str | None = None

    @property
    def source(self) -> str:
        return self.raw or self.name


def stage(df: DataFrame, spec: Sequence[Field]) -> DataFrame:
    """Typed projection of a raw table; a value that does not parse becomes NULL."""
    return df.select(
        *[safe_cast(F.col(f.source), f.type, f.fmt).alias(f.name) for f in spec]
    )


def cast_failures(df: DataFrame, spec: Sequence[Field]) -> DataFrame:
    """One row per column: present raw values that did not parse, in one pass."""
    failed = {
        f.name: cast_failed(F.col(f.source), safe_cast(F.col(f.source), f.type, f.fmt))
        for f in spec
    }
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(condition).alias(name) for name, condition in failed.items()],
    )
    return counts.unpivot(["_rows"], list(failed), "column_name", "n_failed").select(
        "column_name", F.col("_rows").alias("n_rows"), "n_failed"
    )
