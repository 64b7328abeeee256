"""Casts from raw strings that give NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(raw: Column, type_name: str, fmt: str | None = None) -> Column:
    """Typed value of a raw string; blank or unparsable text gives NULL."""
    text = F.trim(raw)
    if type_name == "string":
        return raw
    if type_name in ("timestamp", "date") and fmt:
        parsed = F.try_to_timestamp(text, F.lit(fmt))
        return parsed if type_name == "timestamp" else parsed.cast("date")
    return text.try_cast(type_name)


def cast_failed(raw: Column, typed: Column) -> Column:
    """True where text was present and no typed value came out."""
    return raw.isNotNull() & (F.trim(raw) != "") & typed.isNull()
