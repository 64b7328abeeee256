"""Deterministic hashing of keys into the unit interval."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13
_SCALE = float(16**_HEX_DIGITS)


def text_key(*columns: str) -> Column:
    """One string per row from key columns, NULL kept apart from empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def unit_hash(key: Column | str, purpose: str, seed: int) -> Column:
    """Double in [0, 1) from md5 of `key|purpose|seed`.

    52 bits fit a double exactly, so every engine gets the same value.
    """
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("|", column.cast("string"), F.lit(purpose), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(_SCALE)
