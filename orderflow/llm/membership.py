"""A bitmap of fixed size that says which 64-bit keys may be in a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 MB, however many keys there are: with more keys it lets more through, and a join decides.
BITS = 24


def bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """One bit for each key's lowest `bits` bits; at most 2^(bits-6) rows reach the driver."""
    found = _words(keys, column, bits).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return words.view(np.uint64)


def _words(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """The bitmap's words that aren't 0: `word`, `mask`."""
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    return (
        keys.where(F.col(column).isNotNull())
        .select(
            F.shiftright(place, 6).alias("word"),
            F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("mask"),
        )
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
    )


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the table; never false for a key that is."""
    bits = int(len(words)).bit_length() - 1 + 6
    place = keys.view(np.uint64) & np.uint64((1 << bits) - 1)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def without(rows: DataFrame, lost: DataFrame, match: Column, key: Column, lost_key: Column, bits: int = BITS) -> DataFrame:
    """The rows that no row of `lost` matches; rows that match have equal 64-bit keys, and those are never null.

    Rows whose key the bitmap rules out stay where they are. Only the others are
    shuffled to meet `lost` in a join, which decides.
    """
    words = _words(lost.select(lost_key.alias("key")), "key", bits)
    at = F.shiftright(key.bitwiseAND(F.lit((1 << bits) - 1)), 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    held = words["mask"].bitwiseAND(bit) != 0

    def told(how: str) -> DataFrame:  # at most 2^(bits-6) words
        return rows.join(F.broadcast(words), (at == words["word"]) & held, how)

    return told("left_anti").union(told("left_semi").join(lost, match, "left_anti"))
