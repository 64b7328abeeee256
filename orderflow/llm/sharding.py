"""Sharding through a lookup table that the shards fill by turns."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest table: it is broadcast whole, about 16 bytes a slot.
MOST_SLOTS = 1 << 18


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """Shard number of every slot.

    Shard s prefers slots (a + j * b) mod `slots` for j = 0, 1, ..., a and b from the md5
    of its name. The shards take turns; each claims its next preferred slot that is free.
    `slots` is prime, so that each shard prefers every slot once. A shard that joins
    or leaves moves few slots besides its own share.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not len(shards) <= slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    start = [_digest(f"{name}/start") % slots for name in shards]
    step = [_digest(f"{name}/step") % max(slots - 1, 1) + 1 for name in shards]
    table = [-1] * slots
    free = slots
    while free:
        for s in range(len(shards)):
            if not free:
                break
            while table[start[s]] >= 0:
                start[s] = (start[s] + step[s]) % slots
            table[start[s]] = s
            free -= 1
    return table


def slot_of(key: Column, slots: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"), F.lit(slots))


def shard(
    docs: DataFrame,
    shards: list[str],
    slots: int = 4099,
    id_col: str = "doc_id",
    text_col: str = "text",
    slot_name: str = "slot",
    shard_name: str = "shard",
) -> DataFrame:
    """`docs` and, in `slot_name` and `shard_name`, the slot of each row's key and the number of the shard that holds it.

    The key is the id as text; without an id the md5 of the text, without both the empty
    text. Equal keys share a shard. Columns of `docs` that have the two new names are
    replaced. The table has `slots` rows whatever the data and is broadcast.
    """
    table = ",".join(map(str, lookup_table(shards, slots)))
    lookup = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit(table), ",")).alias("_slot", "_shard"))
    lookup = lookup.select(F.col("_slot").cast("long").alias(slot_name), F.col("_shard").cast("long").alias(shard_name))
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.md5(F.col(f"`{text_col}`")), F.lit(""))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in (slot_name, shard_name)]
    return docs.select(*own, slot_of(key, slots).alias(slot_name)).join(F.broadcast(lookup), slot_name).select(
        *own, slot_name, shard_name
    )


def write_shards(sharded: DataFrame, path: str, shard_name: str = "shard") -> None:
    """One folder a shard. Rows stay in the tasks that hold them, so a large shard is many files."""
    sharded.write.partitionBy(shard_name).parquet(path)
