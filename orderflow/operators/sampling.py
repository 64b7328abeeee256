"""Key-connected sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.hashing import text_key, unit_hash

#: Rows of a hash slot, about; the slot that crosses a cap is ranked by one task.
SLOT_ROWS = 50_000


@dataclass(frozen=True)
class Follow:
    """`table` keeps the rows whose `key` occurs as `parent_key` in the sampled `parent`.

    `optional`: the parent copes with rows that are missing in `table`, a mere lookup.
    """

    table: str
    key: str
    parent: str
    parent_key: str
    optional: bool = False


def semi_on(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of `df` whose key occurs in `parent`; parent keys are made distinct before the join."""
    keys = parent.select(F.col(parent_key).alias("_key")).where("_key is not null").distinct()
    return df.join(keys, df[key] == F.col("_key"), "left_semi")


def sample_connected(
    tables: Mapping[str, DataFrame],
    root: str,
    root_key: str,
    follows: Sequence[Follow],
    sample_frac: float,
    seed: int,
    caps: Mapping[str, tuple[int, Sequence[str]]] | None = None,
) -> dict[str, DataFrame]:
    """One hash sample of the root table, every other table pulled in by key.

    `follows` lists the relations in dependency order; a table reached over
    several of them keeps a row when any one matches. Tables that carry the
    root key are hash-filtered at their scan before the semi join, so only
    about `sample_frac` of them is shuffled. `caps` bounds lookup tables:
    (rows, key columns) by table name, applied after the keys were followed. A cap
    on a table that others refer to or lead on from would break the sample's keys and
    is refused; only tables whose every relation is `optional` take one.
    """
    limits = caps or {}
    for table in limits:
        mine = [f for f in follows if f.table == table]
        if table == root or not all(f.optional for f in mine) or any(f.parent == table for f in follows):
            raise ValueError(f"a cap on {table!r} would leave rows without their key")

    def kept(df: DataFrame, key: str) -> DataFrame:
        return df.where(unit_hash(key, "sample", seed) < sample_frac)

    def capped(table: str, df: DataFrame) -> DataFrame:
        if table not in limits:
            return df
        n, key_cols = limits[table]
        return cap_rows(df, n, key_cols, seed)

    sampled = {root: kept(tables[root], root_key)}
    for table in dict.fromkeys(f.table for f in follows):
        relations = [f for f in follows if f.table == table]
        source = tables[table]
        if len(relations) == 1:
            relation = relations[0]
            if relation.parent == root and relation.parent_key == root_key:
                source = kept(source, relation.key)
            kept_rows = semi_on(
                source, relation.key, sampled[relation.parent], relation.parent_key
            )
            sampled[table] = capped(table, kept_rows)
            continue
        if len({f.key for f in relations}) > 1:
            raise ValueError(f"relations of {table!r} must use one key column")
        keys = None
        for relation in relations:
            part = sampled[relation.parent].select(F.col(relation.parent_key).alias("_key"))
            keys = part if keys is None else keys.union(part)
        sampled[table] = capped(table, semi_on(source, relations[0].key, keys, "_key"))
    return sampled


def orphans(
    tables: Mapping[str, DataFrame], sampled: Mapping[str, DataFrame], follows: Sequence[Follow]
) -> DataFrame:
    """(relation, n_orphans): rows of each sampled parent whose row in `table` exists but was not kept."""
    found = None
    for f in follows:
        parent = sampled[f.parent].where(F.col(f.parent_key).isNotNull())
        keys = [df.select(F.col(f.key).alias("_key")).distinct() for df in (tables[f.table], sampled[f.table])]
        wanted = parent.join(keys[0], parent[f.parent_key] == F.col("_key"), "left_semi")
        missing = wanted.join(keys[1], wanted[f.parent_key] == F.col("_key"), "left_anti")
        row = missing.agg(F.count("*").alias("n_orphans")).select(
            F.lit(f"{f.parent}.{f.parent_key}->{f.table}").alias("relation"), "n_orphans"
        )
        found = row if found is None else found.unionByName(row)
    return found


def cap_rows(df: DataFrame, n: int, key_cols: Sequence[str], seed: int) -> DataFrame:
    """Exactly min(n, rows) rows, the first ones in the order of (hash, key).

    The rows are cut into hash slots, as many as their number asks for: whole slots
    below the cap are kept as they are and only the slot that crosses it is ranked.
    """
    hashed = df.withColumn("_u", unit_hash(text_key(*key_cols), "cap", seed))
    slots = max(1, -(-df.count() // SLOT_ROWS))
    hashed = hashed.withColumn("_slot", F.floor(F.col("_u") * slots))
    upto = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    sizes = hashed.groupBy("_slot").count().withColumn("upto", F.sum("count").over(upto))
    crossing = sizes.where(F.col("upto") > n).orderBy("_slot").limit(1).collect()  # one row
    if not crossing:
        return df
    slot, room = crossing[0]["_slot"], n - (crossing[0]["upto"] - crossing[0]["count"])
    order = [F.col("_u"), *[F.col(c) for c in key_cols]]
    rank = F.row_number().over(Window.partitionBy("_slot").orderBy(*order))
    partial = hashed.where(F.col("_slot") == slot).withColumn("_rank", rank).where(F.col("_rank") <= room)
    return hashed.where(F.col("_slot") < slot).unionByName(partial.drop("_rank")).drop("_u", "_slot")
