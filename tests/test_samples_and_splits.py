import hashlib
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderflow.operators import sampling
from orderflow.operators.sampling import Follow, cap_rows, orphans, sample_connected
from orderflow.operators.windows import (
    add_seeds,
    hash_split,
    is_holdout,
    parts,
    time_split,
    training_dataset,
    training_window,
    visible_as_of,
    window_bounds,
)


def unit(key, purpose, seed):
    return int(hashlib.md5(f"{key}|{purpose}|{seed}".encode()).hexdigest()[:13], 16) / 2**52


def test_hash_split_matches_definition(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, holdout = hash_split(df, "k", 7, 0.3)
    expected = {k for k in range(2000) if unit(k, "split", 7) < 0.3}
    assert {r["k"] for r in holdout.collect()} == expected
    assert train.count() == 2000 - len(expected)


def test_add_seeds_gives_each_holdout(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    got = {(r["k"], r["seed"]) for r in add_seeds(df, "k", (1, 2), 0.2).collect()}
    assert got == {(k, s) for k in range(500) for s in (1, 2) if unit(k, "split", s) < 0.2}


def tables(spark):
    return {
        "orders": spark.range(1000).select(
            F.col("id").alias("order_id"), (F.col("id") % 400).alias("customer_id")
        ),
        # order 5000 does not exist: an orphan item
        "items": spark.range(3000).select(
            F.when(F.col("id") < 2990, F.col("id") % 1000).otherwise(5000).alias("order_id"),
            (F.col("id") % 70).alias("seller_id"),
        ),
        "customers": spark.range(450).withColumnRenamed("id", "customer_id"),
        "sellers": spark.range(80).withColumnRenamed("id", "seller_id"),
    }


FOLLOWS = [
    Follow("items", "order_id", "orders", "order_id"),
    Follow("customers", "customer_id", "orders", "customer_id"),
    Follow("sellers", "seller_id", "items", "seller_id"),
]


def test_sample_is_closed_under_keys(spark):
    given = tables(spark)
    got = sample_connected(given, "orders", "order_id", FOLLOWS, 0.1, 3)
    orders = {r["order_id"] for r in got["orders"].collect()}
    assert orders == {k for k in range(1000) if unit(k, "sample", 3) < 0.1}
    items = got["items"].collect()
    assert len(items) == given["items"].where(F.col("order_id").isin(list(orders))).count()
    assert {r["seller_id"] for r in got["sellers"].collect()} == {r["seller_id"] for r in items}
    assert {r["customer_id"] for r in got["customers"].collect()} == {o % 400 for o in orders}


def test_whole_sample_drops_orphans_only(spark):
    got = sample_connected(tables(spark), "orders", "order_id", FOLLOWS, 1.1, 3)
    assert got["orders"].count() == 1000 and got["items"].count() == 2990


def test_caps_bound_a_lookup(spark):
    caps = {"sellers": (5, ["seller_id"])}
    loose = [replace(f, optional=f.table == "sellers") for f in FOLLOWS]
    got = sample_connected(tables(spark), "orders", "order_id", loose, 0.5, 3, caps)
    assert got["sellers"].count() == 5 and got["customers"].count() > 5
    lost = {r["relation"]: r["n_orphans"] for r in orphans(tables(spark), got, loose).collect()}
    assert sum(v > 0 for v in lost.values()) == 1
    for table in ("sellers", "items", "orders"):
        with pytest.raises(ValueError, match="cap"):
            sample_connected(tables(spark), "orders", "order_id", FOLLOWS, 0.5, 3, {table: (5, ["x"])})


def test_samples_lose_no_key(spark):
    got = sample_connected(tables(spark), "orders", "order_id", FOLLOWS, 0.5, 3)
    assert all(r["n_orphans"] == 0 for r in orphans(tables(spark), got, FOLLOWS).collect())


@pytest.mark.parametrize("slot_rows", [50_000, 60])
@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_cap_rows_is_exact_for_any_number_of_slots(spark, monkeypatch, n, slot_rows):
    monkeypatch.setattr(sampling, "SLOT_ROWS", slot_rows)
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = sorted(r["k"] for r in cap_rows(df, n, ["k"], 5).collect())
    assert got == sorted(sorted(range(1000), key=lambda k: (unit(k, "cap", 5), k))[:n])


def test_windows_and_visibility(spark):
    df = spark.range(800).select(
        F.date_add(F.lit(date(2022, 1, 1)), F.col("id").cast("int")).alias("d")
    )
    rows, bounds = training_window(df, "d", date(2023, 3, 1), 12)
    assert bounds.tags() == {"window_start": "2022-03-01", "window_end": "2023-03-01"}
    assert rows.count() == 365
    assert window_bounds(date(2024, 3, 31), 1).start == date(2024, 2, 29)
    assert window_bounds(date(2024, 1, 15), 13).start == date(2022, 12, 15)
    assert visible_as_of(df, "d", date(2022, 1, 10)).count() == 10
    train, holdout = time_split(df, "d", date(2023, 1, 1))
    assert (train.count(), holdout.count()) == (365, 435)


def test_training_dataset_has_labelled_rows_and_a_split(spark):
    df = spark.range(300).select(
        F.col("id").alias("k"),
        F.date_add(F.lit(date(2022, 1, 1)), F.col("id").cast("int")).alias("d"),
        F.when(F.col("id") % 3 != 0, (F.col("id") % 2).cast("int")).alias("y"),
    )
    dataset = training_dataset(df, "y", "k", "d", seed=1, test_frac=0.25)
    assert dataset.count() == 200
    train, holdout = parts(dataset)
    assert train.count() + holdout.count() == 200 and "split" not in train.columns
    assert holdout.where(~is_holdout("k", 1, 0.25)).count() == 0
    with pytest.raises(ValueError):
        training_dataset(df, "y", "k", "d", split="time")


def test_split_is_stable_under_repartitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"] for r in hash_split(df, "k", 1, 0.2)[1].collect()}
    b = {r["k"] for r in hash_split(df.repartition(7), "k", 1, 0.2)[1].collect()}
    assert a == b
