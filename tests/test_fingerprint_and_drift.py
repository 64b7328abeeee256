import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderflow.operators.drift import (
    bin_counts,
    bin_edges,
    drift_checks,
    edges_map,
    feature_skew,
    ks,
    psi,
    rate_shift,
)
from orderflow.operators.fingerprint import changed_partitions, dataset_fingerprint


def print_of(df, params=None):
    return dataset_fingerprint(df, "k", params or {"a": 1}).first()["fingerprint"]


def test_fingerprint_depends_on_keys_and_params_only(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    base = print_of(df)
    assert base == print_of(df.repartition(9).orderBy(F.desc("k")))
    assert base == print_of(df, {"a": 1})
    assert base != print_of(df, {"a": 2})
    assert base != print_of(df.where("k > 0"))
    assert base != print_of(df.union(spark.range(1).withColumnRenamed("id", "k")))
    assert print_of(df, {"a": 1, "b": 2}) == print_of(df, {"b": 2, "a": 1})


def test_fingerprint_of_nothing(spark):
    row = dataset_fingerprint(spark.range(0).withColumnRenamed("id", "k"), "k", {}).first()
    assert row["n_rows"] == 0 and row["fingerprint"]


def test_one_key_with_most_rows_is_counted_not_listed(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"))
    row = dataset_fingerprint(df, "k", {}).first()
    assert row["n_rows"] == 50_000 and row["n_keys"] == df.distinct().count()


def test_changed_partitions(spark):
    old = spark.createDataFrame([("d1", 1), ("d2", 2), ("d3", 3)], "day string, k int")
    new = spark.createDataFrame([("d1", 1), ("d2", 2), ("d2", 5), ("d4", 3)], "day string, k int")
    prints = [dataset_fingerprint(df, "k", {}, ["day"]) for df in (new, old)]
    got = {r["day"]: r["change"] for r in changed_partitions(*prints, "day").collect()}
    assert got == {"d2": "changed", "d3": "removed", "d4": "added"}


def test_content_counts_when_columns_are_named(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "")], "k int, v string")
    prints = {dataset_fingerprint(df, ["k", "v"], {}).first()["fingerprint"] for df in (a, b)}
    assert len(prints) == 2


def test_bins_are_half_open_and_null_has_its_own(spark):
    base = spark.createDataFrame([(0.9,), (1.0,), (2.0,), (None,)], "x double")
    got = {r["bin"]: r["n_base"] for r in bin_counts(base, base.limit(0), {"x": [1.0, 2.0]}).collect()}
    assert got == {0: 1, 1: 1, 2: 1, -1: 1}


def test_psi_of_known_shares(spark):
    def sample(low, high):
        return spark.createDataFrame([(0.0,)] * low + [(1.0,)] * high, "x double")

    row = psi(sample(50, 50), sample(80, 20), {"x": [0.5]}).first()
    expected = 0.3 * math.log(0.8 / 0.5) + (-0.3) * math.log(0.2 / 0.5)
    assert row["psi"] == pytest.approx(expected)
    assert psi(sample(50, 50), sample(5, 5), {"x": [0.5]}).first()["psi"] == pytest.approx(0.0)


def test_empty_bin_is_floored(spark):
    base = spark.createDataFrame([(0.0,)] * 10, "x double")
    cur = spark.createDataFrame([(1.0,)] * 10, "x double")
    expected = 2 * (1 - 1e-4) * math.log(1 / 1e-4)
    assert psi(base, cur, {"x": [0.5]}).first()["psi"] == pytest.approx(expected)


def test_ks_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    base, cur = rng.normal(0, 1, 800).round(1), rng.normal(0.4, 1, 500).round(1)
    frames = [spark.createDataFrame(pd.DataFrame({"x": v, "y": v * 0})) for v in (base, cur)]
    got = {r["feature"]: r["ks"] for r in ks(*frames, ["x", "y"]).collect()}
    grid = np.unique(np.concatenate([base, cur]))
    expected = max(abs((base <= g).mean() - (cur <= g).mean()) for g in grid)
    assert got["x"] == pytest.approx(expected, abs=1e-12) and got["y"] == 0.0


def test_bin_edges_near_exact_quantiles(spark):
    df = spark.range(2000).select(
        F.col("id").cast("double").alias("x"), F.lit(5.0).alias("same"),
        F.lit(None).cast("double").alias("nothing"),
    )
    edges = edges_map(bin_edges(df, ["x", "same", "nothing"]))
    assert edges["x"] == pytest.approx([200 * i for i in range(1, 10)], abs=2)
    assert edges["same"] == [5.0] and edges["nothing"] == []
    assert psi(df, df, edges).where("feature = 'x'").first()["psi"] == pytest.approx(0.0)


def test_feature_skew_is_null_safe(spark):
    mart = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "a")], "k int, x double, s string")
    served = spark.createDataFrame([(1, 1.0, None), (2, None, "b")], "k int, x double, s string")
    got = {r["feature"]: (r["n_mismatch"], r["mismatch_rate"]) for r in
           feature_skew(served, mart, "k", ["x", "s"]).collect()}
    assert got == {"x": (1, 0.5), "s": (1, 0.5)}


def test_drift_checks_levels(spark):
    statistics = spark.createDataFrame(
        [("psi", "a", 0.05), ("psi", "b", 0.2), ("psi", "c", 0.3), ("psi", "d", None), ("ks", "e", 0.0)],
        "check string, subject string, observed double",
    )
    limits = spark.createDataFrame([("psi", 0.1, 0.25)], "check string, warn double, error double")
    got = {r["subject"]: (r["severity"], r["threshold"]) for r in
           drift_checks(statistics, limits).collect()}
    assert got == {"a": ("OK", 0.1), "b": ("WARN", 0.1), "c": ("ERROR", 0.25),
                   "d": ("ERROR", 0.25), "e": ("ERROR", None)}


def test_rate_shift(spark):
    base = spark.createDataFrame([(1,), (0,), (None,)], "y int")
    cur = spark.createDataFrame([(1,), (1,), (0,), (1,)], "y int")
    assert rate_shift(base, cur, "y").first()["shift"] == pytest.approx(0.25)
