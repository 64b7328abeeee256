import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from orderflow.operators.cumulative import cumulative_counts, equi_depth_edges
from orderflow.operators.metrics import evaluate, positive_rate, roc_curve


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    if not pos or not neg:
        return None
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(scores, labels):
    pos = sum(labels)
    if pos in (0, len(labels)):
        return None
    ap, recall = 0.0, 0.0
    for s in sorted(set(scores), reverse=True):
        chosen = [y for v, y in zip(scores, labels) if v >= s]
        ap += (sum(chosen) / pos - recall) * sum(chosen) / len(chosen)
        recall = sum(chosen) / pos
    return ap


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)),
            st.integers(0, 1),
        ),
        min_size=1, max_size=40,
    )
)
def test_evaluate_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, score double, label int")
    got = {r["g"]: r for r in evaluate(df, "score", "label", ["g"]).collect()}
    assert set(got) == {g for g, _, _ in rows}
    for group in got:
        scores = [s for g, s, _ in rows if g == group]
        labels = [y for g, _, y in rows if g == group]
        for name, expected in (
            ("roc_auc", brute_auc(scores, labels)),
            ("pr_auc", brute_ap(scores, labels)),
        ):
            if expected is None:
                assert got[group][name] is None
            else:
                assert got[group][name] == pytest.approx(expected, abs=1e-12)
        assert got[group]["n_rows"] == len(scores)


def test_empty_input_has_no_metric(spark):
    row = evaluate(spark.createDataFrame([], "score double, label int"), "score", "label").first()
    assert (row["n_rows"], row["n_positive"], row["roc_auc"], row["pr_auc"]) == (0, 0, None, None)


def test_null_scores_and_labels_take_no_part(spark):
    df = spark.createDataFrame(
        [(1.0, 1), (0.0, 0), (None, 1), (2.0, None)], "score double, label int"
    )
    row = evaluate(df, "score", "label").first()
    assert (row["n_rows"], row["roc_auc"]) == (2, 1.0)


def test_agrees_with_spark_evaluator(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"score": rng.random(5000).round(3), "label": rng.integers(0, 2, 5000)})
    df = spark.createDataFrame(pdf)
    reference = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", numBins=0
    ).evaluate(df)
    assert evaluate(df, "score", "label").first()["roc_auc"] == pytest.approx(reference, abs=1e-12)


def test_hot_group_and_hot_value(spark):
    """A third of the rows in one group, a third of its rows at one score."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50))
        .alias("g"),
        F.when(F.col("id") % 9 == 0, F.lit(0.5)).otherwise(F.rand(7)).alias("score"),
        (F.rand(8) < 0.2).cast("int").alias("label"),
    )
    pdf = df.toPandas()
    got = {r["g"]: r["roc_auc"] for r in evaluate(df, "score", "label", ["g"]).collect()}
    for group, part in pdf.groupby("g"):
        ranks = part["score"].rank()
        pos = part["label"].sum()
        expected = (ranks[part["label"] == 1].sum() - pos * (pos + 1) / 2) / (
            pos * (len(part) - pos)
        )
        assert got[group] == pytest.approx(expected, abs=1e-9)


def test_edges_are_bounded_and_sorted(spark):
    df = spark.range(10_000).select((F.col("id") % 100).cast("double").alias("v"))
    edges = equi_depth_edges(df, "v", 16)
    assert edges == sorted(set(edges)) and len(edges) <= 15


def test_cumulative_counts_with_date_buckets(spark):
    rows = [("s", "2024-01-01", 1), ("s", "2024-01-01", 1), ("s", "2024-02-05", 1), ("t", "2024-02-01", 1)]
    df = spark.createDataFrame(rows, "k string, d string, n long").withColumn("d", F.to_date("d"))
    got = cumulative_counts(df, "d", ["n"], ["k"], bucket=F.trunc("d", "MM"))
    values = {(r["k"], str(r["d"])): (r["n"], r["n_before"]) for r in got.collect()}
    assert values == {
        ("s", "2024-01-01"): (2, 0), ("s", "2024-02-05"): (1, 2), ("t", "2024-02-01"): (1, 0)
    }


def test_no_unpartitioned_window_over_data(spark):
    df = spark.range(1000).select(
        F.rand(1).alias("score"), (F.rand(2) < 0.5).cast("int").alias("label")
    )
    plan = evaluate(df, "score", "label")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert len(windows) == 2
    for line in windows:
        if "_bucket" not in line.split("windowspecdefinition(")[1].split("ASC")[0]:
            raise AssertionError(line)


def test_roc_curve_ends_at_one_one(spark):
    df = spark.range(500).select(
        F.rand(5).alias("score"), (F.rand(6) < 0.3).cast("int").alias("label")
    )
    points = sorted((r["fpr"], r["tpr"]) for r in roc_curve(df, "score", "label", 25).collect())
    assert len(points) <= 25 and points[-1] == (1.0, 1.0)
    assert all(a[1] <= b[1] for a, b in zip(points, points[1:]))


def test_positive_rate_leaves_out_unlabelled(spark):
    df = spark.createDataFrame(
        [("2024-01-05", 1), ("2024-01-06", 0), ("2024-01-07", None)], "d string, y int"
    ).withColumn("d", F.to_date("d"))
    row = positive_rate(df, "y", "d").first()
    assert (row["n_rows"], row["n_positive"]) == (2, 1) and math.isclose(row["positive_rate"], 0.5)
