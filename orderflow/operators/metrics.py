"""Classification metrics by exact ranks, globally or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.dates import month_of
from orderflow.operators.cumulative import cumulative_counts


def positive_rate(df: DataFrame, label: str, ts_col: str, period: str = "month",
                  by: Sequence[str] = ()) -> DataFrame:
    """Rows, positives and their share per day or month; unlabelled rows are left out."""
    bucket = month_of(ts_col) if period == "month" else F.to_date(ts_col)
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(*by, bucket.alias(period))
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(F.col(label).cast("long")).alias("n_positive"),
            F.avg(F.col(label).cast("double")).alias("positive_rate"),
        )
    )


def _ranked(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Counts per distinct score and above it, ties kept together."""
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *by,
        (-F.col(score).cast("double")).alias("_rank"),
        F.col(label).cast("long").alias("pos"),
        (1 - F.col(label).cast("long")).alias("neg"),
    )
    return cumulative_counts(rows, "_rank", ["pos", "neg"], by)


def _roc(pairs: Column, pos: Column, neg: Column) -> Column:
    return pairs / F.nullif(pos.cast("double") * neg.cast("double"), F.lit(0.0))


def evaluate(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Row counts, ROC AUC and average precision from one ranking.

    A group with one class only has no ranking to judge: both metrics are NULL.
    """
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    seen = pos + F.col("pos_before") + neg + F.col("neg_before")
    totals = _ranked(df, score, label, by).groupBy(*by).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_positive"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_negative"),
        F.sum(neg * (F.col("pos_before") + pos / 2)).alias("_pairs"),
        F.sum(pos * (pos + F.col("pos_before")) / seen).alias("_precision"),
    )
    both = (F.col("n_positive") > 0) & (F.col("n_negative") > 0)
    return totals.select(
        *by,
        (F.col("n_positive") + F.col("n_negative")).alias("n_rows"),
        "n_positive",
        _roc(F.col("_pairs"), F.col("n_positive"), F.col("n_negative")).alias("roc_auc"),
        F.when(both, F.col("_precision") / F.nullif(F.col("n_positive").cast("double"), F.lit(0.0)))
        .alias("pr_auc"),
    )


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Chance that a positive outranks a negative, ties counting half."""
    return evaluate(df, score, label, by).select(*by, "n_rows", "n_positive", "roc_auc")


def pr_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision: precision at each distinct score weighted by recall gained."""
    return evaluate(df, score, label, by).select(*by, "n_rows", "n_positive", "pr_auc")


def roc_curve(df: DataFrame, score: str, label: str, max_points: int = 200,
              by: Sequence[str] = ()) -> DataFrame:
    """Threshold, false and true positive rate, thinned to `max_points` per group.

    The rows are cut into `max_points` slots by how many of them score at
    least the threshold; each slot keeps its last point, so (1, 1) stays.
    """
    keys = list(by) or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(0))
    ranked = _ranked(source, score, label, keys).select(
        *keys,
        (-F.col("_rank")).alias("threshold"),
        (F.col("pos") + F.col("pos_before")).alias("tp"),
        (F.col("neg") + F.col("neg_before")).alias("fp"),
    )
    totals = ranked.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max("tp").alias("p"), F.max("fp").alias("n")
    )
    if not by:
        totals = F.broadcast(totals)  # a single row
    same_group = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    seen = F.col("tp") + F.col("fp")
    slot = F.ceil(seen * F.lit(float(max_points)) / (F.col("p") + F.col("n")))
    last = F.max(F.struct(seen.alias("seen"), "threshold", "tp", "fp")).alias("point")
    return (
        ranked.join(totals, same_group)
        .groupBy(*keys, "p", "n", slot.alias("slot"))
        .agg(last)
        .select(
            *by,
            F.col("point.threshold").alias("threshold"),
            (F.col("point.fp") / F.nullif(F.col("n").cast("double"), F.lit(0.0))).alias("fpr"),
            (F.col("point.tp") / F.nullif(F.col("p").cast("double"), F.lit(0.0))).alias("tpr"),
        )
    )
