"""Drift of features and scores, and skew between training and serving."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.operators.cumulative import cumulative_counts
from orderflow.operators.quantiles import exact_quantiles
from orderflow.sources.layers import replace_partitions

# Bins of a feature, smallest share of a bin, index of the NULL bin.
N_BINS = 10
SHARE_FLOOR = 1e-4
NULL_BIN = -1

_INF = float("inf")


def bin_edges(base: DataFrame, cols: Sequence[str], n: int = N_BINS) -> DataFrame:
    """Distinct inner quantiles per column, exact: (feature, edges); a column without numbers has none."""
    found = exact_quantiles(base, cols, n).groupBy("feature").agg(F.array_sort(F.collect_set("edge")).alias("edges"))
    names = base.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    nothing = F.array().cast("array<double>")
    return names.join(found, "feature", "left").select("feature", F.coalesce("edges", nothing).alias("edges"))


def edges_map(edges: DataFrame) -> dict[str, list[float]]:
    """Edge table as an argument for `psi`; one short list per feature."""
    return {row["feature"]: list(row["edges"] or []) for row in edges.collect()}


def bin_counts(base: DataFrame, cur: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Rows per (feature, bin) of both samples; bins are [edge_i, edge_i+1), NULL is bin -1.

    Both samples go through one scan-and-count; an aggregated row exists only
    per feature and bin.
    """
    cols = list(edges)

    def doubles(df: DataFrame, is_cur: int) -> DataFrame:
        return df.select(
            *[F.col(c).cast("double").alias(c) for c in cols], F.lit(is_cur).alias("_cur")
        )

    rows = doubles(base, 0).unionByName(doubles(cur, 1))
    binner = Bucketizer(
        splitsArray=[[-_INF, *(sorted(set(edges[c])) or [0.0]), _INF] for c in cols],
        inputCols=cols,
        outputCols=[f"_bin_{i}" for i in range(len(cols))],
        handleInvalid="keep",
    )
    bins = [
        F.when(F.col(c).isNull(), NULL_BIN).otherwise(F.col(f"_bin_{i}").cast("int")).alias(c)
        for i, c in enumerate(cols)
    ]
    return (
        binner.transform(rows)
        .select("_cur", *bins)
        .unpivot(["_cur"], cols, "feature", "bin")
        .groupBy("feature", "bin")
        .agg(
            F.sum(1 - F.col("_cur")).alias("n_base"),
            F.sum(F.col("_cur")).alias("n_cur"),
        )
    )


def psi(base: DataFrame, cur: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Population stability index per feature: (feature, n_base, n_cur, psi)."""
    counts = bin_counts(base, cur, edges)
    totals = counts.groupBy(F.col("feature").alias("_feature")).agg(
        F.sum("n_base").alias("base_total"), F.sum("n_cur").alias("cur_total")
    )
    base_share = _share("n_base", "base_total")
    cur_share = _share("n_cur", "cur_total")
    term = (cur_share - base_share) * F.ln(cur_share / base_share)
    return (
        counts.join(F.broadcast(totals), F.col("feature") == F.col("_feature"))  # one row a column
        .groupBy("feature")
        .agg(
            F.max("base_total").alias("n_base"),
            F.max("cur_total").alias("n_cur"),
            F.sum(term).alias("psi"),
        )
    )


def binned_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], categories: Sequence[str] = (),
                  by: Sequence[str] = ()) -> DataFrame:
    """Rows per (by, feature, bin) in one pass; a bin is named by its range's index, a category by its value.

    NULL has a bin of its own, named NULL. An aggregated row exists only per group, feature and bin.
    """
    cols = list(edges)
    places = [f"_bin_{i}" for i in range(len(cols))]
    rows = df.select(
        *by, *[F.col(c).cast("double").alias(f"_num_{i}") for i, c in enumerate(cols)],
        *[F.col(c).cast("string").alias(f"_cat_{i}") for i, c in enumerate(categories)],
    )
    if cols:
        rows = Bucketizer(
            splitsArray=[[-_INF, *(sorted(set(edges[c])) or [0.0]), _INF] for c in cols],
            inputCols=[f"_num_{i}" for i in range(len(cols))],
            outputCols=places,
            handleInvalid="keep",
        ).transform(rows)
    named = [
        F.struct(F.lit(c).alias("feature"), F.when(F.col(f"_num_{i}").isNotNull(), F.col(p).cast("int").cast("string")).alias("bin"))
        for i, (c, p) in enumerate(zip(cols, places, strict=True))
    ] + [F.struct(F.lit(c).alias("feature"), F.col(f"_cat_{i}").alias("bin")) for i, c in enumerate(categories)]
    return (
        rows.select(*by, F.explode(F.array(*named)).alias("_b"))
        .groupBy(*by, F.col("_b.feature").alias("feature"), F.col("_b.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def psi_by(base: DataFrame, cur: DataFrame, edges: Mapping[str, Sequence[float]], by: Sequence[str],
           categories: Sequence[str] = ()) -> DataFrame:
    """Population stability of every feature and group of `cur`, such as a day, against one baseline.

    (by, feature, n_base, n_cur, psi). All groups and features come from one scan of each sample. A
    group lacks most bins; the terms of those it lacks are the baseline's alone, so they are added up
    once for each feature and no table of groups and bins is made.
    """
    keys = list(by)
    known = binned_counts(base, edges, categories)
    base_total = F.sum("n").over(Window.partitionBy("feature"))
    expected = F.greatest(F.col("n") / base_total, F.lit(SHARE_FLOOR))
    floor = F.lit(SHARE_FLOOR)
    baseline = known.select(
        F.col("feature").alias("_feature"), F.col("bin").alias("_bin"), expected.alias("_e"), base_total.alias("n_base"),
    ).withColumn("_absent", (floor - F.col("_e")) * F.ln(floor / F.col("_e")))
    totals = baseline.groupBy("_feature").agg(F.sum("_absent").alias("_absent_all"), F.max("n_base").alias("n_base"))

    seen = binned_counts(cur, edges, categories, keys)
    cur_total = F.sum("n").over(Window.partitionBy(*keys, "feature"))  # bins of one group
    shares = seen.withColumn("n_cur", cur_total).withColumn("_c", F.greatest(F.col("n") / F.col("n_cur"), floor))
    joined = shares.join(
        baseline.select("_feature", "_bin", "_e", "_absent"),
        (F.col("feature") == F.col("_feature")) & F.col("bin").eqNullSafe(F.col("_bin")), "left",
    ).drop("_feature")
    e = F.coalesce("_e", floor)
    term = (F.col("_c") - e) * F.ln(F.col("_c") / e) - F.coalesce("_absent", F.lit(0.0))
    return (
        joined.groupBy(*keys, "feature")
        .agg(F.max("n_cur").alias("n_cur"), F.sum(term).alias("_terms"))
        .join(totals, F.col("feature") == F.col("_feature"), "left")
        .select(*keys, "feature", F.coalesce("n_base", F.lit(0)).alias("n_base"), "n_cur", (F.col("_terms") + F.col("_absent_all")).alias("psi"))
    )


def monitor_days(base: DataFrame, cur: DataFrame, edges: Mapping[str, Sequence[float]], limits: DataFrame, out: str,
                 days: Sequence[date], day_col: str, partition: str, categories: Sequence[str] = ()) -> list[date]:
    """Drift checks of every feature and day of `cur`, written as the partitions `days` of the table at `out`.

    One job makes the checks of all days; a rerun replaces the same partitions, also those that became
    empty, which it returns. `partition` is a column of `cur` such as the day itself or its month.
    """
    by = list(dict.fromkeys([day_col, partition]))
    found = psi_by(base, cur, edges, by, categories)
    statistics = found.select(
        *by, F.lit("psi").alias("check"), F.col("feature").alias("subject"), F.col("psi").alias("observed"), "n_cur"
    )
    return replace_partitions(drift_checks(statistics, limits, [*by, "n_cur"]), out, days, partition)


def _share(count: str, total: str):
    """Share of a bin, floored; NULL when the sample has no rows at all."""
    return F.when(F.col(total) > 0, F.greatest(F.col(count) / F.col(total), F.lit(SHARE_FLOOR)))


def ks(base: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Largest distance of the two distribution functions per feature, NULLs left out."""

    def doubles(df: DataFrame, is_cur: int) -> DataFrame:
        return df.select(
            F.lit(1 - is_cur).cast("long").alias("n_base"),
            F.lit(is_cur).cast("long").alias("n_cur"),
            *[F.col(c).cast("double").alias(c) for c in cols],
        )

    rows = (
        doubles(base, 0)
        .unionByName(doubles(cur, 1))
        .unpivot(["n_base", "n_cur"], list(cols), "feature", "value")
    )
    points = cumulative_counts(rows, "value", ["n_base", "n_cur"], ["feature"]).select(
        "feature",
        (F.col("n_base") + F.col("n_base_before")).alias("base_seen"),
        (F.col("n_cur") + F.col("n_cur_before")).alias("cur_seen"),
    )
    totals = points.groupBy(F.col("feature").alias("_feature")).agg(
        F.max("base_seen").alias("base_total"), F.max("cur_seen").alias("cur_total")
    )
    distance = F.abs(
        F.col("base_seen") / F.nullif(F.col("base_total"), F.lit(0))
        - F.col("cur_seen") / F.nullif(F.col("cur_total"), F.lit(0))
    )
    return (
        points.join(F.broadcast(totals), F.col("feature") == F.col("_feature"))  # one row a column
        .groupBy("feature")
        .agg(
            F.max("base_total").alias("n_base"),
            F.max("cur_total").alias("n_cur"),
            F.max(distance).alias("ks"),
        )
    )


def feature_skew(served: DataFrame, mart: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Share of served rows whose feature differs from the mart, NULL equal to NULL.

    Rows are compared on the joined row and counted per column at once; only
    the one-row result is turned into a row per feature.
    """
    m = mart.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in cols])
    joined = served.select(key, *cols).join(m, F.col(key) == F.col("_key"))
    counts = joined.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(~F.col(c).eqNullSafe(F.col(f"_{c}"))).alias(c) for c in cols],
    )
    return counts.unpivot(["n_rows"], list(cols), "feature", "n_mismatch").select(
        "feature",
        "n_rows",
        "n_mismatch",
        (F.col("n_mismatch") / F.nullif(F.col("n_rows"), F.lit(0))).alias("mismatch_rate"),
    )


def drift_checks(statistics: DataFrame, limits: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drift statistics against limits as check rows, with the columns `keep` of the statistics.

    `statistics`: (check, subject, observed). `limits`: (check, warn, error),
    one row per kind of check. A statistic above `error` is an ERROR, above
    `warn` a WARN. A statistic without a value, or of a check without limits, is an ERROR.
    """
    observed, warn, error = F.col("observed"), F.col("warn"), F.col("error")
    unknown = observed.isNull() | F.isnan(observed.cast("double")) | warn.isNull() | error.isNull()
    severity = (
        F.when(unknown | (observed > error), "ERROR").when(observed > warn, "WARN").otherwise("OK")
    )
    return statistics.join(limits, "check", "left").select(
        *keep,
        "check",
        "subject",
        F.lit("monitoring").alias("stage"),
        severity.alias("severity"),
        (severity == "OK").alias("passed"),
        observed,
        F.when(unknown | (observed > error), error).otherwise(warn).alias("threshold"),
    )


def prediction_monitoring(
    base: DataFrame,
    cur: DataFrame,
    edges: Sequence[float],
    cutoff: float,
    limits: DataFrame,
    score: str = "score",
) -> DataFrame:
    """Checks on predictions before any label is known.

    PSI of the score, and the change of the share predicted positive, that
    is with a score of at least `cutoff`; limits as in `drift_checks`.
    """

    def flagged(df: DataFrame) -> DataFrame:
        return df.select(score, (F.col(score) >= cutoff).cast("int").alias("_positive"))

    shifted = rate_shift(flagged(base), flagged(cur), "_positive").select(
        F.lit("positive_rate").alias("check"),
        F.lit("predictions").alias("subject"),
        F.col("shift").alias("observed"),
    )
    stability = psi(base, cur, {score: edges}).select(
        F.lit("psi").alias("check"),
        F.col("feature").alias("subject"),
        F.col("psi").alias("observed"),
    )
    return drift_checks(stability.unionByName(shifted), limits)


def rate_shift(base: DataFrame, cur: DataFrame, label: str) -> DataFrame:
    """Absolute change of the positive rate between two samples: (base_rate, cur_rate, shift)."""
    rows = base.select(F.col(label).cast("double").alias("base")).withColumn(
        "cur", F.lit(None).cast("double")
    )
    rows = rows.unionByName(
        cur.select(F.lit(None).cast("double").alias("base"), F.col(label).cast("double").alias("cur"))
    )
    return rows.agg(F.avg("base").alias("base_rate"), F.avg("cur").alias("cur_rate")).withColumn(
        "shift", F.abs(F.col("cur_rate") - F.col("base_rate"))
    )
