from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderflow.operators import training
from orderflow.operators.registry import register_version, set_alias
from orderflow.operators.scoring import (
    Registry,
    backfill,
    day_range,
    of_days,
    read_predictions,
    score_changed,
    score_days,
)
from orderflow.operators.training import (
    FeatureSpec,
    ablate,
    calibrate,
    compare_splits,
    evaluate_model,
    importance,
    leakage_scan,
    scored,
    train,
    with_class_weights,
)
from orderflow.operators.windows import hash_split, training_dataset
from orderflow.workspace import materialize, shared_dir

pytestmark = pytest.mark.slow

SPEC = FeatureSpec(numeric=("signal", "noise", "gap"), categorical=("kind",), nullable=("gap",))
GBT = {"maxIter": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """A planted signal, a useless column, a column with gaps and a category."""
    df = spark.range(2000).select(
        F.col("id").alias("k"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("day"),
        F.rand(1).alias("signal"),
        F.rand(2).alias("noise"),
        F.when(F.rand(3) < 0.7, F.rand(4)).alias("gap"),
        F.when(F.rand(5) < 0.5, "a").otherwise("b").alias("kind"),
    ).withColumn("y", (F.col("signal") + 0.3 * F.rand(6) > 1.0).cast("int"))
    path = str(tmp_path_factory.mktemp("rows"))
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fit(kind, params=None):
    return lambda df, spec: train(df, kind, spec, "y", "k", params, seed=1)


def test_categories_with_many_levels_train_and_score(spark, rows):
    many = rows.withColumn("kind", F.concat(F.lit("c"), F.col("k") % 90))
    model = train(many.where("k % 90 < 85"), "gbt", SPEC, "y", "k", {"maxIter": 1, "maxDepth": 2}, seed=1)
    assert scored(model, many, ["k"]).where("score between 0 and 1").count() == many.count()


@pytest.mark.parametrize("kind, params", [("gbt", GBT), ("logreg", None)])
def test_model_beats_chance_and_reruns_agree(spark, rows, kind, params):
    train_rows, holdout = hash_split(rows, "k", 1, 0.25)
    scores = []
    for _ in range(2):
        model = fit(kind, params)(train_rows, SPEC)
        metrics = evaluate_model(model, holdout, "y").first()
        scores.append((round(metrics["roc_auc"], 6), round(metrics["pr_auc"], 6)))
    assert scores[0] == scores[1] and scores[0][0] > 0.9
    shares = {r["feature"]: r["importance"] for r in importance(model, rows, SPEC).collect()}
    assert set(shares) == set(SPEC.columns) and sum(shares.values()) == pytest.approx(1.0)
    assert max(shares, key=shares.get) == "signal"


def test_unseen_category_and_gaps_are_scored(spark, rows):
    model = fit("gbt", GBT)(rows, SPEC)
    odd = spark.createDataFrame(
        [(1, 0.5, 0.5, None, "never seen"), (2, 0.5, 0.5, None, None)],
        "k long, signal double, noise double, gap double, kind string",
    )
    assert all(0 <= r["score"] <= 1 for r in scored(model, odd, ["k"]).collect())


def test_class_weights_balance(spark, rows):
    weights = with_class_weights(rows, "y").groupBy("y").agg(F.sum("_weight").alias("w")).collect()
    assert len({round(r["w"], 6) for r in weights}) == 1
    with pytest.raises(ValueError):
        with_class_weights(rows.where("y = 0"), "y")


def test_unknown_kind(rows):
    with pytest.raises(ValueError):
        fit("forest")(rows, SPEC)


def test_dropping_the_signal_costs_quality(rows):
    dataset = training_dataset(rows, "y", "k", "day", seed=1, test_frac=0.25)
    got = {r["dropped_feature"]: r["loss"] for r in
           ablate(dataset, fit("logreg"), SPEC, "y", ["signal", "noise"]).collect()}
    assert got["signal"] > 0.3 and abs(got["noise"]) < 0.05


def test_splits_side_by_side(rows):
    datasets = {
        "hash": training_dataset(rows, "y", "k", "day", seed=1, test_frac=0.25),
        "time": training_dataset(rows, "y", "k", "day", split="time", cutoff=date(2024, 2, 1)),
    }
    got = {r["split"]: r["n_rows"] for r in
           compare_splits(datasets, fit("logreg"), SPEC, "y").collect()}
    assert set(got) == {"hash", "time"}
    assert got["time"] == rows.where(F.col("day") >= F.lit(date(2024, 2, 1))).count()


def test_calibration_over_seeds(rows):
    row = calibrate(rows, fit("logreg"), SPEC, "y", "k", (1, 2), 0.25).first()
    assert row["n_seeds"] == 2 and row["threshold"] == pytest.approx(row["min_roc_auc"] - 0.02)


def test_leaking_column_stands_out(rows):
    leaky = rows.withColumn("after", F.col("y") * 10 + F.rand(9))
    got = {r["feature"]: r["suspect"] for r in
           leakage_scan(leaky, ["noise", "after", "gap"], "y").collect()}
    assert got == {"noise": False, "after": True, "gap": False}


@pytest.fixture(scope="module")
def registry(spark, rows, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("registry"))
    registry = Registry(f"{root}/versions", f"{root}/aliases", "m")
    for version, params in enumerate(({"maxIter": 2}, {"maxIter": 20}), start=1):
        path = f"{root}/model{version}"
        fit("logreg", params)(rows, SPEC).write().overwrite().save(path)
        register_version(spark, registry.versions_path, "m", f"f{version}", path, datetime(2024, 3, version))
    set_alias(spark, registry.aliases_path, "m", "champion", 1, datetime(2024, 3, 3))
    return registry


COLUMNS = {"key": "k", "day_col": "day", "month_col": None}
AT = datetime(2024, 4, 1)


def table(spark, out):
    return read_predictions(spark, out, spark.range(1).schema["id"].dataType, "k")


def test_scoring_uses_the_alias_and_reruns_add_nothing(spark, rows, registry, tmp_path):
    out = str(tmp_path / "pred")
    days = day_range(date(2024, 1, 1), date(2024, 1, 3))
    for _ in range(2):
        assert score_days(rows, days, registry, out, AT, **COLUMNS) == []
    got = table(spark, out)
    assert got.count() == rows.where(F.col("day").isin(days)).count()
    assert {r["model_version"] for r in got.select("model_version").distinct().collect()} == {1}


def test_promotion_leaves_history_until_backfill(spark, rows, registry, tmp_path):
    out = str(tmp_path / "pred")
    score_days(rows, [date(2024, 1, 1)], registry, out, AT, **COLUMNS)
    set_alias(spark, registry.aliases_path, "m", "champion", 2, datetime(2024, 3, 4))
    score_days(rows, [date(2024, 1, 2)], registry, out, AT, **COLUMNS)
    versions = {(r["day"].day, r["model_version"]) for r in table(spark, out).collect()}
    assert versions == {(1, 1), (2, 2)}
    backfill(rows, date(2024, 1, 1), date(2024, 1, 2), 2, registry, out, AT, **COLUMNS)
    assert {r["model_version"] for r in table(spark, out).collect()} == {2}
    set_alias(spark, registry.aliases_path, "m", "champion", 1, datetime(2024, 3, 5))
    with pytest.raises(LookupError):
        backfill(rows, date(2024, 1, 1), date(2024, 1, 1), 7, registry, out, AT, **COLUMNS)


def test_changed_days_only(spark, rows, registry, tmp_path):
    out = str(tmp_path / "pred")
    days = day_range(date(2024, 1, 1), date(2024, 1, 3))
    score_days(rows, days, registry, out, AT, **COLUMNS)
    changes = spark.createDataFrame(
        [(date(2024, 1, 2), "changed"), (date(2024, 1, 3), "removed")], "day date, change string"
    )
    later = rows.where(F.col("day") != F.lit(date(2024, 1, 3)))
    handled = score_changed(later, changes, registry, out, datetime(2024, 5, 1), **COLUMNS)
    assert handled == days[1:]
    got = {(r["day"], r["scored_at"]) for r in table(spark, out).collect()}
    assert got == {(days[0], AT), (days[1], datetime(2024, 5, 1))}


def test_day_filter_prunes_month_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "mart")
    rows.withColumn("month", F.trunc("day", "MM")).write.partitionBy("month").parquet(path)
    picked = of_days(spark.read.parquet(path), [date(2024, 2, 1)], "day", "month")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [" in plan
    assert picked.count() == 50


def tables(spark, label):
    from pathlib import Path

    return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob(f"{label}-*")}


def test_a_fit_leaves_no_training_table(spark, rows):
    before = tables(spark, "training")
    fit("logreg")(rows, SPEC)
    assert tables(spark, "training") == before


def test_written_rows_are_not_written_again_and_give_the_same_model(spark, rows, monkeypatch):
    placed = materialize(training.placed_by_key(rows, "k"), "placed")
    own = train(rows, "gbt", SPEC, "y", "k", GBT)
    made = []
    monkeypatch.setattr(training, "run_dir", lambda spark, label: made.append(label))
    shared = train(placed, "gbt", SPEC, "y", "k", GBT, written=True)
    assert made == [] and own.stages[-1].toDebugString.split("\n")[1:] == shared.stages[-1].toDebugString.split("\n")[1:]


def test_fits_at_once_follow_memory(spark):
    assert training.fits_at_once(spark, 1_000, 30) == training.FITS_AT_ONCE
    assert training.fits_at_once(spark, 10**12, 30) == 1
