"""Training and evaluation of classifiers with Spark MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.gates import calibrate_threshold
from orderflow.operators.metrics import evaluate
from orderflow.operators.windows import is_holdout, parts
from orderflow.workspace import drop_folder, materialize, run_dir, shared_dir, shuffles_freed

_WEIGHT = "_weight"
_SUFFIX_MISSING = "__missing"


@dataclass(frozen=True)
class FeatureSpec:
    """Model inputs. `nullable` numeric columns get an is-missing flag next to the imputed value."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def without(self, *dropped: str) -> FeatureSpec:
        return replace(
            self,
            numeric=tuple(c for c in self.numeric if c not in dropped),
            categorical=tuple(c for c in self.categorical if c not in dropped),
            nullable=tuple(c for c in self.nullable if c not in dropped),
        )


def _number(name: str) -> str:
    return f"{name}__num"


def _inputs(spec: FeatureSpec) -> list:
    """Stages that make numeric columns doubles, flag and fill gaps, and index categories."""
    numbers = [f"CAST(`{c}` AS DOUBLE) AS `{_number(c)}`" for c in spec.numeric]
    flags = [
        f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}{_SUFFIX_MISSING}`" for c in spec.nullable
    ]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(numbers + flags)} FROM __THIS__")]
    if spec.nullable:
        filled = [_number(c) for c in spec.nullable]
        stages.append(Imputer(strategy="mean", inputCols=filled, outputCols=filled))
    if spec.categorical:
        stages.append(
            StringIndexer(
                inputCols=list(spec.categorical),
                outputCols=[f"{c}__idx" for c in spec.categorical],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
    return stages


def _numeric_inputs(spec: FeatureSpec) -> list[str]:
    return [_number(c) for c in spec.numeric] + [f"{c}{_SUFFIX_MISSING}" for c in spec.nullable]


#: Fits under way at a time, where the executors' memory holds what that many keep of their rows.
FITS_AT_ONCE = 4
#: Bytes that a fit of trees keeps of a row, besides four for each input.
_ROW_BYTES = 64
#: Bins of a number; categories with more levels get as many.
_BINS = 64


def build_pipeline(kind: str, spec: FeatureSpec, label: str,
                   params: Mapping[str, object] | None = None, seed: int = 42) -> Pipeline:
    """Pipeline of kind 'gbt' (boosted trees) or 'logreg' (logistic regression)."""
    options = dict(params or {})
    stages = _inputs(spec)
    numeric = _numeric_inputs(spec)
    if kind == "gbt":
        defaults = {"maxIter": 20, "maxDepth": 4, "maxBins": _BINS, "stepSize": 0.15}
        assembler = VectorAssembler(
            inputCols=numeric + [f"{c}__idx" for c in spec.categorical], outputCol="features"
        )
        classifier = GBTClassifier(
            labelCol=label, featuresCol="features", weightCol=_WEIGHT, seed=seed,
            checkpointInterval=10, **{**defaults, **options},
        )
        return Pipeline(stages=[*stages, assembler, classifier])
    if kind == "logreg":
        defaults = {"maxIter": 50, "regParam": 0.001}
        encoded = []
        if spec.categorical:
            encoded = [f"{c}__hot" for c in spec.categorical]
            stages.append(
                OneHotEncoder(
                    inputCols=[f"{c}__idx" for c in spec.categorical],
                    outputCols=encoded,
                    handleInvalid="keep",
                )
            )
        stages.append(VectorAssembler(inputCols=numeric + encoded, outputCol="raw_features"))
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features"))
        classifier = LogisticRegression(
            labelCol=label, featuresCol="features", weightCol=_WEIGHT, standardization=False,
            **{**defaults, **options},
        )
        return Pipeline(stages=[*stages, classifier])
    raise ValueError(f"unknown model kind {kind!r}, expected 'gbt' or 'logreg'")


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Both classes get half of the total weight."""
    n, pos = df.agg(F.count("*"), F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0))).first()
    if pos in (0, n):
        raise ValueError("training rows must hold both classes")
    weight = F.when(F.col(label) == 1, n / (2.0 * pos)).otherwise(n / (2.0 * (n - pos)))
    return df.withColumn(_WEIGHT, weight)


def train(
    df: DataFrame,
    kind: str,
    spec: FeatureSpec,
    label: str,
    key: str,
    params: Mapping[str, object] | None = None,
    seed: int = 42,
    written: bool = False,
) -> PipelineModel:
    """Fit on the labelled rows.

    The training columns are written once, placed and sorted by key: every
    later pass of the optimizer reads that table instead of recomputing the
    mart, a lost executor rereads its part, and reruns see the same order.
    AQE sets the number of parts by their size. The table is dropped when the
    model is fitted. Rows of a table that `placed_by_key` was written to need
    no table of their own: they are `written`.
    """
    spark = df.sparkSession
    shared_dir(spark)  # tree nodes are checkpointed there
    rows = df.where(F.col(label).isNotNull()).select(key, label, *spec.columns)
    if written:
        return _fitted(rows, kind, spec, label, params, seed)
    path = run_dir(spark, "training")
    try:
        with shuffles_freed(spark):
            placed_by_key(rows, key).write.parquet(path)
        return _fitted(spark.read.schema(rows.schema).parquet(path), kind, spec, label, params, seed)
    finally:
        drop_folder(spark, path)


def placed_by_key(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out and sorted by key, so that fits on what is written of them see one order."""
    return rows.repartition(F.col(key)).sortWithinPartitions(key)


def _fitted(table: DataFrame, kind: str, spec: FeatureSpec, label: str, params: Mapping[str, object] | None, seed: int) -> PipelineModel:
    options = dict(params or {})
    if kind == "gbt" and spec.categorical:
        options["maxBins"] = max(int(options.get("maxBins", _BINS)), _most_levels(table, spec) + 2)
    return build_pipeline(kind, spec, label, options, seed).fit(with_class_weights(table, label))


def _most_levels(table: DataFrame, spec: FeatureSpec) -> int:
    """Levels of the category with the most of them; a tree needs a bin for each, one for NULL and one for new ones."""
    counts = table.agg(*[F.count_distinct(c) for c in spec.categorical]).first()
    return max(counts)


def scored(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Columns `keep` and the probability of the positive class as `score`."""
    probability = vector_to_array(F.col("probability"))[1]
    return model.transform(df).select(*keep, probability.alias("score"))


def evaluate_model(model: PipelineModel, holdout: DataFrame, label: str, by: Sequence[str] = ()
                   ) -> DataFrame:
    """Metrics table of a model on holdout rows; accuracy is left out on purpose.

    The scores are written first, as ranking reads them more than once.
    """
    scores = materialize(scored(model, holdout, [label, *by]), "scores")
    return evaluate(scores, "score", label, by)


def importance(model: PipelineModel, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(feature, importance) per input column, shares of one.

    Vector slots, as named by the assembler's metadata, are added up per
    input column: a value with its missing flag, a category with its levels.
    """
    slots = model.transform(df.limit(0)).schema
    assembled = "raw_features" if "raw_features" in slots.names else "features"
    attributes = slots[assembled].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    final = model.stages[-1]
    if hasattr(final, "featureImportances"):
        weights = final.featureImportances.toArray()
    else:
        weights = [abs(w) for w in final.coefficients.toArray()]
    shares = dict.fromkeys(spec.columns, 0.0)
    for index, weight in enumerate(weights):
        source = max(
            (c for c in spec.columns if names[index].startswith(f"{c}__")), key=len
        )
        shares[source] += float(weight)
    total = sum(shares.values()) or 1.0
    rows = [(name, share / total) for name, share in shares.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


Fit = Callable[[DataFrame, FeatureSpec], PipelineModel]


def side_by_side(spark: SparkSession, runs: Sequence[Callable[[], DataFrame]], most: int = FITS_AT_ONCE) -> list[DataFrame]:
    """Results of independent runs, at most `most` of which are under way at a time.

    A fit is many short jobs with little to do at their ends; jobs of other fits fill those gaps. The first
    failure ends the call.
    """
    if not runs:
        return []
    with ThreadPoolExecutor(min(most, len(runs))) as pool:
        return list(pool.map(lambda run: inheritable_thread_target(spark)(run)(), runs))


def fits_at_once(spark: SparkSession, rows: int, inputs: int) -> int:
    """How many fits on `rows` rows may be under way: as many as memory holds, one at least, `FITS_AT_ONCE` at most.

    A fit keeps its rows in the executors' memory and what is too much for it on their disks, where the
    rows of several fits would add up.
    """
    memory = sum(pair._1() for pair in _values(spark.sparkContext._jsc.sc().getExecutorMemoryStatus()))
    return max(1, min(FITS_AT_ONCE, memory // max(1, rows * (_ROW_BYTES + 4 * inputs))))


def _values(scala_map) -> list:
    found = scala_map.values().toSeq()
    return [found.apply(i) for i in range(found.size())]


def _inputs_of(spec: FeatureSpec) -> int:
    return len(spec.columns) + len(spec.nullable)


def _stacked(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def compare_splits(datasets: Mapping[str, DataFrame], fit: Fit, spec: FeatureSpec, label: str
                   ) -> DataFrame:
    """The same model under several splits: metrics with a column `split`."""

    def run(name: str) -> DataFrame:
        train_rows, holdout = parts(datasets[name])
        return evaluate_model(fit(train_rows, spec), holdout, label).select(F.lit(name).alias("split"), "*")

    spark = next(iter(datasets.values())).sparkSession
    most = fits_at_once(spark, max(rows.count() for rows in datasets.values()), _inputs_of(spec))
    return _stacked(side_by_side(spark, [partial(run, name) for name in datasets], most))


def ablate(dataset: DataFrame, fit: Fit, spec: FeatureSpec, label: str, features: Sequence[str],
           key: str | None = None) -> DataFrame:
    """ROC AUC without a feature and the loss against all features, one row per feature.

    The dataset is written once and read by all fits; with `key` it is placed by it, and `fit` may train
    on its rows as they are (`written`).
    """
    table = materialize(placed_by_key(dataset, key) if key else dataset, "ablation")
    train_rows, holdout = parts(table)

    def run(feature: str | None) -> DataFrame:
        kept = spec if feature is None else spec.without(feature)
        return evaluate_model(fit(train_rows, kept), holdout, label).select(F.lit(feature).cast("string").alias("dropped_feature"), "roc_auc")

    spark = dataset.sparkSession
    whole, *reduced = side_by_side(spark, [partial(run, f) for f in (None, *features)], fits_at_once(spark, table.count(), _inputs_of(spec)))
    baseline = F.lit(whole.first()["roc_auc"]).cast("double")
    return _stacked(reduced).select("dropped_feature", baseline.alias("roc_auc_all"), "roc_auc", (baseline - F.col("roc_auc")).alias("loss"))


def calibrate(mart: DataFrame, fit: Fit, spec: FeatureSpec, label: str, key: str,
              seeds: Sequence[int], frac: float, margin: float = 0.02) -> DataFrame:
    """Gate threshold from one fit per split seed.

    The mart's labelled rows are written once, placed by key, and read by all fits; `fit` may train on them as
    they are (`written`).
    """
    rows = materialize(placed_by_key(mart.where(F.col(label).isNotNull()), key), "calibration")
    spark = mart.sparkSession

    def run(seed: int) -> DataFrame:
        holdout = is_holdout(key, seed, frac)
        model = fit(rows.where(~holdout), spec)
        return evaluate_model(model, rows.where(holdout), label).select(F.lit(seed).alias("seed"), "roc_auc")

    found = side_by_side(spark, [partial(run, s) for s in seeds], fits_at_once(spark, rows.count(), _inputs_of(spec)))
    return calibrate_threshold(_stacked(found), margin)


def leakage_scan(df: DataFrame, cols: Sequence[str], label: str, limit: float = 0.95
                 ) -> DataFrame:
    """How well every single column separates the classes: (feature, roc_auc, separation, suspect).

    A column that nearly decides the label alone was most likely recorded
    after the outcome. All columns are ranked in one evaluation.
    """
    long = (
        df.where(F.col(label).isNotNull())
        .select(F.col(label).alias("_label"), *[F.col(c).cast("double").alias(c) for c in cols])
        .unpivot(["_label"], list(cols), "feature", "value")
    )
    separation = F.greatest("roc_auc", 1 - F.col("roc_auc"))
    return evaluate(long, "value", "_label", ["feature"]).select(
        "feature",
        "n_rows",
        "roc_auc",
        separation.alias("separation"),
        F.coalesce(separation >= limit, F.lit(False)).alias("suspect"),
    )
