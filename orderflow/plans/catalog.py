"""The driver queries: every operator on the given tables.

Each query takes (spark, folder) and reads whole tables. Columns are brought
to long, double rounded to six digits, and text, so that another SQL engine
can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions.dates import month_of
from orderflow.functions.labels import label_known_at, late_label, settled_label
from orderflow.operators.checks import (
    AcceptedValues,
    NotNull,
    Relationship,
    Unique,
    blocking_failures,
    duplicate_audit,
    freshness,
    run_checks,
    transform_checks,
)
from orderflow.operators.drift import (
    bin_edges,
    drift_checks,
    edges_map,
    feature_skew,
    ks,
    monitor_days,
    prediction_monitoring,
    psi,
    rate_shift,
)
from orderflow.operators.feedback import late_label_join, model_performance, retrain_triggers
from orderflow.operators.fingerprint import changed_partitions, dataset_fingerprint
from orderflow.operators.gates import calibrate_threshold, champion_gate, quality_gate
from orderflow.operators.lookup import with_lookup
from orderflow.operators.metrics import evaluate, positive_rate, pr_auc, roc_auc, roc_curve
from orderflow.operators.origin import origin_report
from orderflow.operators.registry import (
    ALIAS_SCHEMA,
    CHAMPION,
    alias_as_of,
    current_alias,
    new_versions,
    promote,
    read_table,
    resolve_versions,
    rollback,
)
from orderflow.operators.sampling import Follow, cap_rows, orphans, sample_connected
from orderflow.operators.staging import Field, cast_failures, stage
from orderflow.operators.training import leakage_scan
from orderflow.operators.windows import (
    add_seeds,
    hash_split,
    time_split,
    training_dataset,
    training_window,
    visible_as_of,
    window_bounds,
)
from orderflow.plans.mart import (
    DECLARED_ORIGINS,
    FEATURES,
    FORBIDDEN_ORIGINS,
    LABEL,
    build_layers,
    feature_spec,
    inference_mart,
    mart_order_features,
    order_features,
)
from orderflow.plans.refresh import affected_orders, changes_between, refresh_layers, refreshed
from orderflow.sources.layers import latest_by
from orderflow.sources.roles import Roles, instant, load_roles, table
from orderflow.workspace import run_dir, shuffles_freed

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the driver queries, repeated in the comparison SQL.
SEED = 42
TEST_FRAC = 0.2
SAMPLE_FRAC = 0.05
SEEDS = (1, 2, 3, 4, 5)
TODAY = date(1999, 6, 30)
LAG_DAYS = 1000
CUTOFF = date(1998, 1, 1)
NUMERIC = feature_spec().numeric
SCORE_EDGES = [20.0, 40.0, 60.0, 80.0, 100.0, 120.0]
SCORE_CUTOFF = 100.0
NEWS_LAG = 60
DRIFT_LIMITS = [("psi", 0.1, 0.25), ("positive_rate", 0.02, 0.05)]


def comparable(df: DataFrame) -> DataFrame:
    """Result columns in types two engines spell alike."""

    def plain(field: T.StructField) -> Column:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.round(column.cast("double"), 6)
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("long")
        if isinstance(kind, T.DateType):
            return F.date_format(column, "yyyy-MM-dd")
        if isinstance(kind, T.TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column

    return df.select(*[plain(f).alias(f.name) for f in df.schema])


def features_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_features(load_roles(spark, sf_dir))


_layers: dict[tuple[str, str], tuple[str, T.StructType]] = {}


def features_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written features of all orders; layers are built once per application and folder.

    Monitoring, gates, training and scoring read this table, as they would in
    a pipeline; `layer_tables` and the first reader pay for building it.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _layers:
        root = run_dir(spark, "layers")
        schema = build_layers(load_roles(spark, sf_dir), root).schema
        _layers[known] = (f"{root}/marts/order_features", schema)
    path, schema = _layers[known]
    return spark.read.schema(schema).parquet(path)


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their label; needs deliveries only."""
    return load_roles(spark, sf_dir).orders.select(
        "order_id",
        F.to_date("purchase_ts").alias("purchase_date"),
        month_of(F.to_date("purchase_ts")).alias("month"),
        "order_priority",
        "delivered_at",
        late_label().alias(LABEL),
    )


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered orders with two formula scores in place of model output."""
    mart = mart_order_features(features_layer(spark, sf_dir))
    return mart.select(
        "order_id",
        "purchase_date",
        "month",
        "order_priority",
        LABEL,
        (24100 - F.col("month_index") - 10 * F.col("n_items")).alias("score"),
        (24100 - F.col("month_index")).alias("champion_score"),
    )


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference log: events with the segment of their customer as a label."""
    events = table(spark, sf_dir, "events")
    segment = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("label"),
    )
    logged = events.select(
        "event_id", instant("ts").alias("ts"), "user_id", "event_type", "value"
    )
    return with_lookup(logged, segment, "user_id")


# --- mart ---------------------------------------------------------------


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_order_features(features_of(spark, sf_dir))


def inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference_mart(features_of(spark, sf_dir))


def before_the_news(roles: Roles) -> Roles:
    """The inputs a step earlier: without the last day's orders, and with one day's deliveries not reported yet.

    That day is the last one with deliveries `NEWS_LAG` days or more before the last order.
    """
    bought, delivered = F.to_date("purchase_ts"), F.to_date("delivered_at")
    with shuffles_freed(roles.orders.sparkSession):
        last = roles.orders.agg(F.max(bought)).first()[0]
        news = roles.orders.where(delivered <= F.date_sub(F.lit(last), NEWS_LAG)).agg(F.max(delivered)).first()[0]
    orders = roles.orders.where(bought < F.lit(last)).withColumn(
        "delivered_at", F.when(delivered == F.lit(news), None).otherwise(F.col("delivered_at"))
    )
    items = roles.items.join(orders.select("order_id"), "order_id", "left_semi")
    return replace(roles, orders=orders, items=items)


def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart written from the earlier inputs and refreshed to the present ones."""
    new = load_roles(spark, sf_dir)
    old = before_the_news(new)
    root = run_dir(spark, "refresh")
    build_layers(old, root)
    refresh_layers(old, new, root)
    return refreshed(new, root)


def mart_refresh_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that the refresh must work out again, by month and reason."""
    new = load_roles(spark, sf_dir)
    old = before_the_news(new)
    found = affected_orders(old, new, changes_between(old, new))
    month = new.orders.select("order_id", month_of(F.to_date("purchase_ts")).alias("month"))
    return found.join(month, "order_id").groupBy("month", "reason").agg(F.count("*").alias("n_orders"))


def feature_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns of every feature and whether they are known at purchase."""
    return origin_report(features_of(spark, sf_dir), FEATURES, FORBIDDEN_ORIGINS, DECLARED_ORIGINS)


def late_rate_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positive_rate(labelled_orders(spark, sf_dir), LABEL, "purchase_date")


def late_rate_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positive_rate(
        labelled_orders(spark, sf_dir), LABEL, "purchase_date", "day", ["order_priority"]
    )


def visible_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_roles(spark, sf_dir).orders.select("order_id", "customer_id", "purchase_ts")
    return visible_as_of(orders, "purchase_ts", TODAY)


def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    lookup = nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return with_lookup(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), lookup, "c_nationkey"
    )


RAW_ITEMS = [
    Field("order_id", "bigint"),
    Field("line", "int"),
    Field("quantity", "decimal(12,2)"),
    Field("shipped_on", "date", fmt="yyyy/MM/dd"),
    Field("returned", "boolean"),
    Field("status", "string"),
]


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw strings, with units, flags and gaps that do not parse."""
    returned = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("line"),
        F.when(returned, F.concat(F.col("l_quantity").cast("string"), F.lit(" pcs")))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("quantity"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("l_shipdate", "dd.MM.yyyy"))
        .alias("shipped_on"),
        F.when(returned, "true").when(F.col("l_returnflag") == "A", "").otherwise("false")
        .alias("returned"),
        F.col("l_linestatus").alias("status"),
    )


def staged_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(raw_items(spark, sf_dir), RAW_ITEMS)


def staged_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_failures(raw_items(spark, sf_dir), RAW_ITEMS)


# --- splits and samples -------------------------------------------------


def hash_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_roles(spark, sf_dir).orders.select("order_id", "customer_id")
    train, holdout = hash_split(orders, "order_id", SEED, TEST_FRAC)
    return train.withColumn("split", F.lit("train")).unionByName(
        holdout.withColumn("split", F.lit("holdout"))
    )


def time_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, holdout = time_split(labelled_orders(spark, sf_dir), "purchase_date", CUTOFF)
    rows = train.withColumn("split", F.lit("train")).unionByName(
        holdout.withColumn("split", F.lit("holdout"))
    )
    return positive_rate(rows, LABEL, "purchase_date", by=["split"])


def training_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_roles(spark, sf_dir).orders.select("order_id", "purchase_ts")
    rows, bounds = training_window(orders, "purchase_ts", CUTOFF, 12)
    return rows.withColumns({name: F.lit(value) for name, value in bounds.tags().items()})


def training_dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_dataset(
        labelled_orders(spark, sf_dir).select("order_id", "purchase_date", LABEL),
        LABEL,
        "order_id",
        "purchase_date",
        window=window_bounds(CUTOFF, 24),
        seed=SEED,
        test_frac=TEST_FRAC,
    )


FOLLOWS = (
    Follow("items", "order_id", "orders", "order_id"),
    Follow("customers", "customer_id", "orders", "customer_id"),
    Follow("products", "product_id", "items", "product_id"),
    Follow("sellers", "seller_id", "items", "seller_id"),
    Follow("nations", "nation_id", "customers", "customer_nation"),
    Follow("nations", "nation_id", "sellers", "seller_nation"),
)


def sample_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = load_roles(spark, sf_dir).as_dict()
    tables["nations"] = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"), "n_name"
    )
    return tables


def connected_sample(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = sample_sources(spark, sf_dir)
    return sample_connected(tables, "orders", "order_id", FOLLOWS, SAMPLE_FRAC, SEED)


def sample_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the sample that lost a row they refer to, by relation: none may."""
    tables = sample_sources(spark, sf_dir)
    return orphans(tables, connected_sample(spark, sf_dir), FOLLOWS)


SAMPLE_KEYS = {
    "orders": "order_id",
    "items": "order_id",
    "customers": "customer_id",
    "products": "product_id",
    "sellers": "seller_id",
    "nations": "nation_id",
}


def sample_connected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = None
    for name, df in connected_sample(spark, sf_dir).items():
        key = F.col(SAMPLE_KEYS[name]).cast("long")
        row = df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.coalesce(F.sum(key), F.lit(0)).alias("key_sum"),
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts


def cap_rows_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load_roles(spark, sf_dir).customers.select("customer_id", "customer_nation")
    return cap_rows(customers, 100, ["customer_id"], SEED)


def cap_rows_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_roles(spark, sf_dir).orders.select("order_id", "customer_id")
    return cap_rows(orders, 12_000, ["order_id"], SEED)


# --- checks and fingerprints --------------------------------------------

CHECKS = (
    NotNull("orders", "order_id"),
    NotNull("orders", "delivered_at", "WARN"),
    NotNull("customers", "customer_segment"),
    AcceptedValues("orders", "order_priority", ("1-URGENT", "2-HIGH", "3-MEDIUM"), "WARN"),
    Unique("orders", ("order_id",)),
    Unique("items", ("order_id", "product_id"), "WARN"),
    Relationship("items", "order_id", "orders", "order_id"),
    Relationship("orders", "order_id", "items", "order_id", "WARN"),
    Relationship("orders", "customer_id", "customers", "customer_id"),
)


def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_checks(load_roles(spark, sf_dir).as_dict(), CHECKS)


def dq_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed checks of the transform and of the quality stage side by side."""
    transform = transform_checks(staged_cast_failures(spark, sf_dir), "items", "ERROR")
    checks = transform.unionByName(dq_checks(spark, sf_dir))
    return (
        checks.groupBy("stage", "severity")
        .agg(
            F.count("*").alias("n_checks"),
            F.count_if(~F.col("passed")).alias("n_failed"),
            F.sum("observed").alias("observed"),
        )
    )


def dq_blocking(spark: SparkSession, sf_dir: str) -> DataFrame:
    transform = transform_checks(staged_cast_failures(spark, sf_dir), "items", "ERROR")
    return blocking_failures(transform.unionByName(dq_checks(spark, sf_dir)))


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(datetime(2024, 2, 1)).cast("timestamp")
    results = None
    for name, ts in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        row = freshness(table(spark, sf_dir, name), ts, now, 24.0, 72.0, name)
        results = row if results is None else results.unionByName(row)
    return results


def duplicate_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_audit(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def fingerprint_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = training_dataset_rows(spark, sf_dir)
    return dataset_fingerprint(dataset, "order_id", {"model": "gbt", "seed": SEED}, ["split"])


def fingerprint_item_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that repeats: the order of every line item."""
    return dataset_fingerprint(table(spark, sf_dir, "lineitem"), "l_orderkey", {"table": "items"})


def changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("purchase_ts")
    orders = load_roles(spark, sf_dir).orders.select(
        "order_id", day.alias("day"), month_of(day).alias("month")
    )
    old = visible_as_of(orders, "day", date(2000, 6, 15))
    new = orders.where(F.col("day") >= F.lit(date(1995, 2, 1)))
    prints = [
        dataset_fingerprint(df, ["order_id", "day"], {}, ["month"]) for df in (new, old)
    ]
    return changed_partitions(prints[0], prints[1], "month")


# --- metrics ------------------------------------------------------------


def roc_auc_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roc_auc(events_of(spark, sf_dir), "value", "label", ["event_type"])


def pr_auc_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr_auc(events_of(spark, sf_dir), "value", "label", ["event_type"])


def evaluate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(scored_orders(spark, sf_dir), "score", LABEL)


def evaluate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years without a late order have one class and no metric."""
    rows = scored_orders(spark, sf_dir).withColumn("year", F.year("month"))
    return evaluate(rows, "score", LABEL, ["year"])


def evaluate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return evaluate(documents.join(labels, "doc_id"), "n_chars", "quality", ["lang"])


def roc_curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roc_curve(events_of(spark, sf_dir), "value", "label", max_points=50)


def roc_curve_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roc_curve(events_of(spark, sf_dir), "value", "label", 20, ["event_type"])


LEAKAGE_COLUMNS = (*NUMERIC, "delivery_days")


def leakage_scan_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features next to a column from after the delivery, which must stand out."""
    delivered = labelled_orders(spark, sf_dir).select(
        F.col("order_id").alias("_order"),
        F.datediff("delivered_at", "purchase_date").alias("delivery_days"),
    )
    features = mart_order_features(features_layer(spark, sf_dir))
    rows = features.join(delivered, F.col("order_id") == F.col("_order"))
    return leakage_scan(rows, LEAKAGE_COLUMNS, LABEL)


# --- drift --------------------------------------------------------------


def feature_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSI of every numeric feature, with the deciles of the earlier sample as bins."""
    base, cur = time_split(features_layer(spark, sf_dir), "purchase_date", CUTOFF)
    return psi(base, cur, edges_map(bin_edges(base, NUMERIC)))


def psi_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_stability(spark, sf_dir)


def ks_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, cur = time_split(features_layer(spark, sf_dir), "purchase_date", CUTOFF)
    return ks(base, cur, NUMERIC)


def bin_edges_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = bin_edges(features_layer(spark, sf_dir), NUMERIC)
    return edges.select("feature", F.posexplode("edges").alias("position", "edge"))


def feature_skew_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving that fills unknown rates with zero and cuts prices to whole units."""
    rows = inference_mart(features_layer(spark, sf_dir))
    served = rows.withColumns(
        {
            "seller_late_rate_before": F.coalesce("seller_late_rate_before", F.lit(0.0)),
            "avg_price": F.floor("avg_price").cast("double"),
        }
    )
    return feature_skew(served, rows, "order_id", FEATURES)


def drift_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = features_layer(spark, sf_dir)
    base, cur = time_split(features, "purchase_date", CUTOFF)
    shifted = rate_shift(base, cur, LABEL).select(
        F.lit("positive_rate").alias("check"),
        F.lit(LABEL).alias("subject"),
        F.col("shift").alias("observed"),
    )
    return (
        feature_stability(spark, sf_dir)
        .select(
            F.lit("psi").alias("check"),
            F.col("feature").alias("subject"),
            F.col("psi").alias("observed"),
        )
        .unionByName(shifted)
    )


def drift_check_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = spark.createDataFrame(DRIFT_LIMITS, "check string, warn double, error double")
    return drift_checks(drift_statistics(spark, sf_dir), limits)


def drift_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of every day since the cutoff against the days before it, written as months."""
    features = features_layer(spark, sf_dir)
    base, cur = time_split(features, "purchase_date", CUTOFF)
    limits = spark.createDataFrame(DRIFT_LIMITS[:1], "check string, warn double, error double")
    months = sorted(row["month"] for row in cur.select("month").distinct().collect())  # bounded by the calendar
    out = run_dir(spark, "drift")
    edges = edges_map(bin_edges(base, NUMERIC))
    monitor_days(base, cur, edges, limits, out, months, "purchase_date", "month", feature_spec().categorical)
    return spark.read.parquet(out)


def drift_checks_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without limits for the positive rate, its check fails."""
    limits = spark.createDataFrame(DRIFT_LIMITS[:1], "check string, warn double, error double")
    return drift_checks(drift_statistics(spark, sf_dir), limits)


def prediction_monitoring_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, cur = time_split(formula_predictions(spark, sf_dir), "day", CUTOFF)
    limits = spark.createDataFrame(DRIFT_LIMITS, "check string, warn double, error double")
    return prediction_monitoring(base, cur, SCORE_EDGES, SCORE_CUTOFF, limits)


# --- gates --------------------------------------------------------------


def metrics_by_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_seeds(scored_orders(spark, sf_dir), "order_id", SEEDS, TEST_FRAC)
    return evaluate(rows, "score", LABEL, ["seed"])


def threshold_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate_threshold(metrics_by_seed(spark, sf_dir))


def quality_gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gate(evaluate_all(spark, sf_dir), 0.60, 0.50)


def champion_gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, holdout = hash_split(scored_orders(spark, sf_dir), "order_id", SEED, TEST_FRAC)
    return champion_gate(holdout, "score", "champion_score", LABEL, 0.60, 0.01)


def champion_gate_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A champion that scored no order of more than four items."""
    _, holdout = hash_split(scored_orders(spark, sf_dir), "order_id", SEED, TEST_FRAC)
    known = F.when(F.col("champion_score") - F.col("score") <= 40, F.col("champion_score"))
    rows = holdout.withColumn("champion_score", known)
    return champion_gate(rows, "score", "champion_score", LABEL, 0.60, 0.01)


# --- registry -----------------------------------------------------------


def version_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate per purchase month, identified by its number of orders."""
    orders = load_roles(spark, sf_dir).orders
    month = month_of(F.to_date("purchase_ts"))
    counts = orders.groupBy(month.alias("month")).agg(F.count("*").alias("n_orders"))
    return counts.select(
        F.lit("late_delivery").alias("name"),
        F.md5(F.concat_ws("|", F.date_format("month", "yyyy-MM-dd"), "n_orders")).alias(
            "fingerprint"
        ),
        F.concat(F.lit("models/"), F.date_format("month", "yyyy-MM")).alias("model_path"),
        F.col("month").cast("timestamp").alias("created_at"),
        F.lit("{}").alias("tags"),
    )


def registered_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = version_candidates(spark, sf_dir)
    known = candidates.where(F.col("created_at") < F.lit(CUTOFF))
    nothing = known.limit(0).withColumn("version", F.lit(None).cast("long"))
    return new_versions(nothing, known)


def register_version_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_versions(
        registered_versions(spark, sf_dir), version_candidates(spark, sf_dir)
    )


def alias_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type a promotion at noon of each week's first day, and version 2 again in week 4.

    Events of the first morning come before every switch.
    """
    events = events_of(spark, sf_dir)
    week = F.weekofyear("ts")
    return (
        events.groupBy(F.col("event_type").alias("name"), week.alias("week"))
        .agg((F.date_trunc("day", F.min("ts")) + F.expr("INTERVAL 12 HOURS")).alias("valid_from"))
        .select(
            "name",
            F.lit("champion").alias("alias"),
            F.when(F.col("week") == 4, 2).otherwise(F.col("week")).cast("long").alias("version"),
            "valid_from",
        )
    )


def alias_as_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_of(spark, sf_dir).select(
        "event_id", "ts", F.col("event_type").alias("name"), F.lit("champion").alias("alias")
    )
    return alias_as_of(events, alias_history(spark, sf_dir), "ts")


def current_alias_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_alias(alias_history(spark, sf_dir))


def rollback_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A promotion for every year of orders, then two rollbacks: each goes one promotion further back."""
    years = load_roles(spark, sf_dir).orders.select(F.year("purchase_ts").alias("year")).distinct()
    path = run_dir(spark, "rollbacks")
    known = sorted(row["year"] for row in years.collect())  # bounded by the calendar
    for version, year in enumerate(known, 1):
        promote(spark, path, "late_delivery", version, datetime(year, 12, 31))
    for day in (1, 2):
        rollback(spark, path, "late_delivery", datetime(known[-1] + 1, 1, day))
    return read_table(spark, path, ALIAS_SCHEMA).where(F.col("alias") == CHAMPION)


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(events_of(spark, sf_dir), ["user_id"], "ts", ["event_id"])


# --- feedback -----------------------------------------------------------


def formula_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of all orders, by version 1 until 1997 and version 2 after."""
    features = inference_mart(features_layer(spark, sf_dir))
    return features.select(
        "order_id",
        F.col("purchase_date").alias("day"),
        "month",
        F.when(F.year("purchase_date") < 1997, 1).otherwise(2).cast("long").alias("model_version"),
        (24100 - F.col("month_index") - 10 * F.col("n_items")).alias("score"),
    )


def settled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lateness of all orders and when it was settled: by delivery or by the promise, whichever came first."""
    return load_roles(spark, sf_dir).orders.select(
        "order_id", label_known_at().alias("known_at"), settled_label().alias(LABEL)
    )


def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_label_join(
        formula_predictions(spark, sf_dir),
        settled_orders(spark, sf_dir),
        "order_id",
        LABEL,
        LAG_DAYS,
        TODAY,
        known_at="known_at",
        month_col="month",
    )


def performance_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_performance(late_labels(spark, sf_dir), LABEL, by=["month", "model_version"])


def daily_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_of(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return model_performance(events, "label", "value", ["day", "event_type"])


def retrain_trigger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrain_triggers(
        daily_performance(spark, sf_dir), "roc_auc", 0.45, 10, 4, ["event_type"]
    )


BATCH_QUERIES: dict[str, Query] = {
    "mart_order_features": mart,
    "inference_mart": inference,
    "feature_origins": feature_origins,
    "mart_refresh": mart_refresh,
    "mart_refresh_reasons": mart_refresh_reasons,
    "late_rate_by_month": late_rate_by_month,
    "late_rate_by_day": late_rate_by_day,
    "visible_as_of": visible_orders,
    "lookup_join": lookup_join,
    "staged_cast": staged_cast,
    "cast_failures": staged_cast_failures,
    "hash_split": hash_split_rows,
    "time_split": time_split_counts,
    "training_window": training_window_rows,
    "training_dataset": training_dataset_rows,
    "sample_connected_counts": sample_connected_counts,
    "sample_orphans": sample_orphans,
    "cap_rows": cap_rows_small,
    "cap_rows_large": cap_rows_large,
    "dq_checks": dq_checks,
    "dq_stages": dq_stages,
    "dq_blocking": dq_blocking,
    "freshness": source_freshness,
    "duplicate_audit": duplicate_items,
    "dataset_fingerprint": fingerprint_orders,
    "fingerprint_repeated_keys": fingerprint_item_orders,
    "changed_partitions": changed_months,
    "roc_auc_by_type": roc_auc_by_type,
    "pr_auc_by_type": pr_auc_by_type,
    "evaluate": evaluate_all,
    "evaluate_by_year": evaluate_by_year,
    "evaluate_documents": evaluate_documents,
    "roc_curve": roc_curve_points,
    "roc_curve_by_type": roc_curve_by_type,
    "leakage_scan": leakage_scan_columns,
    "psi": psi_features,
    "ks": ks_features,
    "bin_edges": bin_edges_features,
    "feature_skew": feature_skew_served,
    "drift_checks": drift_check_rows,
    "drift_checks_gaps": drift_checks_gaps,
    "drift_by_day": drift_by_day,
    "prediction_monitoring": prediction_monitoring_rows,
    "threshold_calibration": threshold_calibration,
    "quality_gate": quality_gate_rows,
    "champion_gate": champion_gate_rows,
    "champion_gate_gaps": champion_gate_gaps,
    "register_version": register_version_rows,
    "alias_as_of": alias_as_of_events,
    "current_alias": current_alias_rows,
    "rollback_history": rollback_history,
    "latest_by": latest_events,
    "late_label_join": late_labels,
    "model_performance": performance_by_month,
    "retrain_triggers": retrain_trigger_rows,
}
