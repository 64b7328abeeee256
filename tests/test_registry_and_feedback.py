from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderflow.functions.labels import label_as_of
from orderflow.operators.feedback import late_label_join, model_performance, retrain_triggers
from orderflow.operators.gates import GateFailed, quality_gate
from orderflow.operators.registry import (
    ALIAS_SCHEMA,
    VERSION_SCHEMA,
    alias_as_of,
    current_alias,
    model_path_of,
    promote,
    read_table,
    register_version,
    resolve_versions,
    rollback,
    set_alias,
)

T0 = datetime(2024, 1, 1)


def test_registering_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "versions")
    assert register_version(spark, path, "m", "f1", "p1", T0) == (1, False)
    assert register_version(spark, path, "m", "f1", "p1b", T0) == (1, True)
    assert register_version(spark, path, "m", "f2", "p2", T0, {"sha": "x"}) == (2, False)
    assert register_version(spark, path, "other", "f2", "p3", T0) == (1, False)
    rows = read_table(spark, path, VERSION_SCHEMA).collect()
    assert sorted((r["name"], r["version"], r["tags"]) for r in rows) == [
        ("m", 1, "{}"), ("m", 2, '{"sha": "x"}'), ("other", 1, "{}")
    ]


def test_promote_and_rollback(spark, tmp_path):
    versions, aliases = str(tmp_path / "versions"), str(tmp_path / "aliases")
    for i in (1, 2):
        register_version(spark, versions, "m", f"f{i}", f"p{i}", T0)
    for i, version in enumerate((1, 2, 1)):
        set_alias(spark, aliases, "m", "champion", version, T0 + timedelta(days=i))
    set_alias(spark, aliases, "m", "challenger", 2, T0)
    history = read_table(spark, aliases, ALIAS_SCHEMA)
    now = {r["alias"]: r["version"] for r in current_alias(history).collect()}
    assert now == {"champion": 1, "challenger": 2}
    table = read_table(spark, versions, VERSION_SCHEMA)
    assert model_path_of(table, history, "m", "champion") == (1, "p1")
    with pytest.raises(LookupError):
        model_path_of(table, history, "m", "unknown")


def test_promote_asks_the_gate_and_rollback_goes_one_back(spark, tmp_path):
    aliases = str(tmp_path / "aliases")
    good = quality_gate(spark.createDataFrame([(0.8,)], "roc_auc double"), 0.6)
    poor = quality_gate(spark.createDataFrame([(0.5,)], "roc_auc double"), 0.6)
    promote(spark, aliases, "m", 1, T0, good)
    with pytest.raises(LookupError):
        rollback(spark, aliases, "m", T0 + timedelta(days=1))
    with pytest.raises(GateFailed):
        promote(spark, aliases, "m", 2, T0 + timedelta(days=1), poor)
    promote(spark, aliases, "m", 2, T0 + timedelta(days=2), good)
    assert rollback(spark, aliases, "m", T0 + timedelta(days=3)) == 1
    now = current_alias(read_table(spark, aliases, ALIAS_SCHEMA)).first()
    assert (now["alias"], now["version"]) == ("champion", 1)


def test_rollbacks_walk_back_and_the_future_waits(spark, tmp_path):
    aliases = str(tmp_path / "aliases")
    for version in (1, 2, 2, 3):
        promote(spark, aliases, "m", version, T0 + timedelta(days=version))
    assert rollback(spark, aliases, "m", T0 + timedelta(days=5)) == 2
    assert rollback(spark, aliases, "m", T0 + timedelta(days=6)) == 1
    with pytest.raises(LookupError):
        rollback(spark, aliases, "m", T0 + timedelta(days=7))
    promote(spark, aliases, "m", 4, T0 + timedelta(days=8))
    assert rollback(spark, aliases, "m", T0 + timedelta(days=9)) == 1
    promote(spark, aliases, "m", 9, datetime(2199, 1, 1))
    history = read_table(spark, aliases, ALIAS_SCHEMA)
    assert current_alias(history).first()["version"] == 1
    assert current_alias(history, datetime(2200, 1, 1)).first()["version"] == 9
    assert current_alias(history, T0 + timedelta(days=3)).first()["version"] == 3


def test_labels_settle_with_delivery_or_promise(spark):
    day = lambda d: datetime(2024, 1, d)
    rows = [(1, day(3), day(10)), (2, day(12), day(10)), (3, None, day(10)), (4, None, None), (5, day(20), day(25))]
    df = spark.createDataFrame(rows, "k int, delivered_at timestamp, estimated_at timestamp")

    def labels(today):
        return {r["k"]: r["y"] for r in df.select("k", label_as_of(today).alias("y")).collect()}

    assert labels(date(2024, 1, 2)) == {1: None, 2: None, 3: None, 4: None, 5: None}
    assert labels(date(2024, 1, 9)) == {1: 0, 2: None, 3: None, 4: None, 5: None}
    assert labels(date(2024, 1, 10)) == {1: 0, 2: 1, 3: 1, 4: None, 5: None}
    assert labels(date(2024, 2, 1)) == {1: 0, 2: 1, 3: 1, 4: None, 5: 0}


def test_alias_as_of_history(spark):
    history = spark.createDataFrame(
        [("m", "champion", 1, datetime(2024, 1, 2, 12), "set"),
         ("m", "champion", 2, datetime(2024, 1, 4), "set"),
         ("m", "champion", 3, datetime(2024, 1, 4), "set"),
         ("m", "champion", 1, datetime(2024, 1, 4, 6), "set")],
        ALIAS_SCHEMA,
    )
    times = {
        datetime(2024, 1, 2, 11): None, datetime(2024, 1, 2, 12): 1, datetime(2024, 1, 3, 23): 1,
        datetime(2024, 1, 4): 3, datetime(2024, 1, 4, 5, 59): 3, datetime(2024, 1, 4, 6): 1,
        datetime(2025, 6, 1): 1,
    }
    events = spark.createDataFrame(
        [("m", "champion", t) for t in times], "name string, alias string, ts timestamp"
    )
    got = {r["ts"]: r["version"] for r in alias_as_of(events, history, "ts").collect()}
    assert got == times


def test_alias_as_of_has_no_cross_join(spark):
    history = spark.createDataFrame([("m", "c", 1, T0, "set")], ALIAS_SCHEMA)
    events = spark.createDataFrame([("m", "c", T0)], "name string, alias string, ts timestamp")
    plan = alias_as_of(events, history, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_resolve_counts_repeated_candidates_once(spark):
    versions = spark.createDataFrame([("m", 4, "old", "p", T0, "{}")], VERSION_SCHEMA)
    candidates = spark.createDataFrame(
        [("m", "old", "p", T0, "{}"), ("m", "new", "p", T0, "{}"), ("m", "new", "p", T0, "{}")],
        "name string, fingerprint string, model_path string, created_at timestamp, tags string",
    )
    got = {(r["fingerprint"], r["version"], r["reused_existing"]) for r in
           resolve_versions(versions, candidates).collect()}
    assert got == {("old", 4, True), ("new", 5, False)}


def predictions(spark, tmp_path):
    df = spark.range(100).select(
        F.col("id").alias("order_id"),
        F.lit(1).cast("long").alias("model_version"),
        (F.col("id") / 100).alias("score"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("day"),
    )
    df.write.partitionBy("day").parquet(str(tmp_path / "pred"))
    schema = "order_id long, model_version long, score double, day date"
    return spark.read.schema(schema).parquet(str(tmp_path / "pred"))


def test_late_labels_wait_for_their_lag(spark, tmp_path):
    facts = spark.range(0, 100, 2).select(
        F.col("id").alias("order_id"), (F.col("id") % 4 == 0).cast("int").alias("y"),
        F.lit(datetime(2024, 1, 12)).alias("known_at"),
    )
    joined = late_label_join(
        predictions(spark, tmp_path), facts, "order_id", "y", 5, date(2024, 1, 12),
        known_at="known_at",
    )
    rows = joined.collect()
    assert {r["day"] for r in rows} == {date(2024, 1, d) for d in range(1, 8)}
    assert len(rows) == 35
    assert all((r["y"] is not None) == (r["order_id"] % 2 == 0) for r in rows)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    early = late_label_join(
        predictions(spark, tmp_path.joinpath("b")), facts, "order_id", "y", 5, date(2024, 1, 11),
        known_at="known_at",
    )
    assert early.where("y IS NOT NULL").count() == 0


def test_single_class_days_have_no_metric(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5, 1), ("a", 1, 0.4, 0), ("b", 1, 0.5, 0)],
        "day string, model_version int, score double, y int",
    )
    got = {r["day"]: r["roc_auc"] for r in model_performance(df, "y").collect()}
    assert got == {"a": 1.0, "b": None}


def performance(spark, values):
    rows = [("s", date(2024, 1, 1) + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, day date, auc double")


def fired(df):
    return [(r["day"].day, r["reason"]) for r in sorted(df.collect(), key=lambda r: r["day"])]


def test_long_degradation_fires_once_per_cooldown(spark):
    df = performance(spark, [0.5] * 10 + [0.9] * 10)
    got = fired(retrain_triggers(df, "auc", 0.7, 100, 4, ["series"]))
    assert got == [(1, "degradation"), (5, "degradation"), (9, "degradation")]


def test_schedule_fires_without_degradation_and_unknown_is_no_degradation(spark):
    df = performance(spark, [0.9, None] * 10)
    got = fired(retrain_triggers(df, "auc", 0.7, 7, 3, ["series"]))
    assert got == [(1, "schedule"), (8, "schedule"), (15, "schedule")]


def test_schedule_is_held_back_by_cooldown(spark):
    df = performance(spark, [0.9] * 5 + [0.1] + [0.9] * 14)
    got = fired(retrain_triggers(df, "auc", 0.7, 7, 5, ["series"]))
    assert got == [(1, "schedule"), (6, "degradation"), (15, "schedule")]
