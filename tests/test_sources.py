import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderflow.operators.staging import Field, cast_failures, stage
from orderflow.sources.layers import latest_by, read_layer, replace_partitions, write_layer
from orderflow.sources.raw import read_raw
from orderflow.workspace import run_dir, shared_dir

CSV = (
    "﻿order_id,note,amount,day\r\n"
    'a,"line one\nline two",1.50,2024-01-02 03:04:05\r\n'
    'b,"said ""yes""",,not a day\r\n'
    'c,"",12x,\r\n'
)


@pytest.fixture
def raw(spark, tmp_path):
    (tmp_path / "orders.csv").write_bytes(CSV.encode("utf-8"))
    return read_raw(spark, str(tmp_path), "orders", ["order_id", "note", "amount", "day"], line_breaks=True)


def test_raw_reads_everything_as_text(raw):
    rows = {r["order_id"]: r for r in raw.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"]["note"] == "line one\nline two"
    assert rows["b"]["note"] == 'said "yes"'
    assert rows["b"]["amount"] is None and rows["c"]["note"] is None
    assert {t for _, t in raw.dtypes} == {"string"}


SPEC = [
    Field("order_id", "string"),
    Field("amount", "decimal(12,2)"),
    Field("bought_at", "timestamp", raw="day", fmt="yyyy-MM-dd HH:mm:ss"),
]


def test_stage_types_and_counts_failures(raw):
    rows = {r["order_id"]: r for r in stage(raw, SPEC).collect()}
    assert float(rows["a"]["amount"]) == 1.5 and rows["c"]["amount"] is None
    assert rows["a"]["bought_at"] == datetime(2024, 1, 2, 3, 4, 5)
    failed = {r["column_name"]: r["n_failed"] for r in cast_failures(raw, SPEC).collect()}
    assert failed == {"order_id": 0, "amount": 1, "bought_at": 1}


def test_layer_write_replaces(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(5), root, "staging", "t")
    write_layer(spark.range(2), root, "staging", "t")
    assert read_layer(spark, root, "staging", "t").count() == 2
    with pytest.raises(ValueError):
        write_layer(spark.range(1), root, "nowhere", "t")


def day_rows(spark, rows):
    return spark.createDataFrame(rows, "order_id long, day date, score double")


def content(spark, path):
    df = spark.read.schema("order_id long, score double, day date").parquet(path)
    return sorted((r["order_id"], r["day"], r["score"]) for r in df.collect())


def test_replace_partitions_is_idempotent_and_empties_days(spark, tmp_path):
    path = str(tmp_path / "p")
    d1, d2, d3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    first = day_rows(spark, [(1, d1, 0.1), (2, d2, 0.2), (3, d3, 0.3)])
    assert replace_partitions(first, path, [d1, d2, d3]) == []
    once = content(spark, path)
    replace_partitions(first, path, [d1, d2, d3])
    assert content(spark, path) == once

    rerun = day_rows(spark, [(1, d1, 0.9), (9, d3, 0.9)])
    assert replace_partitions(rerun, path, [d1, d2]) == [d2]
    assert content(spark, path) == [(1, d1, 0.9), (3, d3, 0.3)]


def test_replace_partitions_may_be_all_empty(spark, tmp_path):
    path = str(tmp_path / "p")
    day = date(2024, 1, 1)
    replace_partitions(day_rows(spark, [(1, day, 0.1)]), path, [day])
    assert replace_partitions(day_rows(spark, []), path, [day]) == [day]
    assert not os.path.exists(f"{path}/day=2024-01-01")


def test_latest_by_breaks_ties(spark):
    rows = [("o", 1, "2024-01-01", 1, 0.1), ("o", 1, "2024-01-02", 1, 0.2),
            ("o", 1, "2024-01-02", 2, 0.3), ("o", 2, "2024-01-01", 1, 0.4)]
    df = spark.createDataFrame(rows, "order_id string, model_version int, at string, batch int, score double")
    got = latest_by(df, ["order_id", "model_version"], "at", ["batch"])
    assert got.columns == df.columns
    assert sorted(r["score"] for r in got.collect()) == [0.3, 0.4]


def test_shared_folder_is_stable_and_runs_are_new(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert run_dir(spark, "x") != run_dir(spark, "x")
    assert run_dir(spark, "x").startswith(shared_dir(spark))


def test_month_partitions_prune(spark, tmp_path):
    df = spark.range(90).select(
        "id", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("day")
    ).withColumn("month", F.trunc("day", "MM"))
    table = write_layer(df, str(tmp_path), "marts", "m", ["month"])
    plan = table.where(F.col("month") == F.lit(date(2024, 2, 1)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text
    assert plan.count() == 29
