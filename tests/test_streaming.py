from datetime import date, datetime

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from orderflow.operators.checks import duplicate_audit
from orderflow.operators.registry import promote, register_version
from orderflow.operators.scoring import Registry
from orderflow.streaming.ingest import (
    append_stream,
    ingest_landing,
    ingest_log,
    parse_entries,
    read_landing,
)
from orderflow.streaming.monitors import stream_label_join, stream_positive_rate
from orderflow.streaming.scoring import current_predictions, score_stream

SCHEMA = "event_id long, ts timestamp_ntz, y int"


def land(spark, folder, rows, schema=SCHEMA):
    """One more file in a landing folder."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def struct(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema).schema


def test_landing_files_are_read_once(spark, tmp_path):
    landing, cursor, out = (str(tmp_path / n) for n in ("landing", "cursor", "out"))
    args = (spark, landing, struct(spark), cursor, out)
    land(spark, landing, [(1, at(1), 0), (2, at(1), 1)])
    assert ingest_landing(*args).count() == 2
    assert ingest_landing(*args).count() == 2
    land(spark, landing, [(3, at(2), 0)])
    assert sorted(r["event_id"] for r in ingest_landing(*args).collect()) == [1, 2, 3]


def test_log_drops_repeats_across_restarts(spark, tmp_path):
    landing, cursor, out = (str(tmp_path / n) for n in ("landing", "cursor", "out"))

    def run():
        stream = read_landing(spark, landing, struct(spark))
        return sorted(r["event_id"] for r in ingest_log(
            stream, "event_id", "ts", "2 days", cursor, out).collect())

    land(spark, landing, [(1, at(1, 1), 0), (1, at(1, 2), 0), (2, at(1, 3), 1)])
    assert run() == [1, 2]
    land(spark, landing, [(2, at(1, 4), 1), (3, at(1, 5), 1)])  # 2 again, out of order
    assert run() == [1, 2, 3]


def test_entries_of_a_message_bus_are_parsed(spark):
    raw = spark.createDataFrame([(b'{"event_id": 7, "y": 1}',), (b"broken",)], "value binary")
    rows = parse_entries(raw, struct(spark, "event_id long, y int")).collect()
    assert [(r["event_id"], r["y"]) for r in rows] == [(7, 1), (None, None)]


def test_late_rows_are_dropped_and_days_close(spark, tmp_path):
    landing, cursor, out = (str(tmp_path / n) for n in ("landing", "cursor", "out"))

    def run():
        stream = read_landing(spark, landing, struct(spark))
        rates = stream_positive_rate(stream, "ts", "y", "1 day")
        append_stream(rates, out, cursor).awaitTermination()
        rows = spark.read.schema(rates.schema).parquet(out).collect()
        return {r["day"]: (r["n_rows"], r["n_positive"]) for r in rows}

    land(spark, landing, [(1, at(1, 5), 1), (2, at(2, 5), 0), (3, at(1, 9), 0), (4, at(5), 1)])
    closed = {date(2024, 1, 1): (2, 1), date(2024, 1, 2): (1, 0)}
    assert run() == closed
    land(spark, landing, [(5, at(1, 7), 1), (6, at(4, 1), 1), (7, at(8), 0)])  # 5 is too late
    assert run() == {**closed, date(2024, 1, 4): (1, 1), date(2024, 1, 5): (1, 1)}


def test_unmatched_predictions_come_out_when_their_time_is_over(spark, tmp_path):
    cursor, out = str(tmp_path / "cursor"), str(tmp_path / "out")
    p_schema, f_schema = "order_id long, pred_at timestamp", "order_id long, known_at timestamp, y int"

    def run():
        joined = stream_label_join(
            read_landing(spark, str(tmp_path / "p"), struct(spark, p_schema)),
            read_landing(spark, str(tmp_path / "f"), struct(spark, f_schema)),
            "order_id", "pred_at", "known_at", "5 days", "1 day",
        )
        append_stream(joined, out, cursor).awaitTermination()
        rows = spark.read.schema(joined.schema).parquet(out).collect()
        return {r["order_id"]: r["y"] for r in rows}

    land(spark, tmp_path / "p", [(1, at(1)), (2, at(1)), (3, at(10))], p_schema)
    land(spark, tmp_path / "f", [(1, at(4), 1), (9, at(3), 0)], f_schema)
    assert run() == {1: 1}
    land(spark, tmp_path / "p", [(4, at(20))], p_schema)
    land(spark, tmp_path / "f", [(3, at(18), 1), (4, at(21), 0)], f_schema)  # 3 is beyond 5 days
    assert run() == {1: 1, 2: None, 3: None, 4: 0}


@pytest.fixture(scope="module")
def model(spark):
    df = spark.range(200).select(
        (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 > 5).cast("int").alias("y")
    )
    stages = [VectorAssembler(inputCols=["x"], outputCol="features"),
              LogisticRegression(labelCol="y", maxIter=5)]
    return Pipeline(stages=stages).fit(df)


def test_micro_batches_score_each_row_once(spark, tmp_path, model):
    landing, cursor, out = (str(tmp_path / n) for n in ("landing", "cursor", "out"))
    schema = "order_id long, purchase_date date, x double"
    registry = Registry(str(tmp_path / "versions"), str(tmp_path / "aliases"), "m")
    model.write().save(str(tmp_path / "model"))
    for n in range(1, 5):
        register_version(spark, registry.versions_path, "m", f"f{n}", str(tmp_path / "model"), at(1))
    promote(spark, registry.aliases_path, "m", 3, at(1))

    def run():
        stream = read_landing(spark, landing, struct(spark, schema),
                              options={"maxFilesPerTrigger": 1})
        score_stream(stream, registry, out, cursor).awaitTermination()
        return spark.read.parquet(out)

    land(spark, landing, [(1, date(2024, 1, 1), 1.0), (2, date(2024, 1, 1), 9.0)], schema)
    land(spark, landing, [(3, date(2024, 1, 2), 5.0)], schema)
    assert run().count() == 3
    assert run().count() == 3
    land(spark, landing, [(2, date(2024, 1, 1), 9.0)], schema)  # the order is sent again
    table = run()
    assert {r["model_version"] for r in table.collect()} == {3}
    assert duplicate_audit(table, ["order_id", "model_version"]).count() == 1
    assert current_predictions(table).count() == 3
    promote(spark, registry.aliases_path, "m", 4, at(2))
    land(spark, landing, [(9, date(2024, 1, 3), 2.0)], schema)
    assert {(r["order_id"], r["model_version"]) for r in run().where("order_id >= 3").collect()} == {(3, 3), (9, 4)}
    assert table.where("scored_at is null").count() == 0
