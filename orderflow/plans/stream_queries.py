"""Driver queries that run as streams until their input is read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.labels import label_known_at, settled_label
from orderflow.operators.staging import Field, stage
from orderflow.plans.catalog import Query, features_layer
from orderflow.plans.mart import LABEL, inference_mart
from orderflow.plans.model_queries import SCORED_AT, per_day, published
from orderflow.sources.layers import write_layer
from orderflow.sources.raw import read_raw
from orderflow.sources.roles import load_roles, table
from orderflow.streaming.closing import closable, run_and_close
from orderflow.streaming.ingest import append_stream, ingest_landing, ingest_log, read_landing
from orderflow.streaming.late import ingest_log_split, read_kind
from orderflow.streaming.monitors import stream_label_join, stream_positive_rate
from orderflow.streaming.scoring import current_predictions, score_stream
from orderflow.workspace import materialize, run_dir

#: The promise, after which every label is settled, and a day for the time of the purchase.
LAG = "1001 days"
#: Time of the markers that close a stream.
END = datetime(2100, 1, 1)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return read_landing(spark, sf_dir, schema, options={"pathGlobFilter": "events.parquet"})


def ingest_landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same folder; the second finds nothing new."""
    out, checkpoint = run_dir(spark, "landed"), run_dir(spark, "cursor")
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        landed = ingest_landing(
            spark, sf_dir, schema, checkpoint, out, options={"pathGlobFilter": "events.parquet"}
        )
    return landed.withColumn("ts", F.col("ts").cast("timestamp"))


def ingest_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that delivers every entry twice."""
    once = event_stream(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    twice = once.unionByName(event_stream(spark, sf_dir).select(*once.columns))
    out, checkpoint = run_dir(spark, "log"), run_dir(spark, "cursor")
    return ingest_log(twice, "event_id", "ts", "1 hour", checkpoint, out)


def stream_positive_rate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("label"),
    )
    events, markers = closable(event_stream(spark, sf_dir), run_dir(spark, "markers"), "ts")
    rates = stream_positive_rate(events.join(segment, "user_id", "left"), "ts", "label", "1 day")
    out, checkpoint = run_dir(spark, "rates"), run_dir(spark, "cursor")
    run_and_close(lambda: append_stream(rates, out, checkpoint), [markers], END, spark)
    return spark.read.schema(rates.schema).parquet(out)


def stream_label_join_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as predictions, settled labels as facts that arrive up to LAG later."""
    root = run_dir(spark, "landing")
    orders = load_roles(spark, sf_dir).orders.select(
        "order_id", "purchase_ts", label_known_at().alias("known_at"), settled_label().alias(LABEL)
    )
    written = write_layer(orders, root, "staging", "orders")
    predictions = written.select("order_id", "purchase_ts")
    facts = written.select("order_id", "known_at", LABEL)
    for name, df in (("predictions", predictions), ("facts", facts)):
        write_layer(df, root, "raw", name)
    scored, left = closable(
        read_landing(spark, f"{root}/raw/predictions", predictions.schema), run_dir(spark, "markers"), "purchase_ts", {"order_id": 0}
    )
    known, right = closable(
        read_landing(spark, f"{root}/raw/facts", facts.schema), run_dir(spark, "markers"), "known_at", {"order_id": 0}
    )
    joined = stream_label_join(scored, known, "order_id", "purchase_ts", "known_at", LAG, "1 day")
    out, checkpoint = run_dir(spark, "joined"), run_dir(spark, "cursor")
    run_and_close(lambda: append_stream(joined, out, checkpoint), [left, right], END, spark)
    return spark.read.schema(joined.schema).parquet(out)


def ingest_log_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in five deliveries: one entry in ten comes a delivery later, one in seven comes twice."""
    folder, out, checkpoint = (run_dir(spark, name) for name in ("deliveries", "log", "cursor"))
    part = F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    again = F.when(F.col("event_id") % 7 == 0, F.array(part, part + 1)).otherwise(F.array(part))
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    delivered = materialize(events.select("*", F.explode(again).alias("delivery")), "delivered", "delivery")
    schema = events.schema
    for n in range(6):
        delivered.where(F.col("delivery") == n).select(*schema.names).coalesce(1).write.mode("append").parquet(folder)
        ingest_log_split(read_landing(spark, folder, schema), "event_id", "ts", "1 day", checkpoint, out).awaitTermination()
    ledger = read_kind(spark, out, "ledger")
    written = [
        read_kind(spark, out, kind, schema).groupBy("batch_id").agg(F.count("*").alias(f"{kind}_rows"), F.sum("event_id").alias(f"{kind}_ids"))
        for kind in ("accepted", "late")
    ]
    for counts in written:
        ledger = ledger.join(counts, "batch_id", "left")
    return ledger


def score_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inference mart scored by the published champion in micro-batches of files."""
    registry = published(spark, sf_dir)
    rows = inference_mart(features_layer(spark, sf_dir)).drop("month")
    landing = run_dir(spark, "landing")
    rows.repartition(4, "order_id").write.parquet(landing)
    stream = read_landing(spark, landing, rows.schema, options={"maxFilesPerTrigger": 2})
    out, checkpoint = run_dir(spark, "predictions"), run_dir(spark, "cursor")
    score_stream(stream, registry, out, checkpoint, clock=lambda: SCORED_AT).awaitTermination()
    return per_day(current_predictions(spark.read.parquet(out)))


RAW_CUSTOMERS = [
    Field("c_custkey", "bigint"),
    Field("c_name", "string"),
    Field("c_nationkey", "int"),
    Field("c_acctbal", "decimal(12,2)"),
    Field("c_mktsegment", "string"),
]


def raw_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV, read back as strings and typed again."""
    folder = run_dir(spark, "csv")
    customers = table(spark, sf_dir, "customer")
    customers.write.option("header", True).csv(f"{folder}/customer.csv")
    return stage(read_raw(spark, folder, "customer", customers.columns), RAW_CUSTOMERS)


STREAM_QUERIES: dict[str, Query] = {
    "raw_to_staging": raw_to_staging,
    "ingest_landing": ingest_landing_rows,
    "ingest_log": ingest_log_rows,
    "ingest_log_late": ingest_log_late_rows,
    "stream_positive_rate": stream_positive_rate_rows,
    "stream_label_join": stream_label_join_rows,
    "score_stream": score_stream_rows,
}
