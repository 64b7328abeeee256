"""Log ingest that keeps and counts what comes late.

Every micro-batch is judged by a watermark of its own, which a ledger records: the newest time of
all earlier batches less the delay. Entries behind it go to a table of late entries, the others,
without repeats, to the log. Each batch writes folders of its own in all tables, so a batch that is
replayed after a failure writes the same rows to the same place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderflow.sources.layers import latest_by
from orderflow.streaming.ingest import with_event_time

LEDGER = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("watermark", T.TimestampType()),
        T.StructField("newest", T.TimestampType()),
        T.StructField("n_delivered", T.LongType()),
        T.StructField("n_accepted", T.LongType()),
        T.StructField("n_repeated", T.LongType()),
        T.StructField("n_late", T.LongType()),
    ]
)
_KINDS = ("accepted", "late", "ledger")


def read_kind(spark: SparkSession, out: str, kind: str, schema: T.StructType | None = None) -> DataFrame:
    """One of the tables below `out`: 'accepted', 'late' (the columns of the log) or 'ledger'."""
    if kind not in _KINDS:
        raise ValueError(f"unknown table {kind!r}, expected one of {_KINDS}")
    shape = LEDGER if kind == "ledger" else T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    path = f"{out}/{kind}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(path)


def split_batch(batch: DataFrame, batch_id: int, key: str, ts_col: str, delay: str, out: str) -> None:
    """Write one micro-batch: accepted entries, late ones, and its line of the ledger.

    A repeat has the key and the time of an accepted entry, so those at or after the watermark are
    all that can be repeated. An entry without a time is late, as nothing can place it; one without a key is
    never a repeat.
    """
    spark = batch.sparkSession
    schema = batch.schema
    earlier = read_kind(spark, out, "ledger").where(F.col("batch_id") < batch_id)
    mark = earlier.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]
    kept = batch.persist()
    try:
        in_time = F.col(ts_col).isNotNull()
        if mark is not None:
            in_time = in_time & (F.col(ts_col) >= F.lit(mark))
        known = read_kind(spark, out, "accepted", schema).where(F.col("batch_id") < batch_id)
        if mark is not None:
            known = known.where(F.col(ts_col) >= F.lit(mark))
        on_time = kept.where(in_time)
        named = latest_by(on_time.where(F.col(key).isNotNull()), [key], ts_col)
        fresh = named.join(known.select(key), key, "left_anti").unionByName(on_time.where(F.col(key).isNull()))

        def write(df: DataFrame, kind: str) -> None:
            df.write.mode("overwrite").parquet(f"{out}/{kind}/batch_id={batch_id}")

        write(fresh.select(*schema.names), "accepted")
        write(kept.where(~in_time), "late")
        counts = kept.agg(F.count("*").alias("n"), F.count_if(~in_time).alias("late"), F.max(ts_col).alias("newest")).first()
        accepted = spark.read.schema(schema).parquet(f"{out}/accepted/batch_id={batch_id}").count()
        line = (mark, counts["newest"], counts["n"], accepted, counts["n"] - counts["late"] - accepted, counts["late"])
        write(spark.createDataFrame([line], T.StructType(LEDGER.fields[1:])).coalesce(1), "ledger")
    finally:
        kept.unpersist()


def ingest_log_split(stream: DataFrame, key: str, ts_col: str, delay: str, checkpoint: str, out: str) -> StreamingQuery:
    """Ingest what the stream has into the tables below `out`; every entry delivered is accepted, repeated or late."""

    def write(batch: DataFrame, batch_id: int) -> None:
        split_batch(batch, batch_id, key, ts_col, delay, out)

    return (
        with_event_time(stream, ts_col)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
