"""Micro-batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderflow.operators.scoring import Registry, predictions_of
from orderflow.sources.layers import latest_by


def score_stream(
    stream: DataFrame,
    registry: Registry,
    out: str,
    checkpoint: str,
    key: str = "order_id",
    day_col: str = "purchase_date",
    interval: str | None = None,
    alias: str = "champion",
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> StreamingQuery:
    """Score new rows batch by batch into `out`, one folder per batch.

    Each batch looks up the version behind the alias when it starts and is marked with that time, so a
    promotion takes effect with the next batch. A batch replayed after a failure has the same id and rows and
    overwrites its own folder. Without `interval` all available input is scored and the
    query ends; with it the query goes on, e.g. every '1 hour'.
    """
    loaded: dict[int, PipelineModel] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        version, path = registry.behind_alias(batch.sparkSession, alias)
        if version not in loaded:
            loaded.clear()
            loaded[version] = PipelineModel.load(path)
        rows = predictions_of(loaded[version], batch, key, day_col, version, clock())
        rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(out)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def current_predictions(
    predictions: DataFrame, keys: Sequence[str] = ("order_id", "model_version")
) -> DataFrame:
    """One row per key and version: the newest by `scored_at`, then by batch."""
    return latest_by(predictions, keys, "scored_at", ["batch_id"])
