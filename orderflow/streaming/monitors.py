"""Streaming positive rate and streaming join with late labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.streaming.closing import CLOSES, is_row
from orderflow.streaming.ingest import with_event_time


def stream_positive_rate(stream: DataFrame, ts_col: str, label: str, delay: str) -> DataFrame:
    """Rows, positives and rate per day, emitted once the watermark has passed the day.

    Rows later than `delay` behind the newest one are not counted any more. The markers of a
    closable stream (`closing.closable`) only move the watermark.
    """
    row = is_row(stream)
    return (
        with_event_time(stream, ts_col)
        .withWatermark(ts_col, delay)
        .groupBy(F.window(ts_col, "1 day"))
        .agg(
            F.count_if(row).alias("n_rows"),
            F.sum(F.when(row, F.col(label).cast("long"))).alias("n_positive"),
            F.avg(F.when(row, F.col(label).cast("double"))).alias("positive_rate"),
        )
        .where("n_rows > 0")
        .select(
            F.to_date("window.start").alias("day"), "n_rows", "n_positive", "positive_rate"
        )
    )


def stream_label_join(
    predictions: DataFrame,
    facts: DataFrame,
    key: str,
    pred_ts: str,
    fact_ts: str,
    max_lag: str,
    delay: str,
) -> DataFrame:
    """Predictions with a fact of the same key at most `max_lag` later, else NULLs.

    Both sides carry a watermark, so state is held for `max_lag` + `delay` of
    predictions; an unmatched prediction comes out when its time is over. Markers of closable
    inputs meet nothing and are left out.
    """
    p = with_event_time(predictions, pred_ts).withWatermark(pred_ts, delay)
    f = with_event_time(facts.withColumnRenamed(key, "_key"), fact_ts).withWatermark(
        fact_ts, delay
    )
    condition = (
        (F.col(key) == F.col("_key"))
        & (F.col(fact_ts) >= F.col(pred_ts))
        & (F.col(fact_ts) <= F.col(pred_ts) + F.expr(f"INTERVAL {max_lag}"))
    )
    joined = p.join(f.drop(CLOSES), condition, "leftOuter").drop("_key")
    if CLOSES not in joined.columns:
        return joined
    # A condition on both sides is judged behind the join; on one it would be pushed below the
    # watermark and hide the marker from it.
    told = F.concat_ws("|", F.col(CLOSES).cast("string"), F.col(fact_ts).cast("string"))
    return joined.where(~told.startswith("true")).drop(CLOSES)
