"""Tumbling-window curation and the newest of its revisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CURATED = (
    "batch_time",
    "symbol",
    "avg_price",
    "min_price",
    "max_price",
    "total_volume",
    "event_count",
    "latest_event_time",
)


def curate(ticks: DataFrame, width: str = "1 minute", extra: Sequence[str] = ()) -> DataFrame:
    """One row per (window, symbol), labelled with the end of the window.

    The average is the price sum over *all* rows of the group, null prices
    included. Rows without an event time belong to no window. Works on streams
    and on batches; in both, partial aggregation runs before the only shuffle, so
    a symbol or window with most of the rows costs one partial row per task.
    ``extra`` names further grouping columns (a batch id, for example).
    """
    grouped = ticks.groupBy(*extra, F.window("event_time", width).alias("span"), "symbol").agg(
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("event_count"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("price").alias("price_sum"),
        F.max("event_time").alias("latest_event_time"),
    )
    return grouped.select(
        *extra,
        F.col("span.end").alias("batch_time"),
        "symbol",
        (F.col("price_sum").cast("double") / F.col("event_count")).alias("avg_price"),
        "min_price",
        "max_price",
        "total_volume",
        "event_count",
        "latest_event_time",
    )


def current_revision(curated: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The newest revision per (window, symbol) of an update-mode sink."""
    rest = [name for name in curated.columns if name not in ("batch_time", "symbol", batch)]
    newest = F.max_by(F.struct(*rest), F.col(batch)).alias("newest")
    return curated.groupBy("batch_time", "symbol").agg(newest).select("batch_time", "symbol", "newest.*")
