"""Reporting views over the price and curated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.stamps import seconds_between
from tickloom.operators.dashboard import PRICE_COLUMNS
from tickloom.operators.latest import latest_in_history, latest_per_key


def latest_view(prices: DataFrame, ties: Sequence[str] = (), long: bool = False) -> DataFrame:
    """Latest price row per symbol over all history; NULL times win, NULL symbols are one group.

    ``long`` says that ``prices`` is a table of long history: it is read twice instead of sorted.
    """
    latest = latest_in_history if long else latest_per_key
    return latest(prices, "symbol", "event_time", ties, PRICE_COLUMNS)


def curated_view(curated: DataFrame, ordered: bool = True) -> DataFrame:
    """Every curated row and revision, newest window first (the symbol settles equal windows)."""
    rows = curated.select(
        "symbol",
        "batch_time",
        "avg_price",
        "min_price",
        "max_price",
        "total_volume",
        "event_count",
        "latest_event_time",
        "inserted_at",
    )
    return _newest_first(rows) if ordered else rows


def latency_view(curated: DataFrame, ordered: bool = True) -> DataFrame:
    """Slack between the newest event of a window and the end of the window, in seconds."""
    slack = seconds_between(F.col("batch_time"), F.col("latest_event_time"))
    rows = curated.select(
        "symbol", "batch_time", "latest_event_time", slack.alias("latency_seconds"), "inserted_at"
    )
    return _newest_first(rows) if ordered else rows


def _newest_first(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc_nulls_first("batch_time"), "symbol")


def register_views(
    spark: SparkSession, prices: DataFrame, curated: DataFrame, ties: Sequence[str] = ()
) -> list[str]:
    """Make the three views known to SQL in this session."""
    frames = {
        "vw_stock_latest": latest_view(prices, ties),
        "vw_stock_curated_recent": curated_view(curated),
        "vw_stock_latency": latency_view(curated),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
