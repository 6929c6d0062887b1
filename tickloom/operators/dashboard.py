"""Frames behind the dashboard. All start from the newest 1000 price rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.latest import latest_per_key, newest_rows

RECENT_ROWS = 1000

# The columns of the price frames, in the order users see them.
PRICE_COLUMNS = (
    "symbol",
    "price",
    "open_price",
    "high_price",
    "low_price",
    "volume",
    "event_time",
    "inserted_at",
)


def recent_prices(prices: DataFrame, ties: Sequence[str], count: int = RECENT_ROWS) -> DataFrame:
    """Newest rows by insertion; ``ties`` columns are kept for the frames below."""
    return newest_rows(prices.select(*PRICE_COLUMNS, *ties), "inserted_at", count, ties)


def latest_prices(recent: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Latest recent row per symbol, without NULL symbols and without the insertion time."""
    named = recent.where(F.col("symbol").isNotNull())
    return latest_per_key(named, "symbol", "event_time", ties, PRICE_COLUMNS[:-1])


def latest_volumes(recent: DataFrame, ties: Sequence[str]) -> DataFrame:
    return latest_prices(recent, ties).select("symbol", "volume")


def price_lines(recent: DataFrame) -> DataFrame:
    return recent.select("symbol", "event_time", "price").orderBy("symbol", "event_time")


def headline_numbers(recent: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Tracked symbols, recent rows and the volume of the latest rows, as one row."""
    rank = F.struct(F.col("event_time").isNull(), F.col("event_time"), *ties)
    per_symbol = recent.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("row_count"), F.max_by("volume", rank).alias("volume")
    )
    named = F.col("symbol").isNotNull()
    return per_symbol.agg(
        F.count("symbol").alias("tracked_symbols"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("latest_records"),
        F.coalesce(F.sum(F.when(named, F.col("volume"))), F.lit(0)).cast("bigint").alias("total_volume"),
    )
