"""Latest bar per symbol, as the tick a quote poller would publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.stamps import iso_text


def _cents(name: str) -> Column:
    """Two decimal places, half up on the decimal digits rather than on the binary value."""
    return F.round(F.col(name).cast("decimal(28,10)"), 2).cast("double")


def latest_bar(
    bars: DataFrame, day: Column | str, stamp: Column, ties: Sequence[str] = (), time: str = "bar_time"
) -> DataFrame:
    """Last bar of ``day`` per symbol; symbols without a bar that day give no row.

    ``bars`` has symbol, ``time``, open, high, low, close and volume. ``day`` limits
    the scan (a bar's time is filtered as it is stored, so the bound reaches the
    files). ``stamp`` is the event time to publish.
    """
    first = F.lit(day).cast("date") if isinstance(day, str) else day
    within = bars.where((F.col(time) >= first) & (F.col(time) < F.date_add(first, 1)))
    last = F.max_by(F.struct("open", "high", "low", "close", "volume"), F.struct(time, *ties)).alias("bar")
    rows = within.groupBy("symbol").agg(last).select("symbol", "bar.*")
    return rows.select(
        "symbol",
        _cents("close").alias("price"),
        _cents("open").alias("open"),
        _cents("high").alias("high"),
        _cents("low").alias("low"),
        F.col("volume").cast("bigint").alias("volume"),
        iso_text(stamp).alias("event_time"),
    )


def tick_json(ticks: DataFrame) -> Column:
    """The tick as the JSON text that goes on the topic; absent values stay as null keys, times are ISO text."""
    fields = [
        iso_text(F.col(field.name)).alias(field.name) if isinstance(field.dataType, T.TimestampType) else field.name
        for field in ticks.schema
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
