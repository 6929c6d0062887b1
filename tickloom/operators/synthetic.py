"""Synthetic ticks for load tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.stamps import at_micros, micros

# The default symbols and the ranges of the generated fields.
SYMBOLS = ("AAPL", "MSFT", "GOOGL", "TSLA", "NVDA")
PRICE_CENTS = (5000, 50000)
SPREAD_CENTS = 200
VOLUMES = (1000, 5_000_000)


def _draw(digest: Column, place: int, low: int, high: int) -> Column:
    """Whole number in [low, high] from six hex digits of a digest."""
    digits = F.conv(F.substring(digest, 1 + 6 * place, 6), 16, 10).cast("bigint")
    return F.floor(digits * F.lit(high - low + 1) / F.lit(16**6)).cast("bigint") + F.lit(low)


def draw_ticks(
    ids: DataFrame,
    column: str = "id",
    symbols: Sequence[str] = SYMBOLS,
    seed: int = 0,
    start: str = "2024-01-01 00:00:00",
    step_micros: int = 1_000,
) -> DataFrame:
    """One tick per id. Symbols take turns by id; the numbers come from a hash of seed and id.

    The same id gives the same tick however the ids are partitioned or re-read.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(column).cast("string")))
    drawn = ids.select(F.col(column).alias("id"), digest.alias("digest")).select(
        "id",
        _draw(F.col("digest"), 0, *PRICE_CENTS).alias("price"),
        _draw(F.col("digest"), 1, 0, SPREAD_CENTS).alias("under"),
        _draw(F.col("digest"), 2, 0, SPREAD_CENTS).alias("over"),
        _draw(F.col("digest"), 3, 0, SPREAD_CENTS).alias("depth"),
        _draw(F.col("digest"), 4, *VOLUMES).alias("volume"),
    )
    turn = (F.pmod(F.col("id"), F.lit(len(symbols))) + 1).cast("int")
    dollars = [
        ("price", F.col("price")),
        ("open", F.col("price") - F.col("under")),
        ("high", F.col("price") + F.col("over")),
        ("low", F.greatest(F.lit(1), F.col("price") - F.col("depth"))),
    ]
    return drawn.select(
        "id",
        F.element_at(F.array(*[F.lit(s) for s in symbols]), turn).alias("symbol"),
        *[(cents / F.lit(100.0)).alias(name) for name, cents in dollars],
        "volume",
        at_micros(micros(F.lit(start).cast("timestamp")) + F.col("id") * step_micros).alias("event_time"),
    )


def synthetic_ticks(spark: SparkSession, count: int, **options) -> DataFrame:
    return draw_ticks(spark.range(count), "id", **options)
