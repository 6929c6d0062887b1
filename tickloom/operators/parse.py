"""Message bytes to tick columns, as the window stream reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.stamps import iso_timestamp
from tickloom.schemas import TICK_DDL


def parse_ticks(messages: DataFrame, value: str = "value", ddl: str = TICK_DDL, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast, parse and flatten; malformed payloads and fields become NULL, never an error.

    ``ddl`` may name fewer fields, so that only those are converted. ``keep`` names
    envelope columns to carry along. The parsed struct goes through a one-row
    generator: a filter on a parsed field (the window adds one on ``event_time``)
    would otherwise be pushed below the projection and parse every payload again.
    """
    parsed = F.from_json(F.col(value).cast("string"), ddl)
    flat = messages.select(*keep, F.explode_outer(F.array(parsed)).alias("tick")).select(*keep, "tick.*")
    if "event_time" not in flat.columns:
        return flat
    return flat.withColumn("event_time", iso_timestamp(F.col("event_time")))
