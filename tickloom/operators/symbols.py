"""Comma-separated symbol lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EDGES = r"(?U)^\s+|\s+$"


def split_symbols(lists: DataFrame, column: str, keep: tuple[str, ...] = (), drop_blank: bool = True) -> DataFrame:
    """One row per list entry: all surrounding white space stripped, upper case, blanks dropped on request."""
    parts = lists.select(*keep, F.posexplode(F.split(column, ",")).alias("position", "part"))
    cleaned = parts.select(*keep, "position", F.upper(F.regexp_replace("part", _EDGES, "")).alias("symbol"))
    return cleaned.where(F.col("symbol") != "") if drop_blank else cleaned
