"""Latest row per key and newest rows overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys share this many bounds: an array of 128 KiB, whatever the number of keys.
BOUNDS = 1 << 14


def latest_per_key(
    rows: DataFrame, key: str, time: str, ties: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``time`` per key; a NULL time outranks every other.

    NULL keys form one group. Rows with equal times are told apart by the greatest
    ``ties``. An aggregate, not a ranked window: each task ships one row per key
    instead of all history, so a key with most of the rows is no hot spot.
    """
    rank = F.struct(F.col(time).isNull(), F.col(time), *ties)
    newest = F.max_by(F.struct(*[c for c in columns if c != key]), rank).alias("newest")
    return rows.groupBy(key).agg(newest).select(key, "newest.*").select(*columns)


def latest_in_history(
    rows: DataFrame, key: str, time: str, ties: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``latest_per_key`` of a long table, which is read twice and must give the same rows both times.

    ``latest_per_key`` sorts what it reads, because whole rows do not fit a hash aggregate. Here a hash
    aggregate over key and time alone comes first, and only rows not older than its bounds are sorted:
    about one per key, as long as keys are not many times more than ``BOUNDS``. Beyond that more rows
    pass, and the result is the same. Both reads belong to one query, so newer rows are seen by the next.
    """
    bound = F.get(_bounds(rows, key, time).scalar(), _slot(key))
    return latest_per_key(rows.filter(F.col(time).isNull() | (F.col(time) >= bound)), key, time, ties, columns)


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BOUNDS)).cast("int")


def _bounds(rows: DataFrame, key: str, time: str) -> DataFrame:
    """One array: per slot, the oldest of the newest times of its keys.

    No row older than that is the latest of its key. Where a key has a NULL time, that row is the latest,
    and rows with NULL pass anyway: such a key sets no bound.
    """
    newest = rows.groupBy(key).agg(F.max(time).alias("newest"), F.max(F.col(time).isNull()).alias("open"))
    own = newest.groupBy(_slot(key).alias("slot")).agg(F.min(F.when(~F.col("open"), F.col("newest"))).alias("bound"))
    slots = rows.sparkSession.range(BOUNDS).select(F.col("id").cast("int").alias("slot"))
    full = slots.join(own, "slot", "left").agg(F.sort_array(F.collect_list(F.struct("slot", "bound"))).alias("all"))
    return full.select(F.col("all.bound").alias("bounds"))


def newest_rows(rows: DataFrame, time: str, count: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``count`` rows with the greatest ``time``: a top-k, each task keeps at most ``count`` rows."""
    return rows.orderBy(F.desc_nulls_first(time), *[F.desc(c) for c in ties]).limit(count)
