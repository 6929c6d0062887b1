"""Positions and running counts over a whole topic, without a window over a whole topic."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ingest import INSERTED, INVALID
from tickloom.session import ship_package, stored

ARRIVAL_ORDER = ("arrival", "partition", "offset")

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def _good() -> Column:
    return F.coalesce((F.col("status") == INSERTED).cast("bigint"), F.lit(0))


def _running(columns: Sequence[str]):
    """Arrow function: the named columns become their running sums through the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(columns, 0)
        for batch in batches:
            arrays = dict(zip(batch.schema.names, batch.columns))
            for name in columns:
                along = np.cumsum(batch.column(name).to_numpy()) + totals[name]
                totals[name] = int(along[-1]) if len(along) else totals[name]
                arrays[name] = pa.array(along, pa.int64())
            yield pa.RecordBatch.from_pydict(arrays)

    return run


def numbered(
    rows: DataFrame,
    order: Sequence[str] = ARRIVAL_ORDER,
    key: str = "topic",
    carry: DataFrame | None = None,
    slice_rows: int | None = None,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``processed``, the position of each row in the ``order`` of its ``key``, from 1, and running ``sums``.

    The ``order`` columns are unique per key. The rows are range-partitioned on their
    whole order, so no key, time or burst can make a slice larger than its fair share.
    That is the only shuffle: rows are numbered, and their ``sums`` (whole numbers, by new name) run
    along, within their sorted slice as it is written; what the slices before it add up to is added on
    reading, from one row per key and slice. Written slices also keep their numbers when an executor is lost.
    ``carry`` (key, processed, and the names of the sums) tells where to go on from. ``slice_rows`` sets the
    size of a slice, at the price of a count; else the shuffle partitions of the session do.

    The input is read twice, for the bounds and the rows: hand in stored or persisted rows, not a plan
    that still has to parse messages. A row without a key is kept and gets no position and no sums.
    """
    sums = dict(sums or {})
    columns = [name for name in rows.columns if name not in sums]
    valued = rows.select(*columns, *[F.coalesce(value.cast("bigint"), F.lit(0)).alias(name) for name, value in sums.items()])
    slices_wanted = [] if slice_rows is None else [1 + rows.count() // slice_rows]
    in_order = valued.repartitionByRange(*slices_wanted, key, *order).sortWithinPartitions(key, *order)
    in_order = in_order.withColumn("row_id", F.monotonically_increasing_id())
    if sums:
        ship_package(rows.sparkSession)
        # Each sum a second time: the value itself is needed to find what lies before the first row of a key.
        in_order = in_order.select("*", *[F.col(name).alias(f"own_{name}") for name in sums])
        in_order = in_order.mapInArrow(_running(list(sums)), in_order.schema)
    slices = stored(
        in_order.withColumns(
            {
                "slice": F.shiftright("row_id", _ROW_BITS).cast("int"),
                "row": F.col("row_id").bitwiseAND(F.lit(2**_ROW_BITS - 1)) + 1,
            }
        ).drop("row_id"),
        "slices",
    )
    # Numbers run through a slice whatever the key; take off what lies before the key's first row.
    totals = slices.groupBy(key, "slice").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("row").alias("first"),
        *[F.sum(f"own_{name}").alias(f"all_{name}") for name in sums],
        *[F.min_by(F.col(name) - F.col(f"own_{name}"), F.col("row")).alias(f"skip_{name}") for name in sums],
    )
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)

    def earlier(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    bases = totals.select(
        key,
        "slice",
        (earlier("rows") - F.col("first") + 1).alias("base_processed"),
        *[(earlier(f"all_{name}") - F.col(f"skip_{name}")).alias(f"base_{name}") for name in sums],
    )
    counted = ["processed", *sums]
    if carry is not None:
        start = carry.select(key, *[F.col(name).alias(f"from_{name}") for name in counted])
        bases = bases.join(start, key, "left").select(
            key, "slice", *[(F.col(f"base_{n}") + F.coalesce(f"from_{n}", F.lit(0))).alias(f"base_{n}") for n in counted]
        )
    # Stored, so that the planner knows its real size: a broadcast while it is small, a merge join beyond.
    bases = stored(bases, "slice_totals")
    return slices.join(bases, [key, "slice"], "left").select(
        *columns,
        (F.col("base_processed") + F.col("row")).alias("processed"),
        *[(F.col(f"base_{name}") + F.col(name)).alias(name) for name in sums],
    )


def running_counters(
    outcomes: DataFrame,
    order: Sequence[str] = ARRIVAL_ORDER,
    key: str = "topic",
    carry: DataFrame | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Cumulative processed, inserted and failed counts per ``key``, at every row.

    ``outcomes`` needs ``key``, the ``order`` columns and ``status``; see ``numbered``.
    ``carry`` holds the counts per key to start from (an earlier micro-batch).
    """
    counted = numbered(outcomes, order, key, carry, slice_rows, {"inserted": _good()})
    return counted.withColumn("failed", F.col("processed") - F.col("inserted"))


def report_points(
    outcomes: DataFrame,
    every: int,
    order: Sequence[str] = ARRIVAL_ORDER,
    key: str = "topic",
    carry: DataFrame | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """The counts at every ``every``-th row of a key, unless that row failed validation."""
    counted = running_counters(outcomes, order, key, carry, slice_rows)
    due = counted.where((F.col("processed") % every == 0) & (F.col("status") != INVALID))
    return due.select(key, order[0], "processed", "inserted", "failed")


def total_counts(outcomes: DataFrame, key: str = "topic", carry: DataFrame | None = None) -> DataFrame:
    """Final counts per key, on top of ``carry``."""
    counts = outcomes.groupBy(key).agg(F.count(F.lit(1)).alias("processed"), F.sum(_good()).alias("inserted"))
    if carry is not None:
        both = counts.unionByName(carry.select(key, "processed", "inserted"))
        counts = both.groupBy(key).agg(F.sum("processed").alias("processed"), F.sum("inserted").alias("inserted"))
    return counts.select(key, "processed", "inserted", (F.col("processed") - F.col("inserted")).alias("failed"))
