"""Curation into a maintained table: late ticks are kept, windows are merged bucket by bucket.

A stream with window state drops ticks of closed windows without a trace, and its update mode leaves every
revision for the reader to sort out. Here each micro-batch is routed by the watermark of the batch before:
ticks of windows that it closed go to the dead letters as ``late``. The others are summed up by window
and merged with what the table holds. The table is cut into buckets by day of the window and hash of the
symbol; only buckets that the batch touches are read and written again, as a new version that the
batch names in ``window_heads`` and that counts once the batch is committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.stamps import at_micros, micros
from tickloom.operators.curate import CURATED
from tickloom.session import stored, work_scope
from tickloom.sources.tables import BATCH_KEYS, Batch, PipelineTables
from tickloom.sources.writers import BatchWriter
from tickloom.streaming.ingest import Stamp
from tickloom.streaming.windows import WATERMARK, WINDOW

# Buckets of a day of windows: more for tables with very many symbols, so that a batch rewrites less.
# The first batch settles them for the table.
PARTS = 4

ON_TIME, LATE, UNTIMED = "on_time", "late", "untimed"

_BUCKET = ("window_day", "part")
_STATE = ("batch_time", "symbol", "price_sum", "min_price", "max_price", "total_volume", "event_count", "latest_event_time")


def _span(width: str) -> Column:
    """Length of an interval such as ``1 minute`` in microseconds."""
    return F.expr(f"unix_micros(timestamp_micros(0) + interval {width})")


def window_end(time: Column, width: str) -> Column:
    """End of the tumbling window that a time lies in."""
    return at_micros(micros(time) - F.pmod(micros(time), _span(width)) + _span(width))


def routed(ticks: DataFrame, mark: int | None, width: str, watermark: str) -> DataFrame:
    """Ticks with ``outcome``: late where the watermark below ``mark`` (microseconds) has closed their window."""
    closed = F.lit(False)
    if mark is not None:
        closed = micros(window_end(F.col("event_time"), width)) <= F.lit(mark) - _span(watermark)
    outcome = F.when(F.col("event_time").isNull(), UNTIMED).when(closed, LATE).otherwise(ON_TIME)
    return ticks.withColumn("outcome", outcome)


def partial_windows(ticks: DataFrame, width: str, parts: int = PARTS) -> DataFrame:
    """One row per (window, symbol) with sums that can be merged, and its bucket."""
    grouped = ticks.groupBy(window_end(F.col("event_time"), width).alias("batch_time"), "symbol").agg(
        F.sum("price").alias("price_sum"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("event_count"),
        F.max("event_time").alias("latest_event_time"),
    )
    return grouped.withColumns(
        {"window_day": F.col("batch_time").cast("date"), "part": F.pmod(F.xxhash64("symbol"), F.lit(parts)).cast("int")}
    )


def merged_windows(held: DataFrame, fresh: DataFrame) -> DataFrame:
    """Windows of both sides added up; ``changed`` marks those that ``fresh`` had a part in."""
    both = held.withColumn("changed", F.lit(False)).unionByName(fresh.withColumn("changed", F.lit(True)))
    return both.groupBy("batch_time", "symbol", *_BUCKET).agg(
        F.sum("price_sum").alias("price_sum"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("event_count").alias("event_count"),
        F.max("latest_event_time").alias("latest_event_time"),
        F.max("changed").alias("changed"),
    )


def _curated(windows: DataFrame) -> DataFrame:
    return windows.withColumn("avg_price", F.col("price_sum") / F.col("event_count")).select(*CURATED)


def _held(tables: PipelineTables, spark: SparkSession, before: Batch | None = None) -> DataFrame:
    """The newest committed version of every bucket; ``before`` leaves out what that batch and later ones wrote."""
    heads = tables.committed(spark, "window_heads")
    if before:
        heads = heads.where((F.col("run") != before.run) | (F.col("batch_id") < before.number))
    version = F.max_by(F.struct(*BATCH_KEYS), F.struct("stamped_at", "batch_id")).alias("version")
    newest = heads.groupBy(*_BUCKET).agg(version).select(*_BUCKET, "version.*")
    spark.catalog.refreshTable(tables.name("windows"))
    rows = spark.table(tables.name("windows")).join(newest, [*BATCH_KEYS, *_BUCKET], "left_semi")
    return rows.select(*_STATE, *_BUCKET)


def current_windows(tables: PipelineTables, spark: SparkSession) -> DataFrame:
    """One curated row per window and symbol as of the last committed batch."""
    return _curated(_held(tables, spark))


def _layout(tables: PipelineTables, spark: SparkSession, width: str, parts: int) -> dict[str, int]:
    """Length of a window and buckets of a day, as commits record them.

    Windows merge only with those of the same length in the same bucket, so a layout
    other than the one the table was begun with is refused.
    """
    begun = [F.max(F.try_element_at("counts", F.lit(name))).alias(name) for name in ("width", "parts")]
    row = tables.commits(spark).agg(*begun).select("*", _span(width).alias("span")).first()
    asked = {"width": row["span"], "parts": parts}
    for name, value in asked.items():
        if row[name] not in (None, value):
            raise ValueError(f"the table of windows was begun with {name} {row[name]}, not {value}")
    return asked


def merge_batch(
    tables: PipelineTables, width: str = WINDOW, watermark: str = WATERMARK, parts: int = PARTS, stamp: Stamp | None = None
) -> BatchWriter:
    """``foreachBatch`` function over parsed ticks with their envelope and payload.

    The ticks are written once, by outcome, and counted on the way; windows come from what was written. A
    batch that runs again starts from the versions before it, so nothing is added twice. ``stock_prices_curated``
    gets the changed windows, as update mode gives them. One query at a time may write to these tables, and
    all of them with the same ``width`` and ``parts``.
    """
    layout: dict[str, int] = {}

    def write(ticks: DataFrame, batch_id: int) -> None:
        spark = ticks.sparkSession
        if not layout:
            layout.update(_layout(tables, spark, width, parts))
        batch = tables.batch(spark, batch_id, stamp and stamp(batch_id))
        mark = batch.counts_before().get("mark")
        seen = Observation()
        each = [F.count(F.when(F.col("outcome") == name, 1)).alias(name) for name in (ON_TIME, LATE, UNTIMED)]
        rows = routed(ticks, mark, width, watermark)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("messages"), *each, F.max(micros(F.col("event_time"))).alias("mark"))
        batch.write("timed", rows.withColumn("payload", F.when(F.col("outcome") == LATE, F.col("payload"))))
        counts = seen.get
        with work_scope(spark):
            on_time = batch.written("timed").where(F.col("outcome") == ON_TIME)
            fresh = stored(partial_windows(on_time, width, parts), "fresh")
            touched = stored(fresh.select(*_BUCKET).distinct(), "touched")
            held = _held(tables, spark, before=batch).join(touched, list(_BUCKET), "left_semi")
            merged = stored(merged_windows(held, fresh), "merged")
            # One file for each bucket.
            batch.write("windows", merged.select(*_STATE, *_BUCKET).repartition(*_BUCKET))
            batch.write("window_heads", touched)
            batch.write("curated", _curated(merged.where("changed")))
        marks = [m for m in (mark, counts.pop("mark")) if m is not None]
        batch.commit(**counts, **layout, mark=max(marks, default=None))

    return write
