"""The curation stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.curate import curate
from tickloom.sources.writers import BatchWriter

# Window width and lateness bound of the curation stream.
WINDOW = "1 minute"
WATERMARK = "2 minutes"

STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


def curated_stream(ticks: DataFrame, width: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Watermarked windows over streaming ticks; rows of windows already closed are dropped."""
    return curate(ticks.withWatermark("event_time", watermark), width)


def use_disk_state(spark) -> None:
    """Keep window state on local disk instead of the heap. Set before a query's first run."""
    spark.conf.set(*STATE_STORE)


def to_sink(
    rows: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "update", drain: bool = False
) -> DataStreamWriter:
    """Writer that hands each micro-batch to ``write``; ``drain`` stops after the available input.

    In update mode a group is written again whenever it changes, so the sink holds
    revisions; in append mode each window is written once, after it closes. The
    number of shuffle partitions is fixed by the first run on a checkpoint.
    """
    writer = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if drain else writer


def run_to_end(writer: DataStreamWriter) -> None:
    writer.start().awaitTermination()
