"""The pipeline's jobs, from messages to tables. ``messages`` has the columns of the Kafka source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.bars import tick_json
from tickloom.operators.ingest import classify
from tickloom.operators.parse import parse_ticks
from tickloom.sources.tables import PipelineTables
from tickloom.sources.writers import BatchWriter
from tickloom.streaming.ingest import Stamp, ingest_batch
from tickloom.streaming.merge import PARTS, merge_batch
from tickloom.streaming.windows import WATERMARK, WINDOW, curated_stream, to_sink

# The part of a tick that curation reads; the other fields are not converted.
CURATION_FIELDS = "symbol STRING, price DOUBLE, volume BIGINT, event_time STRING"


def curation_job(
    messages: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    width: str = WINDOW,
    watermark: str = WATERMARK,
    drain: bool = False,
    mode: str = "update",
) -> DataStreamWriter:
    """Messages to per-minute rows in update mode; ``start()`` it and wait, or ``drain`` what is there.

    ``write`` is a ``curated_batch`` of the pipeline's tables, or any other sink.
    """
    ticks = parse_ticks(messages, ddl=CURATION_FIELDS)
    return to_sink(curated_stream(ticks, width, watermark), write, checkpoint, mode, drain)


def curated_batch(tables: PipelineTables, stamp: Stamp | None = None) -> BatchWriter:
    """``foreachBatch`` function: the windows that a batch changed, as rows of ``stock_prices_curated``."""

    def write(rows: DataFrame, batch_id: int) -> None:
        batch = tables.batch(rows.sparkSession, batch_id, stamp and stamp(batch_id))
        batch.write("curated", rows)
        batch.commit()

    return write


def merged_curation_job(
    messages: DataFrame,
    tables: PipelineTables,
    checkpoint: str,
    width: str = WINDOW,
    watermark: str = WATERMARK,
    drain: bool = False,
    stamp: Stamp | None = None,
    parts: int = PARTS,
) -> DataStreamWriter:
    """Messages to a maintained table of windows; late ones go to the dead letters. See ``streaming.merge``."""
    received = _received(messages).withColumn("payload", F.col("value").cast("string"))
    ticks = parse_ticks(received, ddl=CURATION_FIELDS, keep=("topic", "partition", "offset", "arrival", "payload"))
    return to_sink(ticks, merge_batch(tables, width, watermark, parts, stamp), checkpoint, "append", drain)


def ingest_job(
    messages: DataFrame,
    tables: PipelineTables,
    checkpoint: str,
    health: bool = True,
    drain: bool = False,
    stamp: Stamp | None = None,
) -> DataStreamWriter:
    """Messages to prices, dead letters, health reports and alerts."""
    return to_sink(classify(_received(messages)), ingest_batch(tables, health, stamp), checkpoint, "append", drain)


def _received(messages: DataFrame) -> DataFrame:
    return messages.select("topic", "partition", "offset", F.col("timestamp").alias("arrival"), "value")


def as_messages(ticks: DataFrame, topic: str, order: str, partitions: int = 4) -> DataFrame:
    """Generated ticks as messages of the file source, numbered by their whole-number ``order`` column."""
    body = ticks.drop(order)
    return ticks.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.col(order), F.lit(partitions)).cast("int").alias("partition"),
        F.expr(f"{order} div {partitions}").alias("offset"),
        F.col("event_time").alias("timestamp"),
        tick_json(body).cast("binary").alias("value"),
    )
