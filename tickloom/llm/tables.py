"""Shared pieces: reading tables, byte views of text, splits by id."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import ship_package, stored

# A task works through a batch in slices of about this many bytes of text, so that
# one batch of very long texts does not set the memory of the task.
SLICE_BYTES = 4 << 20

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_column: str) -> Column:
    """True for the third of the ids that no model may learn from; False where the id is null."""
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with the UTF-8 bytes of their texts; null reads as no bytes."""
    size, start = 0, 0
    raw = batch.column(column).cast(pa.binary())
    for row in range(batch.num_rows):
        value = raw[row]
        size += len(value.as_buffer()) if value.is_valid else 0
        if size >= limit or row + 1 == batch.num_rows:
            part = batch.slice(start, row + 1 - start)
            texts = raw.slice(start, row + 1 - start).to_pylist()
            yield part, [text or b"" for text in texts]
            size, start = 0, row + 1


def in_arrow(rows: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package sent to the workers first.

    Rows that carry texts are long, so a session that has not chosen how many go in a batch gets
    ``ROWS_PER_BATCH``: batches are held on both sides, outside the executor's heap.
    """
    spark = ship_package(rows.sparkSession)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(ROWS_PER_BATCH))
    return rows.mapInArrow(function, schema)


# Files of a narrow table for each core of the cluster, at most.
FILES_PER_CORE = 4


def stored_narrow(rows: DataFrame, label: str) -> DataFrame:
    """``stored`` for ids and links: a few files per core, however many partitions a shuffle has."""
    return stored(rows.coalesce(FILES_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism), label)
