"""Contiguous shards of equal bytes.

Rows are put in id order by range partitioning; each partition numbers its rows and sums their
sizes as it streams by. The totals of the partitions, one row each, give every partition the
bytes and rows before it. A row goes to the shard in whose equal part of all bytes its middle lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import in_arrow, stored_narrow
from tickloom.session import stored

# Bytes that a row takes besides its text (the length field of a record).
ROW_BYTES = 8

_PLACED = "id long, size long, crc long, part int, before long, place long"


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and rows of this partition that come before each row."""
    part = TaskContext.get().partitionId()
    total = count = 0
    for batch in batches:
        n = batch.num_rows
        size = batch.column("size").to_numpy(zero_copy_only=False)
        run = np.cumsum(size)
        columns = [pa.array(np.full(n, part, np.int32)), pa.array(total + run - size), pa.array(np.arange(count, count + n))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["id", "size", "crc", "part", "before", "place"])
        total, count = total + int(run[-1]) if n else total, count + n


def byte_shards(docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, shard, slot.

    Sizes of shards differ by at most the largest row. Slots count from 0 in each shard without gaps,
    in id order. Null text has no bytes and the checksum of no bytes; null ids come first; rows that
    repeat an id are ordered by checksum and size. A shard without rows is possible when there are few
    rows; no rows give no rows. A text of any length is measured by its own task; only its size and checksum
    move. Other columns are not looked at.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    raw = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    narrow = docs.select(
        F.col(id_column).cast("long").alias("id"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("crc"),
    )
    ordered = narrow.repartitionByRange("id", "crc", "size").sortWithinPartitions("id", "crc", "size")
    placed = stored(in_arrow(ordered, _along, _PLACED), "shard-rows")

    # One row per partition; the sums over all of them are the only step in one task.
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = stored_narrow(
        totals.select(
            "part",
            F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(everything).alias("all_bytes"),
        ),
        "shard-bases",
    )
    middle = "cast(2 * (bytes_before + before) + size as decimal(38, 0))"
    cut = placed.join(bases, "part").select(
        "id",
        "size",
        "crc",
        F.expr(f"least({shards - 1}, cast({middle} * {shards} div (2 * all_bytes) as int))").alias("shard"),
        (F.col("rows_before") + F.col("place")).alias("row"),
    )
    # As many rows as there are shards.
    firsts = F.broadcast(cut.groupBy("shard").agg(F.min("row").alias("first")))
    return cut.join(firsts, "shard").select(
        F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("first")).alias("slot")
    )
