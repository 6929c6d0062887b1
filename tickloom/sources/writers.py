"""Sinks for batches and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.operators.bars import tick_json

BatchWriter = Callable[[DataFrame, int], None]


def batch_folder(folder: str, batch_id: int) -> str:
    return f"{folder}/batch_id={batch_id}"


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Write the rows of one micro-batch as a partition; a replay of the batch replaces its own rows only."""
    rows.write.mode("overwrite").parquet(batch_folder(folder, batch_id))


def read_if_there(spark: SparkSession, folder: str, ddl: str) -> DataFrame | None:
    """The rows of a parquet folder, or None where nothing was ever written."""
    try:
        return spark.read.schema(ddl).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_batches(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    """All rows of a sink; none where no micro-batch had any."""
    ddl = f"{ddl}, batch_id bigint"
    found = read_if_there(spark, folder, ddl)
    return spark.createDataFrame([], ddl) if found is None else found


def replayable(folder: str) -> BatchWriter:
    """``foreachBatch`` function: skip an empty batch, else write it under its batch id."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            if not rows.isEmpty():
                write_batch(rows, folder, batch_id)
        finally:
            rows.unpersist()

    return write


def jdbc_append(
    table: str,
    connection: dict[str, str],
    batch_size: int = 10_000,
    writers: int | None = None,
    batch_column: str | None = "batch_id",
) -> BatchWriter:
    """``foreachBatch`` function: append a non-empty batch over JDBC, many rows per statement.

    ``batch_column`` tells a replayed batch apart in the table; None leaves it out,
    for tables that do not have it. ``writers`` bounds the open connections.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            if not rows.isEmpty():
                out = rows.withColumn(batch_column, F.lit(batch_id).cast("bigint")) if batch_column else rows
                writer = out.write.format("jdbc").options(**connection).option("dbtable", table)
                writer = writer.option("batchsize", batch_size)
                if writers:
                    writer = writer.option("numPartitions", writers)
                writer.mode("append").save()
        finally:
            rows.unpersist()

    return write


def topic_rows(ticks: DataFrame, topic: str) -> DataFrame:
    """Ticks as topic, key and JSON value; the symbol as key keeps a symbol's ticks in one partition."""
    return ticks.select(
        F.lit(topic).alias("topic"), F.col("symbol").cast("string").alias("key"), tick_json(ticks).alias("value")
    )


def publish(ticks: DataFrame, servers: str, topic: str) -> None:
    """Send a batch of ticks to Kafka. Keys are left out, so a busy symbol spreads over all partitions."""
    rows = topic_rows(ticks, topic).select("topic", "value")
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def publish_stream(ticks: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    rows = topic_rows(ticks, topic).select("topic", "value")
    return (
        rows.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )


_SINKS = {"parquet": replayable, "jdbc": jdbc_append}


def sink(kind: str, **options) -> BatchWriter:
    """A ``foreachBatch`` function by kind: ``parquet`` or ``jdbc``."""
    if kind not in _SINKS:
        raise ValueError(f"unknown sink {kind!r}; known: {', '.join(sorted(_SINKS))}")
    return _SINKS[kind](**options)
