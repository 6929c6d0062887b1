import pytest
from pyspark.sql.streaming import DataStreamReader

from tickloom.session import work_folder
from tickloom.sources import readers, writers


def test_kafka_options():
    assert readers.kafka_options("h:1", "ticks") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "ticks",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    more = readers.kafka_options("h:1", "ticks", max_per_trigger=1000, group_prefix="g", fail_on_data_loss=False, min_partitions=64)
    assert more["minPartitions"] == "64"
    assert (more["maxOffsetsPerTrigger"], more["groupIdPrefix"], more["failOnDataLoss"]) == ("1000", "g", "false")


def test_kafka_reads_ask_for_the_connector(spark):
    """Without the connector jar Spark names what is missing; with it the same call works."""
    for streaming in (True, False):
        with pytest.raises(Exception, match="(?i)kafka"):
            readers.source(spark, "kafka", servers="h:1", topic="t", streaming=streaming)


def test_file_source_in_batch_and_stream(spark):
    folder = work_folder(spark, "files")
    spark.sql(
        "SELECT 't' topic, 1 partition, 2L offset, TIMESTAMP'2026-01-01' timestamp, CAST('{}' AS BINARY) value"
    ).write.parquet(folder)
    assert readers.source(spark, "files", path=folder, streaming=False).first().offset == 2
    stream = readers.source(spark, "files", path=folder, files_per_trigger=1, pattern="*.parquet")
    assert stream.isStreaming and isinstance(spark.readStream, DataStreamReader)


def test_unknown_kinds(spark):
    with pytest.raises(ValueError, match="unknown source"):
        readers.source(spark, "ftp")
    with pytest.raises(ValueError, match="unknown sink"):
        writers.sink("ftp")
    assert callable(writers.sink("parquet", folder="/x"))
    assert callable(writers.sink("jdbc", table="t", connection=readers.jdbc_options("jdbc:x")))


def test_jdbc_options():
    assert readers.jdbc_options("jdbc:x", user="u") == {"url": "jdbc:x", "user": "u"}


def test_replayed_write_replaces_its_batch(spark):
    folder = work_folder(spark, "batches")
    for batch, size in ((0, 3), (1, 4), (1, 4)):
        writers.write_batch(spark.range(size), folder, batch)
    counts = {r.batch_id: r["count"] for r in writers.read_batches(spark, folder, "id bigint").groupBy("batch_id").count().collect()}
    assert counts == {0: 3, 1: 4}
