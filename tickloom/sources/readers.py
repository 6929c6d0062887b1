"""Message and table readers behind one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schemas import ENVELOPE_DDL


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    group_prefix: str | None = None,
    fail_on_data_loss: bool = True,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. Progress lives in the stream's checkpoint, not in a consumer group.

    ``min_partitions`` above the topic's own count splits its busiest partitions over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    return options


def kafka_messages(spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options) -> DataFrame:
    """Messages of one topic. A batch read starts at the earliest offset, as Spark requires."""
    if not streaming:
        options.setdefault("starting", "earliest")
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def file_messages(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    file_format: str = "parquet",
    ddl: str = ENVELOPE_DDL,
    files_per_trigger: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """The columns of the Kafka source from files, for replays and tests."""
    reader = (spark.readStream if streaming else spark.read).schema(ddl).format(file_format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def jdbc_options(
    url: str, user: str | None = None, password: str | None = None, driver: str | None = None
) -> dict[str, str]:
    options = {"url": url, "user": user, "password": password, "driver": driver}
    return {name: value for name, value in options.items() if value is not None}


def jdbc_table(
    spark: SparkSession,
    table: str,
    connection: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table over JDBC; filters, projections and limits are pushed to the database.

    Name a numeric or time ``split_column`` with ``bounds`` to read in parallel.
    """
    reader = spark.read.format("jdbc").options(**connection).option("dbtable", table).option("fetchsize", fetch_size)
    if split_column and bounds:
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


_SOURCES = {"kafka": kafka_messages, "files": file_messages, "jdbc": jdbc_table}


def source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Open a source by kind: ``kafka``, ``files`` or ``jdbc``."""
    if kind not in _SOURCES:
        raise ValueError(f"unknown source {kind!r}; known: {', '.join(sorted(_SOURCES))}")
    return _SOURCES[kind](spark, **options)
