"""Tick-shaped frames over the test tables. Every row of a table becomes a row of the frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.stamps import at_micros, micros

TOPIC = "ticks"
CENTS = "decimal(18,2)"

# Deciding the payload shape of an event: the remainder of its id by this number.
PAYLOAD_CLASSES = 101

# Files of each part of a topic, so that a micro-batch is written and parsed by many tasks, and the bytes of
# their row groups, which are what a task reads at least.
LANES = 32
ROW_GROUP_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, table: str, max_bytes: int | None = None) -> DataFrame:
    """The same table as a stream, in micro-batches of at most about ``max_bytes`` when given.

    The path is a pattern, as the file source takes no path of a single file.
    """
    reader = spark.readStream.schema(read_table(spark, sf_dir, table).schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(f"{sf_dir}/{table}[.]parquet")


def _prices(event: DataFrame) -> DataFrame:
    """Price columns in exact cents, volume, and the event time as an instant."""
    price = F.col("value").cast(CENTS)
    spread = F.col("event_id") % 3
    k = F.get_json_object("props", "$.k").cast("bigint")
    return event.select(
        "event_id",
        F.upper("event_type").alias("symbol"),
        price.alias("price"),
        price.alias("open_price"),
        (price + spread).cast(CENTS).alias("high_price"),
        F.greatest(F.lit("0.01").cast(CENTS), (price - spread).cast(CENTS)).alias("low_price"),
        (k * 1000 + F.col("event_id") % 1000).alias("volume"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def _arrival(minutes: bool = False) -> Column:
    """Event time plus a spread of 0 to 299 seconds (or minutes), so arrivals come out of order."""
    unit = 60_000_000 if minutes else 1_000_000
    return at_micros(micros(F.col("event_time")) + F.col("event_id") * 37 % 300 * unit)


def _envelope() -> list[Column]:
    return [
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
    ]


def ticks(events: DataFrame, late_minutes: bool = False) -> DataFrame:
    """Price rows as the price table holds them, with envelope and insertion time."""
    return _prices(events).select("*", _arrival(late_minutes).alias("inserted_at"), *_envelope())


def heavy_ticks(lineitem: DataFrame) -> DataFrame:
    """Few symbols and many rows per day."""
    return lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_extendedprice").cast(CENTS).alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )


def bars(events: DataFrame) -> DataFrame:
    """One-minute bars with unrounded prices. The bar time stays as stored, so bounds on it reach the files."""
    value = F.col("value").cast("decimal(18,4)")
    eighth = (F.col("event_id") % 8 * F.lit("0.1255").cast("decimal(5,4)")).cast("decimal(18,4)")
    return events.select(
        F.upper("event_type").alias("symbol"),
        F.col("ts").alias("bar_time"),
        value.alias("open"),
        (value + eighth).alias("high"),
        (value - eighth).alias("low"),
        (value + eighth / 2).cast("decimal(18,4)").alias("close"),
        (F.get_json_object("props", "$.k").cast("bigint") * 1000).alias("volume"),
        "event_id",
    )


def symbol_lists(events: DataFrame) -> DataFrame:
    """Comma lists with blanks, tabs and empty entries."""
    extra = (
        F.when(F.col("event_id") % 3 == 0, F.lit(""))
        .when(F.col("event_id") % 3 == 1, F.lit("  "))
        .otherwise(F.concat(F.lit("\t"), "event_type", F.lit("_x ")))
    )
    listed = F.concat(F.lit(" "), "event_type", F.lit(" ,"), extra, F.lit(","), F.upper("event_type"))
    return events.select("event_id", listed.alias("symbols"))


def tick_messages(events: DataFrame, fast_clock: bool = False) -> DataFrame:
    """Envelope and JSON payload, some of them malformed by ``event_id % 101``.

    ``fast_clock`` replaces the arrival by one event per second.
    """
    rows = _prices(events)
    kind = F.col("event_id") % PAYLOAD_CLASSES

    def key(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}": '), value)

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    iso = F.concat(F.replace(F.col("event_time").cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))
    symbol = (
        F.when(kind == 6, F.lit('" \\t "'))
        .when(kind == 7, quoted(F.rpad("symbol", 25, "X")))
        .when(kind == 10, F.lit("null"))
        .otherwise(quoted(F.col("symbol")))
    )
    price = (
        F.when(kind == 4, F.lit('"abc"'))
        .when(kind == 9, quoted(F.col("price").cast("string")))
        .otherwise(F.col("price").cast("string"))
    )
    stamp = F.when(kind == 8, F.lit('"garbage"')).when(kind == 11, F.lit("null")).otherwise(quoted(iso))
    parts = F.concat_ws(
        ", ",
        key("symbol", symbol),
        key("price", price),
        F.when(kind != 3, key("open", F.col("open_price").cast("string"))),
        F.when(kind != 2, key("high", F.col("high_price").cast("string"))),
        key("low", F.col("low_price").cast("string")),
        F.when(kind != 3, key("volume", F.when(kind == 5, "null").otherwise(F.col("volume").cast("string")))),
        key("event_time", stamp),
    )
    payload = (
        F.when(kind == 0, F.concat(F.lit("{"), parts))
        .when(kind == 1, F.concat(F.lit("[{"), parts, F.lit("}]")))
        .otherwise(F.concat(F.lit("{"), parts, F.lit("}")))
    )
    epoch = micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    arrival = at_micros(epoch + F.col("event_id") * 1_000_000) if fast_clock else _arrival()
    return rows.select(*_envelope(), arrival.alias("arrival"), payload.cast("binary").alias("value"))


def in_parts(rows: DataFrame, clock: str, parts: int) -> DataFrame:
    """Rows with ``part``: which of ``parts`` equal stretches of the clock they came in."""
    low, high = rows.agg(F.min(micros(F.col(clock))), F.max(micros(F.col(clock)))).first()
    low, high = low or 0, high or 0
    edges = [low + (high - low + 1) * i // parts for i in range(1, parts)]
    past = [(micros(F.col(clock)) >= edge).cast("int") for edge in edges]
    return rows.withColumn("part", sum(past, F.lit(0)))


def write_topic(rows: DataFrame, folder: str) -> list[int]:
    """Write rows with a whole-number ``part`` as ``LANES`` files each, aged in that order.

    A stream that takes ``LANES`` files at a time sees every part as a batch of its own, in order, as it would
    on a live topic. Rows go to a lane by their hash; lanes without a row get a file without rows. The table is
    written in one pass. Gives the parts.
    """
    lane = F.pmod(F.xxhash64(*rows.columns), F.lit(LANES)).cast("int")
    laned = rows.withColumn("lane", lane).repartition("part", "lane")
    writer = laned.write.partitionBy("part", "lane").option("maxRecordsPerFile", 0)
    writer.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)
    spark = rows.sparkSession
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    files = hadoop.Path(folder).getFileSystem(conf)

    def found(pattern: str) -> list:
        return [status.getPath() for status in files.globStatus(hadoop.Path(pattern)) or []]

    def number(path) -> int:
        return int(path.getName().partition("=")[2])

    parts = sorted(number(path) for path in found(f"{folder}/part=*"))
    lanes = {(part, lane) for part in parts for lane in range(LANES)}
    lanes -= {(number(path.getParent()), number(path)) for path in found(f"{folder}/part=*/lane=*")}
    if lanes:
        blank = f"{folder}-blank"
        spark.createDataFrame([], rows.drop("part").schema).coalesce(1).write.parquet(blank)
        (without_rows,) = found(f"{blank}/*.parquet")
        for part, lane in sorted(lanes):
            place = hadoop.Path(f"{folder}/part={part}/lane={lane}/blank.parquet")
            hadoop.FileUtil.copy(files, without_rows, files, place, False, conf)
    for path in found(f"{folder}/part=*/lane=*/*.parquet"):
        files.setTimes(path, 1_600_000_000_000 + 1000 * number(path.getParent().getParent()), -1)
    return parts


def arrive(spark: SparkSession, staged: str, parts: list[int], folder: str, run: Callable[[], None]) -> None:
    """Move the parts of ``write_topic`` into ``folder`` one after the other and call ``run`` after each."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for part in parts:
        files.rename(path(f"{staged}/part={part}"), path(f"{folder}/part={part}"))
        run()


def topic_stream(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    """The parts of ``write_topic`` as a stream, one in each micro-batch."""
    reader = spark.readStream.schema(f"{ddl}, part int, lane int").option("maxFilesPerTrigger", LANES)
    return reader.parquet(folder).drop("part", "lane")
