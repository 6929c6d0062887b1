"""The tables of the pipeline in the catalog: written batch by batch, read as committed.

A job writes several tables for each micro-batch. Every one of them is partitioned by the day, the run (the id
of the streaming query) and the number of the batch; a row of ``commits`` is written last, and readers
take only batches that it names. So a batch that stopped half-way is invisible, one that runs again
replaces itself, and a query with a new checkpoint adds its batches beside those of the one before.

Users read the views: ``stock_prices``, ``dead_letter_events``, ``pipeline_metrics``, ``pipeline_alerts``,
``stock_prices_curated``, ``stock_prices_current``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The property under which Spark names the streaming query to the tasks and functions it runs.
QUERY_ID = "sql.streaming.queryId"
DIRECT = "direct"

BATCH_KEYS = ("day", "run", "batch_id")
_KEYS_DDL = "day DATE, run STRING, batch_id BIGINT"
_STAMP_DDL = "stamped_at TIMESTAMP DEFAULT current_timestamp()"

_PRICES = "symbol STRING, price DOUBLE, open_price DOUBLE, high_price DOUBLE, low_price DOUBLE, volume BIGINT, event_time TIMESTAMP"
_ENVELOPE = "topic STRING, `partition` INT, `offset` BIGINT, arrival TIMESTAMP"
_WINDOW = (
    "batch_time TIMESTAMP, symbol STRING, price_sum DOUBLE, min_price DOUBLE, max_price DOUBLE, "
    "total_volume BIGINT, event_count BIGINT, latest_event_time TIMESTAMP"
)

# Names and columns of the price, report, alert and curated tables that users know.
# Columns of each table, and the partitions that its rows choose themselves.
LOGS = {
    "ingested": (f"{_ENVELOPE}, status STRING, error_message STRING, payload STRING, {_PRICES}", "outcome STRING"),
    "latest": (f"{_PRICES}, {_ENVELOPE}", ""),
    "timed": (f"{_ENVELOPE}, payload STRING, symbol STRING, price DOUBLE, volume BIGINT, event_time TIMESTAMP", "outcome STRING"),
    "reports": (
        "topic STRING, metric_name STRING, metric_value DOUBLE, extra_data STRING, recorded_at TIMESTAMP, "
        "processed BIGINT, inserted BIGINT, failed BIGINT",
        "",
    ),
    "raised_alerts": ("topic STRING, pipeline STRING, reason STRING, summary STRING, raised_at TIMESTAMP", ""),
    "totals": ("topic STRING, processed BIGINT, inserted BIGINT, failed BIGINT, raised_at TIMESTAMP", ""),
    "curated": (
        "batch_time TIMESTAMP, symbol STRING, avg_price DOUBLE, min_price DOUBLE, max_price DOUBLE, "
        "total_volume BIGINT, event_count BIGINT, latest_event_time TIMESTAMP",
        "",
    ),
    "windows": (_WINDOW, "window_day DATE, part INT"),
    "window_heads": ("window_day DATE, part INT", ""),
}
_COMMITS = "day DATE, counts MAP<STRING, BIGINT>, committed_at TIMESTAMP DEFAULT current_timestamp()"

# Views by name: table, condition and columns; the stamp of a batch under the name that the users know.
_SERVED = {
    "stock_prices": (
        "ingested",
        "outcome = 'inserted'",
        "symbol, price, open_price, high_price, low_price, volume, event_time, stamped_at AS inserted_at, topic, `partition`, `offset`",
    ),
    "refused_messages": (
        "ingested",
        "outcome = 'dead'",
        "topic AS source_topic, `partition` AS source_partition, `offset` AS source_offset, error_message, payload, stamped_at AS created_at",
    ),
    "late_messages": (
        "timed",
        "outcome = 'late'",
        "topic AS source_topic, `partition` AS source_partition, `offset` AS source_offset, 'late' AS error_message, "
        "payload, stamped_at AS created_at",
    ),
    "pipeline_metrics": ("reports", "true", "metric_name, metric_value, extra_data, recorded_at, topic, processed, inserted, failed"),
    "pipeline_alerts": ("raised_alerts", "true", "pipeline, reason, summary, raised_at, topic"),
    "stock_prices_curated": (
        "curated",
        "true",
        "batch_time, symbol, avg_price, min_price, max_price, total_volume, event_count, latest_event_time, "
        "stamped_at AS inserted_at, run, batch_id",
    ),
}


@dataclass(frozen=True)
class PipelineTables:
    """The tables of one pipeline in a database; ``location`` holds them where the warehouse should not."""

    database: str
    location: str | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def create(self, spark: SparkSession) -> PipelineTables:
        """Create what does not exist yet: database, tables and views."""
        place = f" LOCATION '{self.location}'" if self.location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")
        for table, (columns, own) in LOGS.items():
            keys = f"{_KEYS_DDL}, {own}" if own else _KEYS_DDL
            names = ", ".join(part.split()[0] for part in keys.split(", "))
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}, {_STAMP_DDL}, {keys}) "
                f"USING parquet PARTITIONED BY ({names})"
            )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name('commits')} ({_COMMITS}, run STRING, batch_id BIGINT) "
            "USING parquet PARTITIONED BY (run, batch_id)"
        )
        for view, (table, condition, columns) in _SERVED.items():
            spark.sql(
                f"CREATE VIEW IF NOT EXISTS {self.name(view)} AS SELECT {columns} FROM ("
                f"SELECT w.* FROM {self.name(table)} w LEFT SEMI JOIN {self.name('commits')} c "
                f"ON w.day = c.day AND w.run = c.run AND w.batch_id = c.batch_id WHERE {condition})"
            )
        spark.sql(
            f"CREATE VIEW IF NOT EXISTS {self.name('dead_letter_events')} AS "
            f"SELECT * FROM {self.name('refused_messages')} UNION ALL SELECT * FROM {self.name('late_messages')}"
        )
        return self

    def read(self, spark: SparkSession, view: str) -> DataFrame:
        """A view as the users see it, with batches that other sessions have committed since."""
        for table in {"ingested", "timed"} if view == "dead_letter_events" else {_SERVED[view][0]}:
            spark.catalog.refreshTable(self.name(table))
        spark.catalog.refreshTable(self.name("commits"))
        return spark.table(self.name(view))

    def committed(self, spark: SparkSession, table: str) -> DataFrame:
        """The rows of a table that belong to committed batches, with the keys of their batch."""
        for name in (table, "commits"):
            spark.catalog.refreshTable(self.name(name))
        commits = spark.table(self.name("commits")).select(*BATCH_KEYS)
        return spark.table(self.name(table)).join(commits, list(BATCH_KEYS), "left_semi")

    def commits(self, spark: SparkSession) -> DataFrame:
        """(day, counts, committed_at, run, batch_id) of every committed batch."""
        spark.catalog.refreshTable(self.name("commits"))
        return spark.table(self.name("commits"))

    def batch(self, spark: SparkSession, number: int, stamp: dt.datetime | None = None) -> Batch:
        """The batch that a ``foreachBatch`` function is asked to write."""
        run = spark.sparkContext.getLocalProperty(QUERY_ID) or DIRECT
        stamp = stamp or dt.datetime.now(dt.timezone.utc)
        return Batch(self, spark, run, number, stamp if stamp.tzinfo else stamp.replace(tzinfo=dt.timezone.utc))


@dataclass(frozen=True)
class Batch:
    """One micro-batch of one run; all its rows carry the same stamp."""

    tables: PipelineTables
    spark: SparkSession
    run: str
    number: int
    stamp: dt.datetime

    @property
    def day(self) -> str:
        return self.stamp.astimezone(dt.timezone.utc).date().isoformat()

    def write(self, table: str, rows: DataFrame) -> None:
        """Put the rows in place of what an earlier try of this batch left, by column name.

        Columns that are not supplied get their default, or NULL.
        """
        own = [part.split()[0] for part in LOGS[table][1].split(", ") if part]
        known = self.spark.table(self.tables.name(table)).columns
        unknown = set(rows.columns) - set(known)
        if unknown:
            raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")
        keys = [f"day = DATE'{self.day}'", f"run = '{self.run}'", f"batch_id = {self.number}", *own]
        names = ", ".join(f"`{name}`" for name in [*rows.columns, "stamped_at"])
        stamped = rows.withColumn("stamped_at", F.lit(self.stamp))
        # Values come in the order of the names, partitions of the rows' own last.
        order = [*[n for n in stamped.columns if n not in own], *own]
        names = ", ".join(f"`{name}`" for name in order)
        self.spark.sql(
            f"INSERT OVERWRITE {self.tables.name(table)} PARTITION ({', '.join(keys)}) ({names}) SELECT {names} FROM {{rows}}",
            rows=stamped.select(*order),
        )

    def written(self, table: str) -> DataFrame:
        """What this batch has put into a table, committed or not."""
        rows = self.spark.table(self.tables.name(table))
        mine = (F.col("day") == F.lit(self.day).cast("date")) & (F.col("run") == self.run) & (F.col("batch_id") == self.number)
        return rows.where(mine).drop(*BATCH_KEYS)

    def before(self, table: str) -> DataFrame:
        """Rows of the committed batch before this one in the same run; none for the first."""
        rows = self.tables.committed(self.spark, table)
        return rows.where((F.col("run") == self.run) & (F.col("batch_id") == self.number - 1)).drop(*BATCH_KEYS)

    def counts_before(self) -> dict[str, int]:
        """Counts of the committed batch before this one in the same run; one row."""
        found = self.tables.commits(self.spark).where((F.col("run") == self.run) & (F.col("batch_id") == self.number - 1))
        row = found.select("counts").first()
        return dict(row["counts"]) if row else {}

    def commit(self, **counts: int | None) -> None:
        """Make the batch visible. A null count is left out."""
        given = ", ".join(f"'{name}', {int(value)}L" for name, value in counts.items() if value is not None)
        counted = f"map({given})" if given else "cast(map() as map<string, bigint>)"
        self.spark.sql(
            f"INSERT OVERWRITE {self.tables.name('commits')} PARTITION (run = '{self.run}', batch_id = {self.number}) "
            f"(day, counts) SELECT DATE'{self.day}', {counted}"
        )
