"""The ingest stream: one pass over the messages, several tables, one commit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.counters import report_points, total_counts
from tickloom.operators.dashboard import PRICE_COLUMNS
from tickloom.operators.health import REPORT_EVERY, alert_candidates, alerts, health_reports
from tickloom.operators.ingest import INSERTED, INVALID, LOAD_FAILED
from tickloom.operators.latest import latest_per_key
from tickloom.session import stored, work_scope
from tickloom.sources.tables import Batch, PipelineTables

# The row that is the newest of its symbol, whatever batch it came in.
LATEST_TIES = ("arrival", "partition", "offset")
LATEST_COLUMNS = (*PRICE_COLUMNS[:-1], "topic", *LATEST_TIES)

STATUSES = (INSERTED, INVALID, LOAD_FAILED)

Stamp = Callable[[int], dt.datetime]


def ingest_batch(tables: PipelineTables, health: bool = True, stamp: Stamp | None = None):
    """``foreachBatch`` function for a classified stream: prices and dead letters, with ``health`` reports and alerts.

    One write, partitioned by outcome, takes all rows and counts them on the way, so messages are parsed
    once and payloads are not cached. The newest row of every symbol is set aside for ``latest_snapshot``, and
    health reads the narrow columns of what was written. Counts and the
    cooldown go on from the totals of the committed batch before, so they survive restarts. ``stamp``
    gives the time of writing by batch, if not the clock.
    """

    def write(classified: DataFrame, batch_id: int) -> None:
        batch = tables.batch(classified.sparkSession, batch_id, stamp and stamp(batch_id))
        seen = Observation()
        each = [F.count(F.when(F.col("status") == status, 1)).alias(status) for status in STATUSES]
        good = F.col("status") == INSERTED
        rows = classified.observe(seen, F.count(F.lit(1)).alias("messages"), *each)
        rows = rows.withColumns(
            {
                "payload": F.when(~good, F.col("payload")),
                "outcome": F.when(good, F.lit("inserted")).otherwise("dead"),
            }
        )
        batch.write("ingested", rows)
        written = batch.written("ingested").where(F.col("outcome") == "inserted")
        batch.write("latest", latest_per_key(written, "symbol", "event_time", LATEST_TIES, LATEST_COLUMNS))
        if health:
            with work_scope(batch.spark):
                _write_health(batch)
        batch.commit(**seen.get)

    return write


def latest_snapshot(tables: PipelineTables, spark: SparkSession) -> DataFrame:
    """Latest price row per symbol, from the newest rows that each committed batch set aside.

    Reads one row per symbol and batch instead of all history; batches committed later are seen on the next read.
    """
    return latest_per_key(tables.committed(spark, "latest"), "symbol", "event_time", LATEST_TIES, LATEST_COLUMNS)


def _write_health(batch: Batch) -> None:
    carry = stored(batch.before("totals"), "carry")
    last = carry.where(F.col("raised_at").isNotNull())
    outcomes = batch.written("ingested").select("topic", "arrival", "partition", "offset", "status")
    reports = stored(health_reports(report_points(outcomes, REPORT_EVERY, carry=carry)), "reports")
    raised = stored(alerts(stored(alert_candidates(reports), "candidates"), last_alerts=last), "raised")
    batch.write("reports", reports)
    batch.write("raised_alerts", raised)
    marks = raised.select("topic", "raised_at").unionByName(last.select("topic", "raised_at"))
    latest = marks.groupBy("topic").agg(F.max("raised_at").alias("raised_at"))
    batch.write("totals", total_counts(outcomes, carry=carry).join(latest, "topic", "left"))
