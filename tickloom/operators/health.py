"""Health reports at every Nth message, and the alerts they call for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.cooldown import cooled_instants
from tickloom.operators.ingest import INVALID

# Reporting step, thresholds, cooldown and the texts written out.
REPORT_EVERY = 50
FAILURE_THRESHOLD = 10
SUCCESS_RATIO_MIN = 0.90
COOLDOWN_SECONDS = 120
METRIC_NAME = "consumer_success_ratio"
TOO_MANY_FAILURES = "failure-threshold-reached"
LOW_RATIO = "success-ratio-below-threshold"

PIPELINE = "tick-consumer"


def _ratio_4dp() -> Column:
    """inserted / processed rounded half up to 4 places in whole numbers, so it never depends on binary digits."""
    tenths = F.expr("(inserted * 20000 + processed) div (2 * processed)")
    return F.when(F.col("processed") > 0, tenths.cast("double") / F.lit(10000.0)).otherwise(F.lit(0.0))


def _summary() -> Column:
    summary = F.struct("processed", "inserted", "failed", "topic", _ratio_4dp().alias("success_ratio"))
    return F.to_json(summary, {"ignoreNullFields": "false"})


def due_rows(counters: DataFrame, every: int = REPORT_EVERY) -> DataFrame:
    """Rows of running counters at which a report is due.

    A message that fails validation skips the report at its position; one that fails
    at load does not.
    """
    return counters.where((F.col("processed") % every == 0) & (F.col("status") != INVALID))


def health_reports(due: DataFrame, clock: str = "arrival") -> DataFrame:
    """One metric row per due row (``due_rows`` or ``report_points``)."""
    return due.select(
        "topic",
        F.lit(METRIC_NAME).alias("metric_name"),
        F.when(F.col("processed") > 0, F.col("inserted") / F.col("processed"))
        .otherwise(F.lit(0.0))
        .alias("metric_value"),
        _summary().alias("extra_data"),
        F.col(clock).alias("recorded_at"),
        "processed",
        "inserted",
        "failed",
    )


def alert_candidates(
    reports: DataFrame, failures: int = FAILURE_THRESHOLD, ratio: float = SUCCESS_RATIO_MIN
) -> DataFrame:
    """Reports that call for an alert, one per topic and instant; the failure count is tested first.

    Of reports at the same instant only the first can pass a cooldown, so the others
    go here, before any shuffle: a burst at one instant becomes one row per task.
    """
    reason = F.when(F.col("failed") >= failures, F.lit(TOO_MANY_FAILURES)).when(
        F.col("metric_value") < ratio, F.lit(LOW_RATIO)
    )
    called = reports.withColumn("reason", reason).where(F.col("reason").isNotNull())
    first = F.min_by(F.struct("reason", "processed", "inserted", "failed"), "processed").alias("first")
    return called.groupBy("topic", "recorded_at").agg(first).select("topic", "recorded_at", "first.*")


def alerts(
    candidates: DataFrame,
    cooldown_seconds: int = COOLDOWN_SECONDS,
    pipeline: str = PIPELINE,
    last_alerts: DataFrame | None = None,
) -> DataFrame:
    """Candidates that pass the cooldown, as rows of the alert table.

    The candidates are read three times; hand in stored or persisted ones.
    ``last_alerts`` (topic, raised_at) holds the newest alert of earlier batches.
    """
    fired = cooled_instants(candidates, "topic", "recorded_at", cooldown_seconds, last_alerts)
    return candidates.join(fired, ["topic", "recorded_at"]).select(
        "topic",
        F.lit(pipeline).alias("pipeline"),
        "reason",
        _summary().alias("summary"),
        F.col("recorded_at").alias("raised_at"),
    )
