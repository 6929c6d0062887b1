"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.stamps import micros
from tickloom.operators import dashboard, ingest
from tickloom.operators.bars import latest_bar, tick_json
from tickloom.operators.counters import report_points, running_counters
from tickloom.operators.curate import CURATED, curate, current_revision
from tickloom.operators.health import REPORT_EVERY, alert_candidates, alerts, health_reports
from tickloom.operators.latest import newest_rows
from tickloom.operators.parse import parse_ticks
from tickloom.operators.reconcile import lost_messages, reconcile_run, row_count, throughput
from tickloom.operators.symbols import split_symbols
from tickloom.operators.synthetic import draw_ticks
from tickloom.plans import adapters as A
from tickloom.plans import views
from tickloom.schemas import TICK_FIELDS
from tickloom.session import ship_package, stored, use_utc, work_folder
from tickloom.sources.tables import PipelineTables
from tickloom.sources.writers import topic_rows
from tickloom.streaming.ingest import latest_snapshot
from tickloom.streaming.jobs import CURATION_FIELDS, curated_batch, curation_job, ingest_job, merged_curation_job
from tickloom.streaming.merge import current_windows
from tickloom.streaming.windows import curated_stream, run_to_end, to_sink

Query = Callable[[SparkSession, str], DataFrame]

TIES = ("event_id",)
LIMIT = 10
LATE_PARTS = 3
INGEST_PARTS = 2
LATE_WINDOW = "1 hour"
STRETCH_US = 10 * 86_400_000_000
# Later than any tick of the revisions arrives, so that none of them is dropped.
PATIENT = "6 hours"
# A micro-batch takes about so many bytes of files.
INGEST_BATCH_BYTES = 256 << 20
# Places that averages of JSON prices are compared to: doubles add up in any order.
PLACES = 9

_QUERIES: dict[str, Query] = {}

_TOPIC_DDL = "topic string, partition int, offset bigint, timestamp timestamp, value binary"


def emit(rows: DataFrame) -> DataFrame:
    """Result types: times without zone, prices as doubles."""
    columns = []
    for field in rows.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        columns.append(column)
    return rows.select(*columns)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return emit(function(ship_package(use_utc(spark)), sf_dir))

        run.__doc__ = function.__doc__
        _QUERIES[name] = run
        return function

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _ticks(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return A.ticks(A.read_table(spark, sf_dir, "events"), **options)


def _messages(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return A.tick_messages(A.read_table(spark, sf_dir, "events"), **options)


def _classified(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return ingest.classify(_messages(spark, sf_dir, **options))


# Curation


@query("curated_window")
def curated_window(spark, sf_dir):
    return curate(_ticks(spark, sf_dir))


@query("curated_hour")
def curated_hour(spark, sf_dir):
    return curate(_ticks(spark, sf_dir), "1 hour")


@query("curated_heavy_day")
def curated_heavy_day(spark, sf_dir):
    return curate(A.heavy_ticks(A.read_table(spark, sf_dir, "lineitem")), "1 day")


def _rounded(curated: DataFrame) -> DataFrame:
    return curated.withColumn("avg_price", F.round("avg_price", PLACES))


@query("curated_from_json")
def curated_from_json(spark, sf_dir):
    """Payload to windows, as the stream does it: malformed payloads vanish, texts are no numbers."""
    return _rounded(curate(parse_ticks(_messages(spark, sf_dir), ddl=CURATION_FIELDS), "1 hour"))


def _new_tables(spark, label: str) -> tuple[str, PipelineTables]:
    """A fresh folder and the tables of a pipeline below it."""
    folder = work_folder(spark, label)
    return folder, PipelineTables(f"{label}_{uuid.uuid4().hex}", f"{folder}/tables").create(spark)


def _stretches(spark, sf_dir, folder: str) -> list[dt.datetime]:
    """Ticks as a topic in order of arrival, a part for every ten days; gives the ends of these parts."""
    names = {"open_price": "open", "high_price": "high", "low_price": "low"}
    ticks = _ticks(spark, sf_dir, late_minutes=True).withColumnsRenamed(names)
    arrival = F.col("inserted_at")
    parts = A.write_topic(
        ticks.select(
            "topic",
            "partition",
            "offset",
            arrival.alias("timestamp"),
            tick_json(ticks.select(*TICK_FIELDS)).cast("binary").alias("value"),
            F.floor(micros(arrival) / F.lit(STRETCH_US)).cast("int").alias("part"),
        ),
        folder,
    )
    return [dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=(part + 1) * STRETCH_US) for part in parts]


def _curated_table(spark, sf_dir, width="1 minute") -> DataFrame:
    """What the curation job wrote to ``stock_prices_curated``, each batch stamped with the end of its part."""
    folder, tables = _new_tables(spark, "curated")
    ends = _stretches(spark, sf_dir, f"{folder}/topic")
    sink = curated_batch(tables, stamp=lambda batch_id: ends[min(batch_id, len(ends) - 1)])
    topic = A.topic_stream(spark, f"{folder}/topic", _TOPIC_DDL)
    run_to_end(curation_job(topic, sink, f"{folder}/checkpoint", width, PATIENT, drain=True))
    return _rounded(tables.read(spark, "stock_prices_curated"))


@query("curated_revisions")
def curated_revisions(spark, sf_dir):
    return _curated_table(spark, sf_dir, "1 hour").select("batch_id", *CURATED)


@query("curated_current")
def curated_current(spark, sf_dir):
    """The maintained table of windows after all batches."""
    folder, tables = _new_tables(spark, "current")
    _stretches(spark, sf_dir, f"{folder}/topic")
    topic = A.topic_stream(spark, f"{folder}/topic", _TOPIC_DDL)
    run_to_end(merged_curation_job(topic, tables, f"{folder}/checkpoint", "1 hour", PATIENT, drain=True))
    return _rounded(current_windows(tables, spark))


# Views


@query("view_latest")
def view_latest(spark, sf_dir):
    return views.latest_view(_ticks(spark, sf_dir), TIES)


@query("view_latest_long")
def view_latest_long(spark, sf_dir):
    """The same without sorting history: bounds from a hash aggregate first."""
    return views.latest_view(_ticks(spark, sf_dir), TIES, long=True)


@query("view_latest_nulls")
def view_latest_nulls(spark, sf_dir):
    """The latest rows of what the ingest job wrote in two batches, where symbols and times may be NULL."""
    tables = _ingested_tables(spark, sf_dir, "latest", health=False)
    return latest_snapshot(tables, spark).withColumnRenamed("arrival", "inserted_at").select(*dashboard.PRICE_COLUMNS)


@query("view_curated_recent")
def view_curated_recent(spark, sf_dir):
    return views.curated_view(_curated_table(spark, sf_dir))


@query("view_latency")
def view_latency(spark, sf_dir):
    return views.latency_view(_curated_table(spark, sf_dir))


# Dashboard


def _recent(spark, sf_dir) -> DataFrame:
    return dashboard.recent_prices(_ticks(spark, sf_dir), TIES)


@query("recent_ticks")
def recent_ticks(spark, sf_dir):
    return _recent(spark, sf_dir).drop(*TIES)


@query("dashboard_latest")
def dashboard_latest(spark, sf_dir):
    return dashboard.latest_prices(_recent(spark, sf_dir), TIES)


@query("latest_volume")
def latest_volume(spark, sf_dir):
    return dashboard.latest_volumes(_recent(spark, sf_dir), TIES)


@query("dashboard_kpis")
def dashboard_kpis(spark, sf_dir):
    return dashboard.headline_numbers(_recent(spark, sf_dir), TIES)


@query("price_series")
def price_series(spark, sf_dir):
    return dashboard.price_lines(_recent(spark, sf_dir))


@query("recent_prices")
def recent_prices(spark, sf_dir):
    return newest_rows(_ticks(spark, sf_dir), "inserted_at", LIMIT, TIES).select(*dashboard.PRICE_COLUMNS)


@query("recent_curated")
def recent_curated(spark, sf_dir):
    return newest_rows(_curated_table(spark, sf_dir), "inserted_at", LIMIT, ("batch_time", "symbol")).drop("run", "batch_id")


@query("recent_dead_letters")
def recent_dead_letters(spark, sf_dir):
    rows = ingest.dead_letters(_classified(spark, sf_dir), F.col("arrival").alias("created_at"))
    return newest_rows(rows, "created_at", LIMIT, ("source_partition", "source_offset"))


@query("recent_metrics")
def recent_metrics(spark, sf_dir):
    reports = _reports(spark, sf_dir)
    return newest_rows(reports, "recorded_at", LIMIT).select("metric_name", "metric_value", "recorded_at")


@query("tick_count")
def tick_count(spark, sf_dir):
    return row_count(A.read_table(spark, sf_dir, "events"))


# Parsing and ingest


@query("parse_ticks")
def parse_payloads(spark, sf_dir):
    return parse_ticks(_messages(spark, sf_dir), keep=("partition", "offset"))


@query("ingest_valid")
def ingest_valid(spark, sf_dir):
    return ingest.price_rows(_classified(spark, sf_dir), "partition", "offset")


@query("ingest_dead_letter")
def ingest_dead_letter(spark, sf_dir):
    return ingest.dead_letters(_classified(spark, sf_dir))


@query("ingest_split_counts")
def ingest_split_counts(spark, sf_dir):
    return ingest.split_counts(_classified(spark, sf_dir))


# Health


def _outcomes(spark, sf_dir, **options) -> DataFrame:
    """Narrow and stored: the payloads are parsed once, however often the outcomes are read."""
    classified = _classified(spark, sf_dir, **options)
    return stored(classified.select("topic", "arrival", "partition", "offset", "status"), "outcomes")


def _reports(spark, sf_dir) -> DataFrame:
    return health_reports(report_points(_outcomes(spark, sf_dir, fast_clock=True), REPORT_EVERY))


@query("running_counters")
def counters(spark, sf_dir):
    return running_counters(_outcomes(spark, sf_dir))


@query("health_metrics")
def health_metrics(spark, sf_dir):
    return _reports(spark, sf_dir).select("metric_name", "metric_value", "extra_data", "recorded_at")


@query("alerts")
def alert_log(spark, sf_dir):
    return alerts(stored(alert_candidates(_reports(spark, sf_dir)), "candidates"))


# Generators, counts and rates


@query("synthetic_ticks")
def synthetic_ticks(spark, sf_dir):
    """One generated tick per event id."""
    return draw_ticks(A.read_table(spark, sf_dir, "events").select("event_id"), "event_id", seed=7)


@query("publish_values")
def publish_values(spark, sf_dir):
    """Generated ticks as rows of the topic."""
    ticks = draw_ticks(A.read_table(spark, sf_dir, "events").select("event_id"), "event_id", seed=7)
    return topic_rows(ticks.drop("id"), A.TOPIC)


@query("symbol_normalise")
def symbol_normalise(spark, sf_dir):
    return split_symbols(A.symbol_lists(A.read_table(spark, sf_dir, "events")), "symbols", ("event_id",))


@query("symbol_poll_list")
def symbol_poll_list(spark, sf_dir):
    """The poller's variant, which keeps blank entries."""
    lists = A.symbol_lists(A.read_table(spark, sf_dir, "events"))
    return split_symbols(lists, "symbols", ("event_id",), drop_blank=False)


@query("latest_bar_per_symbol")
def latest_bar_per_symbol(spark, sf_dir):
    stamp = F.lit("2024-02-01 12:00:00").cast("timestamp")
    return latest_bar(A.bars(A.read_table(spark, sf_dir, "events")), "2024-01-15", stamp, TIES)


@query("load_reconcile")
def load_reconcile(spark, sf_dir):
    """All generated messages against the price rows they became, in a table that held the heavy ticks before."""
    sent = parse_ticks(_messages(spark, sf_dir), ddl="symbol STRING", keep=("topic", "partition", "offset", "arrival", "value"))
    outcomes = ingest.classify(sent.withColumnRenamed("symbol", "sent"))
    held = A.heavy_ticks(A.read_table(spark, sf_dir, "lineitem")).select("symbol")
    return reconcile_run(outcomes, held)


@query("lost_offsets")
def lost_offsets(spark, sf_dir):
    """Which of the generated messages have no price row."""
    messages = _messages(spark, sf_dir).select("topic", "partition", "offset")
    held = ingest.price_rows(_classified(spark, sf_dir), "topic", "partition", "offset")
    return lost_messages(messages, stored(held.select("topic", "partition", "offset"), "held"))


@query("throughput")
def throughput_per_symbol(spark, sf_dir):
    return throughput(_ticks(spark, sf_dir))


# Streams


def _stream_messages(spark, sf_dir, **options) -> DataFrame:
    return A.tick_messages(A.stream_table(spark, sf_dir, "events", **options)).withColumnRenamed("arrival", "timestamp")


@query("stream_window_update")
def stream_window_update(spark, sf_dir):
    """The curation job over messages; the newest revision per key in its table."""
    folder, tables = _new_tables(spark, "update")
    messages = _stream_messages(spark, sf_dir)
    run_to_end(curation_job(messages, curated_batch(tables), f"{folder}/checkpoint", "1 hour", drain=True))
    revisions = tables.read(spark, "stock_prices_curated").select("batch_id", *CURATED)
    return _rounded(current_revision(revisions))


@query("stream_window_append")
def stream_window_append(spark, sf_dir):
    """Append mode: only windows that the watermark has closed."""
    folder, tables = _new_tables(spark, "append")
    ticks = A.ticks(A.stream_table(spark, sf_dir, "events")).withColumn("price", F.col("price").cast("double"))
    rows = curated_stream(ticks, "1 hour")
    run_to_end(to_sink(rows, curated_batch(tables), f"{folder}/checkpoint", "append", drain=True))
    return _rounded(tables.read(spark, "stock_prices_curated")).select(*CURATED)


def _late_topic(spark, sf_dir, folder: str) -> list[int]:
    """Messages of ticks by arrival in three parts."""
    names = {"open_price": "open", "high_price": "high", "low_price": "low"}
    ticks = _ticks(spark, sf_dir, late_minutes=True).withColumnsRenamed(names)
    value = tick_json(ticks.select(*TICK_FIELDS)).cast("binary").alias("value")
    parts = A.in_parts(ticks, "inserted_at", LATE_PARTS)
    columns = ("topic", "partition", "offset", F.col("inserted_at").alias("timestamp"), value, "part")
    return A.write_topic(parts.select(*columns), folder)


@query("stream_late_drop")
def stream_late_drop(spark, sf_dir):
    """The curation job, run three times as late ticks arrive; those of windows closed by an earlier run are dropped."""
    folder, tables = _new_tables(spark, "late")
    parts = _late_topic(spark, sf_dir, f"{folder}/staged")

    def run() -> None:
        topic = A.topic_stream(spark, f"{folder}/topic", _TOPIC_DDL)
        run_to_end(curation_job(topic, curated_batch(tables), f"{folder}/checkpoint", LATE_WINDOW, drain=True))

    A.arrive(spark, f"{folder}/staged", parts, f"{folder}/topic", run)
    return _rounded(current_revision(tables.read(spark, "stock_prices_curated").select("batch_id", *CURATED)))


@query("stream_late_rows")
def stream_late_rows(spark, sf_dir):
    """The same ticks with the late ones kept: every message is in a window or a dead letter."""
    folder, tables = _new_tables(spark, "routed")
    _late_topic(spark, sf_dir, f"{folder}/topic")
    topic = A.topic_stream(spark, f"{folder}/topic", _TOPIC_DDL)
    run_to_end(merged_curation_job(topic, tables, f"{folder}/checkpoint", LATE_WINDOW, drain=True))
    windows = _rounded(current_windows(tables, spark)).select("batch_time", "symbol", "avg_price", "event_count")
    late = tables.read(spark, "dead_letter_events")
    return windows.select(
        "batch_time", "symbol", "avg_price", "event_count",
        F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"), F.lit(None).cast("string").alias("reason"),
    ).unionByName(
        late.select(
            F.lit(None).cast("timestamp").alias("batch_time"), F.lit(None).cast("string").alias("symbol"),
            F.lit(None).cast("double").alias("avg_price"), F.lit(None).cast("bigint").alias("event_count"),
            F.col("source_partition").alias("partition"), F.col("source_offset").alias("offset"), F.col("error_message").alias("reason"),
        )
    )


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    """The ingest job without health; its prices and dead letters read back as one list of outcomes."""
    folder, tables = _new_tables(spark, "ingest")
    messages = _stream_messages(spark, sf_dir, max_bytes=INGEST_BATCH_BYTES)
    run_to_end(ingest_job(messages, tables, f"{folder}/checkpoint", health=False, drain=True))
    good = tables.read(spark, "stock_prices").select(
        "partition", "offset", "symbol", "price", "volume", F.lit(None).cast("string").alias("error_message")
    )
    bad = tables.read(spark, "dead_letter_events").select(
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
        F.lit(None).cast("string").alias("symbol"),
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("bigint").alias("volume"),
        "error_message",
    )
    return good.unionByName(bad)


def _ingested_tables(spark, sf_dir, label: str, health: bool = True, **options) -> PipelineTables:
    """Tables that the ingest job wrote from messages replayed in two batches."""
    folder, tables = _new_tables(spark, label)
    messages = A.in_parts(_messages(spark, sf_dir, **options), "arrival", INGEST_PARTS)
    A.write_topic(messages.withColumnRenamed("arrival", "timestamp"), f"{folder}/topic")
    topic = A.topic_stream(spark, f"{folder}/topic", _TOPIC_DDL)
    run_to_end(ingest_job(topic, tables, f"{folder}/checkpoint", health=health, drain=True))
    return tables


@query("stream_health")
def stream_health(spark, sf_dir):
    """Health reports of messages replayed in two batches; the counts carry over."""
    reports = _ingested_tables(spark, sf_dir, "health", fast_clock=True).read(spark, "pipeline_metrics")
    return reports.select("metric_name", "metric_value", "extra_data", "recorded_at")


@query("stream_alerts")
def stream_alerts(spark, sf_dir):
    """Alerts of the same replay; the cooldown carries over."""
    raised = _ingested_tables(spark, sf_dir, "alerts", fast_clock=True).read(spark, "pipeline_alerts")
    return raised.select("topic", "pipeline", "reason", "summary", "raised_at")
