"""The load test of the pipeline: generate, deliver, ingest, curate, reconcile."""

import datetime as dt
import json
import math

import pytest

from tickloom.operators import dashboard
from tickloom.operators.curate import current_revision
from tickloom.operators.reconcile import reconcile
from tickloom.operators.synthetic import synthetic_ticks
from tickloom.plans import views
from tickloom.session import work_folder
from tickloom.sources.readers import source
from tickloom.sources.tables import PipelineTables
from tickloom.streaming.jobs import as_messages, curated_batch, curation_job, ingest_job, merged_curation_job
from tickloom.streaming.merge import current_windows
from tickloom.streaming.windows import run_to_end


@pytest.fixture(scope="module")
def load(spark):
    """2,000 ticks of 200 seconds through all jobs."""
    folder = work_folder(spark, "load")
    ticks = synthetic_ticks(spark, 2000, seed=9, start="2026-01-01 00:00:00", step_micros=100_000)
    as_messages(ticks, "t", "id").write.parquet(f"{folder}/topic")
    tables = PipelineTables("load_run", f"{folder}/tables").create(spark)
    run_to_end(ingest_job(source(spark, "files", path=f"{folder}/topic"), tables, f"{folder}/i", drain=True))
    run_to_end(curation_job(source(spark, "files", path=f"{folder}/topic"), curated_batch(tables), f"{folder}/c", drain=True))
    merged = PipelineTables("load_merged", f"{folder}/merged").create(spark)
    run_to_end(merged_curation_job(source(spark, "files", path=f"{folder}/topic"), merged, f"{folder}/m", drain=True))
    return ticks, tables, merged


def test_load_run(spark, load):
    ticks, tables, _ = load
    prices = tables.read(spark, "stock_prices")
    got = reconcile(ticks, prices.limit(0), prices).collect()
    assert len(got) == 5
    assert all((r.published, r.inserted_delta, r.verdict, r.complete) == (400, 400, "PASS", True) for r in got)
    assert tables.read(spark, "pipeline_metrics").count() == 40

    curated = current_revision(tables.read(spark, "stock_prices_curated").drop("inserted_at", "run"))
    # 200 seconds of ticks: three full minutes and twenty seconds of a fourth.
    counts = {(r.batch_time.minute, r.symbol): r.event_count for r in curated.collect()}
    assert len(counts) == 20 and sum(counts.values()) == 2000
    assert {n for (minute, _), n in counts.items() if minute == 4} == {40}


def test_views_and_dashboard_on_the_tables_that_the_jobs_wrote(spark, load):
    _, tables, _ = load
    prices, curated = tables.read(spark, "stock_prices"), tables.read(spark, "stock_prices_curated")
    names = views.register_views(spark, prices, curated, ("inserted_at", "partition", "offset"))
    latest = {r.symbol: r for r in spark.table(names[0]).collect()}
    assert len(latest) == 5 and all(r.inserted_at is not None for r in latest.values())
    newest = spark.sql(f"SELECT symbol, max(event_time) AS at FROM {tables.name('stock_prices')} GROUP BY symbol").collect()
    assert {r.symbol: r.at for r in newest} == {s: r.event_time for s, r in latest.items()}
    recent = spark.table(names[1]).collect()
    assert len(recent) == 20 and [r.batch_time for r in recent] == sorted((r.batch_time for r in recent), reverse=True)
    slack = spark.table(names[2]).collect()
    assert all(0 < r.latency_seconds <= 60 for r in slack)

    ties = ("partition", "offset")
    held = dashboard.recent_prices(prices, ties)
    assert dashboard.headline_numbers(held, ties).first().latest_records == 1000
    assert dashboard.latest_prices(held, ties).count() == 5
    assert dashboard.price_lines(held).count() == 1000


def test_merged_curation_gives_the_windows_of_the_stateful_job(spark, load):
    _, tables, merged = load
    stateful = current_revision(tables.read(spark, "stock_prices_curated").drop("inserted_at", "run"))
    key = lambda r: (r.batch_time, r.symbol)
    for mine, theirs in zip(sorted(current_windows(merged, spark).collect(), key=key), sorted(stateful.collect(), key=key), strict=True):
        assert mine.avg_price == pytest.approx(theirs.avg_price, rel=1e-12)
        assert [c for n, c in mine.asDict().items() if n != "avg_price"] == [theirs[n] for n in mine.asDict() if n != "avg_price"]


def test_prices_stay_as_they_were_sent(spark):
    """NaN and fractions of a cent go through curation; texts are no numbers there, but load as prices."""
    folder = work_folder(spark, "kept")
    sent = ["12.345", "NaN", "12345678901234567.89", '"1.5"', "null"]
    body = '{{"symbol": "S{0}", "price": {1}, "open": 1, "high": 1, "low": 1, "volume": 7, "event_time": "2026-01-01T00:00:0{0}+00:00"}}'
    rows = [("t", 0, n, dt.datetime(2026, 1, 1), bytearray(body.format(n, price), "utf-8")) for n, price in enumerate(sent)]
    spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp timestamp, value binary").write.parquet(f"{folder}/topic")
    tables = PipelineTables("kept_run", f"{folder}/tables").create(spark)
    run_to_end(curation_job(source(spark, "files", path=f"{folder}/topic"), curated_batch(tables), f"{folder}/c", drain=True))
    run_to_end(ingest_job(source(spark, "files", path=f"{folder}/topic"), tables, f"{folder}/i", drain=True))
    got = {r.symbol: (r.avg_price, r.min_price, r.max_price) for r in tables.read(spark, "stock_prices_curated").collect()}
    assert got["S0"] == (12.345,) * 3 and all(math.isnan(p) for p in got["S1"]) and got["S2"] == (1.2345678901234568e16,) * 3
    assert got["S3"] == got["S4"] == (None, None, None)
    stored = {r.symbol: r.price for r in tables.read(spark, "stock_prices").collect()}
    assert stored["S0"] == 12.345 and math.isnan(stored["S1"]) and stored["S3"] == 1.5 and "S4" not in stored


def test_message_text(spark):
    tick = synthetic_ticks(spark, 1, seed=9, start="2026-01-01 00:00:00.25")
    row = as_messages(tick, "t", "id").first()
    body = json.loads(bytes(row.value))
    assert list(body) == ["symbol", "price", "open", "high", "low", "volume", "event_time"]
    assert body["event_time"] == "2026-01-01T00:00:00.25+00:00"
    assert row.timestamp == dt.datetime(2026, 1, 1, 0, 0, 0, 250000)
