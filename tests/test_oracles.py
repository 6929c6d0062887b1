"""Every registered query against its SQL, on whole tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_file
from tickloom.plans.oracles import all_oracles
from tickloom.plans.registry import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_entry(spark):
    frame = entry_file.entry(spark)
    assert frame.columns[:2] == ["batch_time", "symbol"]
    assert frame.count() > 0


def test_health_fixture_counts(spark, sf_dir):
    """Figures worked out by hand for the fast clock."""
    if not sf_dir.endswith("sf0.01"):
        pytest.skip("figures hold for sf0.01")
    reports = QUERIES["health_metrics"](spark, sf_dir)
    assert reports.count() == 186
    fired = QUERIES["alerts"](spark, sf_dir).orderBy("raised_at").collect()
    assert len(fired) == 65
    assert fired[0].reason == "success-ratio-below-threshold"
    assert fired[0].raised_at.second == 49
    assert {r.reason for r in fired[1:]} == {"failure-threshold-reached"}


def test_replay_drops_late_rows(spark, sf_dir):
    kept = QUERIES["stream_late_drop"](spark, sf_dir).groupBy().sum("event_count").first()[0]
    total = QUERIES["tick_count"](spark, sf_dir).first()[0]
    assert 0 < kept < total
