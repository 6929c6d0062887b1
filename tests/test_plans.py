"""What the plans of the registered queries may and may not contain."""

import re

import pytest

from tickloom.plans.registry import all_queries

QUERIES = all_queries()
BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))
PYTHON = {"alerts"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan_of(QUERIES[name](spark, sf_dir)) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_and_no_python_rows(plans, name):
    plan = plans[name]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON:
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


@pytest.mark.parametrize("name", BATCH)
def test_one_partition_only_for_totals(plans, name):
    """Rows meet in one task only as partial results of an aggregate without keys."""
    lines = plans[name].splitlines()
    for parent, line in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[]" in parent


@pytest.mark.parametrize("name", BATCH)
def test_filters_do_not_parse(plans, name):
    for line in plans[name].splitlines():
        if re.search(r"\bFilter\b", line):
            assert "from_json" not in line


READS = {
    "curated_heavy_day": {"l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"},
    "synthetic_ticks": {"event_id"},
    "symbol_normalise": {"event_id", "event_type"},
    "throughput": {"ts", "event_type"},
    "tick_count": set(),
}


@pytest.mark.parametrize("name", READS)
def test_only_needed_columns_are_read(plans, name):
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", plans[name]).group(1)
    assert {part.split("#")[0] for part in scanned.split(",") if part} == READS[name]


def test_the_day_of_the_bars_reaches_the_files(spark, sf_dir):
    execution = QUERIES["latest_bar_per_symbol"](spark, sf_dir)._jdf.queryExecution()
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(execution, "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts.*LessThan\(ts", plan)


@pytest.mark.parametrize("name", ["curated_window", "curated_heavy_day", "curated_from_json", "view_latest", "throughput"])
def test_one_shuffle_after_partial_aggregation(plans, name):
    assert plans[name].count("Exchange hashpartitioning") == 1
    assert "partial_" in plans[name]


@pytest.mark.parametrize("name", ["recent_ticks", "recent_prices", "dashboard_kpis", "recent_curated"])
def test_newest_rows_are_a_top_k(plans, name):
    assert "TakeOrderedAndProject" in plans[name]
