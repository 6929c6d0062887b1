import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import counters
from tickloom.operators.counters import report_points, running_counters, total_counts
from tickloom.operators.health import alert_candidates, due_rows, health_reports
from tickloom.session import stored

DDL = "topic string, arrival timestamp, partition int, offset bigint, status string"
T = dt.datetime(2026, 1, 1)


def outcomes(count, seed, burst, topics=("a",)):
    """``burst``: share of the rows that arrive at one instant."""
    draw = random.Random(seed)
    rows = []
    for n in range(count):
        second = 500 if draw.random() < burst else draw.randrange(1000)
        status = draw.choice(["inserted"] * 8 + ["invalid", "load_failed"])
        rows.append((draw.choice(topics), T + dt.timedelta(seconds=second), n % 4, n // 4, status))
    return rows


def by_hand(rows, start=None):
    counts = {k: list(v) for k, v in (start or {}).items()}
    out = []
    for row in sorted(rows):
        mine = counts.setdefault(row[0], [0, 0])
        mine[0] += 1
        mine[1] += row[4] == "inserted"
        out.append((*row, mine[0], mine[1], mine[0] - mine[1]))
    return out


@pytest.mark.parametrize("burst", [0.0, 0.4, 1.0])
@pytest.mark.parametrize("topics", [("a",), ("a", "a", "a", "b", "c")])
def test_equals_a_plain_loop(spark, burst, topics):
    rows = outcomes(3000, 3, burst, topics)
    got = running_counters(spark.createDataFrame(rows, DDL), slice_rows=250).collect()
    assert sorted(map(tuple, got)) == sorted(by_hand(rows))


def test_carry(spark):
    rows = outcomes(500, 4, 0.1)
    carry = spark.createDataFrame([("a", 1000, 900), ("z", 5, 5)], "topic string, processed bigint, inserted bigint")
    frame = spark.createDataFrame(rows, DDL)
    got = running_counters(frame, carry=carry).collect()
    assert sorted(map(tuple, got)) == sorted(by_hand(rows, {"a": (1000, 900)}))
    totals = {r.topic: (r.processed, r.inserted, r.failed) for r in total_counts(frame, carry=carry).collect()}
    good = sum(r[4] == "inserted" for r in rows)
    assert totals == {"a": (1500, 900 + good, 600 - good), "z": (5, 5, 0)}


@pytest.mark.parametrize("every", [1, 7, 50])
def test_report_points_are_the_due_rows(spark, every):
    rows = outcomes(2000, 6, 0.4, ("a", "a", "b"))
    carry = spark.createDataFrame([("a", 1013, 900)], "topic string, processed bigint, inserted bigint")
    frame = spark.createDataFrame(rows, DDL)
    columns = ["topic", "arrival", "processed", "inserted", "failed"]
    got = report_points(frame, every, carry=carry, slice_rows=300).select(*columns).collect()
    due = due_rows(running_counters(frame, carry=carry, slice_rows=300), every).select(*columns).collect()
    assert sorted(got) == sorted(due) and got


def test_a_row_without_a_key_is_kept(spark):
    rows = [("a", T, 0, 0, "inserted"), (None, T, 0, 1, "inserted")]
    got = {r.topic: r.processed for r in running_counters(spark.createDataFrame(rows, DDL)).collect()}
    assert got == {"a": 1, None: None}


def test_plan_has_no_single_partition_window(spark):
    frame = running_counters(spark.createDataFrame(outcomes(100, 5, 0.1), DDL))
    assert "SinglePartition" not in frame._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_moves_all_rows(spark, monkeypatch):
    """Before the slices are written there is one exchange; on reading only totals of slices move."""
    plans = []

    def watched(rows, label):
        plans.append((label, rows._jdf.queryExecution().executedPlan().toString()))
        return stored(rows, label)

    monkeypatch.setattr(counters, "stored", watched)
    frame = counters.running_counters(spark.createDataFrame(outcomes(1000, 5, 0.1), DDL))
    assert [label for label, _ in plans] == ["slices", "slice_totals"]
    assert plans[0][1].count("Exchange") == 1 and "rangepartitioning" in plans[0][1]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange") == plan.count("BroadcastExchange")


def test_sums_that_begin_inside_a_slice(spark):
    """Several keys and several sums, null values count as 0, and slices of a few rows."""
    rows = [("ab"[n % 7 > 4], n, n % 5 if n % 3 else None, -n) for n in range(200)]
    frame = spark.createDataFrame(rows, "topic string, at int, up int, down int").repartition(5)
    got = counters.numbered(frame, ("at",), slice_rows=9, sums={"ups": F.col("up"), "downs": F.col("down")}).collect()
    expected, held = [], {"a": [0, 0, 0], "b": [0, 0, 0]}
    for topic, at, up, down in sorted(rows, key=lambda r: r[1]):
        own = held[topic]
        own[0], own[1], own[2] = own[0] + 1, own[1] + (up or 0), own[2] + down
        expected.append((topic, at, up, down, *own))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_reports_skip_validation_failures_but_not_load_failures(spark):
    rows = [("t", T, 0, n, status, n, n - 1, 1) for n, status in ((50, "invalid"), (100, "load_failed"), (150, "inserted"), (151, "inserted"))]
    counted = spark.createDataFrame(rows, DDL + ", processed bigint, inserted bigint, failed bigint")
    reports = health_reports(due_rows(counted)).orderBy("processed").collect()
    assert [r.processed for r in reports] == [100, 150]
    assert reports[0].extra_data == '{"processed":100,"inserted":99,"failed":1,"topic":"t","success_ratio":0.99}'
    assert reports[1].metric_value == 149 / 150
    assert '"success_ratio":0.9933' in reports[1].extra_data


def test_candidate_reasons(spark):
    rows = [("t", 50, 40, 9, 0.8), ("t", 100, 95, 5, 0.95), ("t", 200, 190, 10, 0.95), ("t", 250, 240, 10, 0.9)]
    rows = [(*row, T + dt.timedelta(seconds=row[1])) for row in rows]
    reports = spark.createDataFrame(
        rows, "topic string, processed int, inserted int, failed int, metric_value double, recorded_at timestamp"
    )
    got = {r.processed: r.reason for r in alert_candidates(reports).collect()}
    assert got == {
        50: "success-ratio-below-threshold",
        200: "failure-threshold-reached",
        250: "failure-threshold-reached",
    }
