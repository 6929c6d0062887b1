import datetime as dt

from tickloom.operators.curate import curate, current_revision

T = dt.datetime(2026, 1, 1)


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "symbol string, price double, volume bigint, event_time timestamp" + extra)


def test_windows_are_half_open_and_labelled_by_their_end(spark):
    rows = [
        ("A", 2.0, 10, T + dt.timedelta(seconds=0)),
        ("A", 4.0, 20, T + dt.timedelta(seconds=59, milliseconds=999)),
        ("A", 8.0, 5, T + dt.timedelta(seconds=60)),
    ]
    got = {r.batch_time: r for r in curate(frame(spark, rows)).collect()}
    first, second = got[T + dt.timedelta(minutes=1)], got[T + dt.timedelta(minutes=2)]
    assert (first.avg_price, first.min_price, first.max_price, first.total_volume, first.event_count) == (3.0, 2.0, 4.0, 30, 2)
    assert second.event_count == 1 and second.latest_event_time == rows[2][3]


def test_null_prices_lower_the_average(spark):
    rows = [("A", 6.0, 1, T), ("A", None, 1, T), ("A", None, None, T)]
    got = curate(frame(spark, rows)).first()
    assert (got.avg_price, got.min_price, got.total_volume, got.event_count) == (2.0, 6.0, 2, 3)


def test_only_null_prices(spark):
    got = curate(frame(spark, [("A", None, None, T)])).first()
    assert (got.avg_price, got.min_price, got.total_volume, got.event_count) == (None, None, None, 1)


def test_null_symbol_is_a_group_and_null_time_is_dropped(spark):
    rows = [(None, 1.0, 1, T), (None, 1.0, 1, T), ("A", 1.0, 1, None)]
    got = curate(frame(spark, rows)).collect()
    assert [(r.symbol, r.event_count) for r in got] == [(None, 2)]


def test_partial_aggregation_before_the_only_shuffle(spark):
    plan = curate(frame(spark, [("A", 1.0, 1, T)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan


def test_current_revision(spark):
    rows = [("A", 2.0, 0), ("A", 3.0, 1), ("A", 5.0, 5), ("B", 1.0, 1), (None, 7.0, 2)]
    revisions = spark.createDataFrame([(T, s, p, b) for s, p, b in rows], "batch_time timestamp, symbol string, avg_price double, batch_id bigint")
    assert {(r.symbol, r.avg_price) for r in current_revision(revisions).collect()} == {("A", 5.0), ("B", 1.0), (None, 7.0)}
