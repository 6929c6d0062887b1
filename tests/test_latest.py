import datetime as dt
import random

import pytest

from tickloom.operators import dashboard, latest
from tickloom.operators.latest import newest_rows
from tickloom.plans import views

DDL = (
    "symbol string, price double, open_price double, high_price double, low_price double, volume bigint, "
    "event_time timestamp, inserted_at timestamp, event_id bigint"
)


def at(second):
    return None if second is None else dt.datetime(2026, 1, 1) + dt.timedelta(seconds=second)


def prices(spark, rows):
    """(symbol, price, volume, event second, inserted second)"""
    full = [(s, p, p, p, p, v, at(e), at(i), n) for n, (s, p, v, e, i) in enumerate(rows)]
    return spark.createDataFrame(full, DDL)


ROWS = [
    ("A", 1.0, 10, 5, 5),
    ("A", 2.0, 20, 9, 6),
    ("A", 3.0, 30, 7, 7),
    ("B", 4.0, 40, 3, 8),
    ("B", 5.0, 50, None, 9),
    ("B", 6.0, 60, 99, 10),
    (None, 7.0, 70, 1, 11),
    (None, 8.0, 80, 2, 12),
    ("C", 9.0, 90, 4, 13),
    ("C", 9.5, 95, 4, 14),
]


def test_latest_view(spark):
    rows = views.latest_view(prices(spark, ROWS), ("event_id",)).collect()
    got = {r.symbol: r.price for r in rows}
    # The NULL time wins for B, NULL symbols are a group, equal times go to the greater id.
    assert got == {"A": 2.0, "B": 5.0, None: 8.0, "C": 9.5}
    assert rows[0].asDict().keys() == dict.fromkeys(dashboard.PRICE_COLUMNS).keys()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_latest_view_ships_one_row_per_key_and_task(spark):
    plan = plan_of(views.latest_view(prices(spark, ROWS), ("event_id",)))
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning(symbol")
    assert "Window" not in plan


def test_view_of_long_history_sorts_none_of_it(spark, tmp_path):
    prices(spark, ROWS).write.parquet(f"{tmp_path}/prices")
    plan = plan_of(views.latest_view(spark.read.parquet(f"{tmp_path}/prices"), ("event_id",), long=True))
    main, bounds = plan.split("Subquery", 1)[0], plan[plan.index("HashAggregate(keys=[symbol") :]
    # What is sorted has passed the bounds; those come from a hash aggregate that reads two columns.
    assert main.index("SortAggregate") < main.index("Filter (isnull(event_time")
    assert "SortAggregate" not in bounds.split("FileScan")[0] and "Join" not in main
    assert "ReadSchema: struct<symbol:string,event_time:timestamp>" in bounds


@pytest.mark.parametrize("slots", [1, 3, latest.BOUNDS])
def test_latest_in_history_whatever_keys_share_a_bound(spark, monkeypatch, slots):
    monkeypatch.setattr(latest, "BOUNDS", slots)
    draw = random.Random(slots)
    symbols = [None, "", *"ABCDEFGH"]
    rows = [
        (draw.choice(symbols), float(n), n, None if draw.random() < 0.02 else draw.randrange(60), n) for n in range(400)
    ] + [("OLD", 1.0, 1, -900, 1), ("NEVER", 1.0, 1, None, 1), ("NEVER", 2.0, 2, None, 2)]
    args = "symbol", "event_time", ("event_id",), ["symbol", "event_time", "event_id", "price"]
    table = prices(spark, rows)
    got, plain = latest.latest_in_history(table, *args).collect(), latest.latest_per_key(table, *args).collect()
    assert sorted(got, key=str) == sorted(plain, key=str) and len(got) == 12
    assert latest.latest_in_history(table.limit(0), *args).collect() == []


def test_latest_view_sees_rows_written_later(spark, tmp_path):
    spark.sql(f"CREATE TABLE later_prices ({DDL}) USING parquet LOCATION '{tmp_path}/later'")
    try:
        prices(spark, [("A", 1.0, 1, 5, 5)]).write.insertInto("later_prices")
        view = views.latest_view(spark.table("later_prices"), ("event_id",), long=True)
        assert [r.price for r in view.collect()] == [1.0]
        prices(spark, [("A", 2.0, 1, 6, 6), ("B", 3.0, 1, 1, 1)]).write.insertInto("later_prices")
        view = views.latest_view(spark.table("later_prices"), ("event_id",), long=True)
        assert sorted(r.price for r in view.collect()) == [2.0, 3.0]
    finally:
        spark.sql("DROP TABLE later_prices")


def test_dashboard_frames(spark):
    ties = ("event_id",)
    recent = dashboard.recent_prices(prices(spark, ROWS), ties, 7)  # from inserted second 8 on
    assert sorted(r.event_id for r in recent.collect()) == [3, 4, 5, 6, 7, 8, 9]
    latest = {r.symbol: r.price for r in dashboard.latest_prices(recent, ties).collect()}
    assert latest == {"B": 5.0, "C": 9.5}
    volumes = {r.symbol: r.volume for r in dashboard.latest_volumes(recent, ties).collect()}
    assert volumes == {"B": 50, "C": 95}
    kpi = dashboard.headline_numbers(recent, ties).first()
    assert (kpi.tracked_symbols, kpi.latest_records, kpi.total_volume) == (2, 7, 145)
    lines = [(r.symbol, r.event_time) for r in dashboard.price_lines(recent).collect()]
    assert lines == sorted(lines, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or at(0)))


def test_dashboard_of_nothing(spark):
    recent = dashboard.recent_prices(prices(spark, []), ("event_id",))
    assert tuple(dashboard.headline_numbers(recent, ("event_id",)).first()) == (0, 0, 0)
    assert dashboard.latest_prices(recent, ("event_id",)).count() == 0


def test_newest_rows_is_a_top_k(spark):
    frame = newest_rows(prices(spark, ROWS), "inserted_at", 3, ("event_id",))
    assert [r.event_id for r in frame.collect()] == [9, 8, 7]
    assert "TakeOrderedAndProject" in frame._jdf.queryExecution().executedPlan().toString()


def test_views_in_sql(spark):
    curated = spark.createDataFrame(
        [(at(60), "A", 1.0, 1.0, 1.0, 5, 1, at(58), at(61)), (at(120), "A", 1.0, 1.0, 1.0, 5, 1, at(119), at(121))],
        "batch_time timestamp, symbol string, avg_price double, min_price double, max_price double, "
        "total_volume bigint, event_count int, latest_event_time timestamp, inserted_at timestamp",
    )
    names = views.register_views(spark, prices(spark, ROWS), curated, ("event_id",))
    assert [spark.sql(f"SELECT count(*) FROM {n}").first()[0] for n in names] == [4, 2, 2]
    slack = spark.sql("SELECT latency_seconds FROM vw_stock_latency").collect()
    assert [r[0] for r in slack] == [1.0, 2.0]
    assert spark.sql("SELECT batch_time FROM vw_stock_curated_recent").first()[0] == at(120)


def test_latency_keeps_fractions(spark):
    rows = spark.sql(
        "SELECT 'A' symbol, TIMESTAMP'2026-01-01 00:01:00' batch_time, "
        "TIMESTAMP'2026-01-01 00:00:58.5' latest_event_time, TIMESTAMP'2026-01-01 00:02:00' inserted_at"
    )
    assert views.latency_view(rows).first().latency_seconds == 1.5
