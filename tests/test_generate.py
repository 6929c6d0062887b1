import datetime as dt

from pyspark.sql import functions as F

from tickloom.operators.bars import latest_bar, tick_json
from tickloom.operators.reconcile import reconcile, row_count, throughput
from tickloom.operators.symbols import split_symbols
from tickloom.operators.synthetic import SYMBOLS, synthetic_ticks
from tickloom.sources.writers import topic_rows

T = dt.datetime(2026, 1, 1)


def test_synthetic_ranges_and_turns(spark):
    ticks = synthetic_ticks(spark, 5000, seed=1)
    rows = ticks.orderBy("id").collect()
    assert [r.symbol for r in rows[:7]] == [*SYMBOLS, *SYMBOLS[:2]]
    for r in rows:
        assert 50 <= r.price <= 500 and 1000 <= r.volume <= 5_000_000
        assert 0 <= round(r.price - r.open, 2) <= 2
        assert 0 <= round(r.high - r.price, 2) <= 2
        assert 0.01 <= r.low <= r.price and round(r.price - r.low, 2) <= 2
    assert len({r.price for r in rows}) > 4000


def test_synthetic_does_not_depend_on_partitioning(spark):
    one = synthetic_ticks(spark, 300, seed=5)
    other = synthetic_ticks(spark, 300, seed=5).repartition(7)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    assert one.exceptAll(synthetic_ticks(spark, 300, seed=6)).count() > 0


def test_symbol_lists(spark):
    lists = spark.createDataFrame([(1, " aapl,MSFT ,, \tgoogl "), (2, ""), (3, None)], "id int, symbols string")
    kept = split_symbols(lists, "symbols", ("id",)).collect()
    assert [(r.id, r.position, r.symbol) for r in kept] == [(1, 0, "AAPL"), (1, 1, "MSFT"), (1, 3, "GOOGL")]
    polled = split_symbols(lists, "symbols", ("id",), drop_blank=False).collect()
    assert [(r.id, r.symbol) for r in polled] == [(1, "AAPL"), (1, "MSFT"), (1, ""), (1, "GOOGL"), (2, "")]


def test_latest_bar(spark):
    rows = [
        ("A", T + dt.timedelta(hours=1), "1.005", "2", "0.5", "1.115", 10),
        ("A", T + dt.timedelta(hours=9), "1.004", "2.675", "0.5", "1.125", 20),
        ("A", T + dt.timedelta(days=1), "9", "9", "9", "9", 30),
        ("B", T - dt.timedelta(hours=1), "1", "1", "1", "1", 1),
    ]
    bars = spark.createDataFrame(
        rows, "symbol string, bar_time timestamp, open string, high string, low string, close string, volume bigint"
    )
    for name in ("open", "high", "low", "close"):
        bars = bars.withColumn(name, F.col(name).cast("decimal(18,4)"))
    stamp = F.lit("2026-01-01 20:00:00").cast("timestamp")
    got = [tuple(r) for r in latest_bar(bars, "2026-01-01", stamp).collect()]
    assert got == [("A", 1.13, 1.0, 2.68, 0.5, 20, "2026-01-01T20:00:00+00:00")]


def test_tick_json_keeps_nulls(spark):
    ticks = spark.createDataFrame([(None, 1.5)], "symbol string, price double")
    assert ticks.select(tick_json(ticks)).first()[0] == '{"symbol":null,"price":1.5}'
    assert topic_rows(ticks, "t").first().topic == "t"


def test_reconcile(spark):
    def rows(text):
        return spark.createDataFrame([(None if c == "-" else c,) for c in text], "symbol string")

    got = {r.symbol: tuple(r)[1:] for r in reconcile(rows("AAABB-C"), rows("AD"), rows("AAAADB-")).collect()}
    assert got == {
        "A": (3, 1, 4, 3, "PASS", True),
        "B": (2, 0, 1, 1, "PASS", False),
        "C": (1, 0, 0, 0, "CHECK", False),
        "D": (0, 1, 1, 0, "CHECK", True),
        None: (1, 0, 1, 1, "PASS", True),
    }


def test_throughput_and_count(spark):
    rows = [("A", T), ("A", T + dt.timedelta(seconds=4)), ("B", T), ("C", None)]
    frame = spark.createDataFrame(rows, "symbol string, event_time timestamp")
    got = {r.symbol: tuple(r)[1:] for r in throughput(frame).collect()}
    assert got == {"A": (2, 4.0, 0.5), "B": (1, 0.0, 0.0), "C": (1, 0.0, 0.0)}
    assert row_count(frame).first().row_count == 4
