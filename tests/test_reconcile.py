"""Which messages are lost: digests of offset ranges, compared from the widest down."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import reconcile as R

DDL = "topic string, partition int, offset bigint"


def plain(published, held):
    out = set()
    for place in set(published) | set(held):
        p, h = published.count(place), held.count(place)
        if p != h:
            out.add((*place, p, h, "lost" if p > h else "unexpected" if p == 0 else "repeated"))
    return out


def found(spark, published, held, **sizes):
    frames = [spark.createDataFrame(rows, DDL) for rows in (published, held)]
    return {tuple(r) for r in R.lost_messages(*frames, **sizes).collect()}


WHOLE = [("a", n % 3, n // 3) for n in range(900)] + [("b", 0, n) for n in range(40)]


@pytest.mark.parametrize("offsets, fan", [(4, 3), (16, 4), (4096, 64)])
def test_lost_repeated_and_unexpected_messages_are_named(spark, offsets, fan):
    held = [row for row in WHOLE if row not in {("a", 1, 7), ("a", 2, 250), ("b", 0, 39)}]
    held += [("a", 0, 5), ("a", 0, 5), ("c", 9, 1), ("a", 1, 100_000)]
    assert found(spark, WHOLE, held, offsets=offsets, fan=fan) == plain(WHOLE, held)


def test_equal_and_empty_sides(spark):
    assert found(spark, WHOLE, WHOLE, offsets=16, fan=4) == set()
    assert found(spark, [], [], offsets=16, fan=4) == set()
    assert found(spark, WHOLE[:5], [], offsets=16, fan=4) == plain(WHOLE[:5], [])


def test_only_unlike_ranges_are_opened(spark, monkeypatch):
    """One lost message of 100,000: each level compares the children of one range."""
    whole = spark.range(100_000).select(F.lit("a").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    opened = []

    def watched(one, other):
        opened.append(one.count())
        return unlike(one, other)

    unlike = R._unlike
    monkeypatch.setattr(R, "_unlike", watched)
    got = R.lost_messages(whole, whole.where("offset <> 77777"), offsets=100, fan=10).collect()
    assert [(r.offset, r.finding) for r in got] == [(77777, "lost")]
    assert opened == [1, 10, 10, 10]


def test_one_pass_gives_the_counts_of_two_tables(spark):
    rows = [("A", "A", "inserted"), ("A", None, "invalid"), ("B", "B", "inserted"), (None, None, "invalid"), ("a ", "A", "inserted")]
    outcomes = spark.createDataFrame(rows, "sent string, symbol string, status string")
    held = spark.createDataFrame([("A",), ("Z",)], "symbol string")
    arrived = outcomes.where("status = 'inserted'").select("symbol")
    expected = R.reconcile(outcomes.select(F.col("sent").alias("symbol")), held, held.unionByName(arrived))
    assert set(R.reconcile_run(outcomes, held).collect()) == set(expected.collect())
