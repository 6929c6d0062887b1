"""Row counts, published-versus-persisted reconciliation down to the message, and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.stamps import micros
from tickloom.operators.ingest import INSERTED
from tickloom.session import stored


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def _verdicts(counts: DataFrame, key: str) -> DataFrame:
    """One row per ``key`` from counts with their ``side``: published, before, arrived."""

    def side_sum(label: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == label, F.col("n"))), F.lit(0)).alias(label)

    merged = counts.groupBy(key).agg(side_sum("published"), side_sum("before"), side_sum("arrived"))
    return merged.select(
        key,
        F.col("published"),
        F.col("before").alias("start_rows"),
        (F.col("before") + F.col("arrived")).alias("end_rows"),
        F.col("arrived").alias("inserted_delta"),
        F.when(F.col("arrived") > 0, "PASS").otherwise("CHECK").alias("verdict"),
        (F.col("arrived") >= F.col("published")).alias("complete"),
    )


def reconcile(published: DataFrame, before: DataFrame, after: DataFrame, key: str = "symbol") -> DataFrame:
    """Published messages against rows that arrived in the table, per ``key``.

    ``before`` and ``after`` are the table at the two ends of the run. The verdict is
    PASS when any row arrived; ``complete`` asks for all of them. The counts are
    reduced per side and added up, which matches NULL keys and needs no join.
    """

    def counted(side: DataFrame, label: str, sign: int = 1) -> DataFrame:
        return side.groupBy(key).agg((sign * F.count(F.lit(1))).alias("n")).withColumn("side", F.lit(label))

    sides = counted(published, "published").unionByName(counted(before, "before"))
    return _verdicts(sides.unionByName(counted(before, "arrived", -1)).unionByName(counted(after, "arrived")), key)


def reconcile_run(outcomes: DataFrame, held: DataFrame, key: str = "symbol", sent: str = "sent") -> DataFrame:
    """The same from one pass over the messages of a run and one over the table before it.

    ``outcomes`` are classified messages that carry the key they were ``sent`` with; ``key`` is the one they were stored with.
    """
    good = F.col("status") == INSERTED
    each = outcomes.groupBy(sent, key, good.alias("good")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(
        F.struct(F.lit("published").alias("side"), F.col(sent).alias("k"), F.col("n")),
        F.struct(F.lit("arrived").alias("side"), F.when(F.col("good"), F.col(key)).alias("k"), F.when(F.col("good"), F.col("n")).otherwise(0).alias("n")),
    )
    counts = each.select(F.inline(sides)).where("n > 0").withColumnRenamed("k", key)
    before = held.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("before"))
    return _verdicts(counts.unionByName(before), key)


# Offsets of a lowest range, and ranges that one of the next level holds.
RANGE_OFFSETS = 4096
RANGE_FAN = 64

_PLACE = ["topic", "partition"]


def _digests(messages: DataFrame, offsets: int) -> DataFrame:
    """One row per range of offsets: how many messages, and two digests of their offsets that add up in any order."""
    own = [F.bit_xor(F.xxhash64(F.lit(seed), "offset")).alias(f"digest{seed}") for seed in (1, 2)]
    return messages.groupBy(*_PLACE, F.expr(f"offset div {offsets}").alias("range")).agg(F.count(F.lit(1)).alias("n"), *own)


def _wider(digests: DataFrame, fan: int) -> DataFrame:
    merged = [F.bit_xor(f"digest{seed}").alias(f"digest{seed}") for seed in (1, 2)]
    return digests.groupBy(*_PLACE, F.expr(f"range div {fan}").alias("range")).agg(F.sum("n").alias("n"), *merged)


def _unlike(one: DataFrame, other: DataFrame) -> DataFrame:
    """Ranges whose digests differ, or that one side does not have."""
    both = one.withColumn("side", F.lit(1)).unionByName(other.withColumn("side", F.lit(2)))
    values = F.struct("n", "digest1", "digest2")
    compared = both.groupBy(*_PLACE, "range").agg(F.count(F.lit(1)).alias("sides"), F.min(values).alias("low"), F.max(values).alias("high"))
    return compared.where((F.col("sides") < 2) | (F.col("low") != F.col("high"))).select(*_PLACE, "range")


def lost_messages(published: DataFrame, held: DataFrame, offsets: int = RANGE_OFFSETS, fan: int = RANGE_FAN) -> DataFrame:
    """(topic, partition, offset, published, held, finding) of every message that one side has more often.

    ``finding`` is ``lost``, ``unexpected`` or ``repeated``. Both sides have topic, partition and offset, and are read twice:
    once for the digests of their ranges, of which wider ranges are made level by level, and once for the rows of
    ranges that turn out to differ. From the widest level down only children of unlike ranges are compared, so
    equal stretches cost no more than their digests. Rows with a null in their place are left out.
    """
    whole = [side.select(*_PLACE, "offset").dropna() for side in (published, held)]
    levels = [[stored(_digests(side, offsets), "digests") for side in whole]]
    widest = max((side.agg(F.max("range")).first()[0] or 0) for side in levels[0])
    while widest > 0:
        levels.append([stored(_wider(side, fan), "digests") for side in levels[-1]])
        widest //= fan
    unlike = _unlike(*levels[-1])
    for sides in reversed(levels[:-1]):
        parents = stored(unlike, "unlike").withColumnRenamed("range", "parent")
        opened = [side.withColumn("parent", F.expr(f"range div {fan}")).join(parents, [*_PLACE, "parent"], "left_semi").drop("parent") for side in sides]
        unlike = _unlike(*opened)
    unlike = stored(unlike, "unlike")

    def opened_rows(side: DataFrame, mine: int) -> DataFrame:
        inside = side.withColumn("range", F.expr(f"offset div {offsets}")).join(unlike, [*_PLACE, "range"], "left_semi")
        return inside.select(*_PLACE, "offset", F.lit(1 - mine).alias("p"), F.lit(mine).alias("h"))

    rows = opened_rows(whole[0], 0).unionByName(opened_rows(whole[1], 1))
    counts = rows.groupBy(*_PLACE, "offset").agg(F.sum("p").alias("published"), F.sum("h").alias("held"))
    finding = (
        F.when(F.col("published") > F.col("held"), "lost").when(F.col("published") == 0, "unexpected").otherwise("repeated")
    )
    return counts.where("published <> held").withColumn("finding", finding)


def throughput(events: DataFrame, time: str = "event_time", key: str = "symbol") -> DataFrame:
    """Events per second between the first and last event of each key; 0 when no time passed."""
    spans = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("events"),
        (micros(F.max(time)) - micros(F.min(time))).alias("span_us"),
    )
    seconds = F.col("span_us") / F.lit(1e6)
    rate = F.when(F.col("span_us") > 0, F.col("events") / seconds).otherwise(F.lit(0.0))
    return spans.select(key, "events", F.coalesce(seconds, F.lit(0.0)).alias("elapsed_seconds"), rate.alias("rate"))
