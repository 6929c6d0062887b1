"""URL filters by a temporal list join.

Dated list entries (a host pattern was put on a list or taken off) become validity intervals. A capture
is judged by the entries that were active when it was fetched: its host and all parent domains are looked
up, and an as-of join keeps the intervals that hold the fetch time. Patterns that no entry names go
first. An interval is cut into blocks of 1, 2, 4, ... days, so it meets the days it covers and no others;
and a pattern, however many captures ask for it, is dealt to ``SALTS`` parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import stored

ADD, REMOVE = "add", "remove"
ALLOW = "allow"

# Parts that the captures of one pattern are dealt to.
SALTS = 16

# Blocks of days are 1 to 2 ** (LEVELS - 1) days long.
LEVELS = 18


def host_of(url: Column) -> Column:
    """Lower-case host without port, user and final dot; null where a URL has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def domains(host: Column) -> Column:
    """The host and its parent domains, the host first."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), ".")
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from (list, pattern, action, listed_at).

    An entry holds until the next one of its list and pattern; equal times are settled in favour of ``add``.
    Entries without list, pattern, known action or time say nothing. ``valid_to`` is null while an entry
    stands; adjoining intervals are left as they are.
    """
    known = entries.select(
        F.col("list").cast("string").alias("list"),
        F.lower("pattern").alias("pattern"),
        F.col("listed_at").cast("timestamp").alias("at"),
        (F.col("action") == ADD).alias("added"),
    ).filter(F.col("action").isin(ADD, REMOVE) & F.col("list").isNotNull() & F.col("pattern").isNotNull() & F.col("listed_at").isNotNull())
    # One row per moment first, so that repeated entries do not gather in one group.
    moments = known.groupBy("list", "pattern", "at").agg(F.max("added").alias("added"))
    after = F.lead("at").over(Window.partitionBy("list", "pattern").orderBy("at"))
    return moments.withColumn("to", after).filter("added").select("list", "pattern", F.col("at").alias("valid_from"), F.col("to").alias("valid_to"))


def _blocks(first: Column, end: Column) -> Column:
    """The least blocks of days (level, block) that make up the days [first, end)."""

    def of(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), level)
        low, high = F.ceil(first / size).cast("int"), F.floor(end / size).cast("int")
        own = [F.when((low < high) & (low % 2 == 1), low), F.when((low < high) & (high % 2 == 1), high - 1)]
        return F.transform(F.array_distinct(F.array_compact(F.array(*own))), lambda block: F.struct(level.alias("level"), block.alias("block")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), of))


def _day(time: Column | str) -> Column:
    return F.unix_date(F.to_date(time))


def _each_salt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.array(*[F.lit(n) for n in range(SALTS)])))


def judge_captures(
    captures: DataFrame,
    entries: DataFrame,
    id_column: str = "capture_id",
    url_column: str = "url",
    time_column: str = "fetched_at",
) -> DataFrame:
    """Per capture: id, host, fetched_at, n_active, blocked_by (lists), allowed, blocked.

    ``n_active`` counts the active (list, pattern) pairs that the host or a parent domain matches. A capture
    is blocked when any list but ``allow`` matches and ``allow`` does not. Captures without host or fetch
    time match nothing. Repeated captures are judged one by one where their rows differ, and once as often
    as they stand there; no captures give no rows and no entries block nothing.
    """
    rows = captures.select(
        F.col(id_column).alias("id"),
        host_of(F.col(url_column)).alias("host"),
        F.col(time_column).cast("timestamp").alias("fetched_at"),
    )
    asked = rows.filter(F.col("host").isNotNull() & F.col("fetched_at").isNotNull())
    # Captures of a host at one moment get one answer.
    moments = asked.select("host", "fetched_at").distinct()
    valid = stored(intervals(entries), "url-intervals")
    listed = _each_salt(stored(valid.select("pattern").distinct(), "url-patterns"))
    salted = moments.withColumn("salt", F.pmod(F.xxhash64("host", "fetched_at"), F.lit(SALTS)).cast("int"))
    points = salted.withColumn("pattern", F.explode(domains(F.col("host")))).withColumn("day", _day("fetched_at"))
    points = stored(points.join(listed, ["pattern", "salt"], "left_semi"), "url-points")
    # Only days on which a listed pattern is asked for; narrow rows, reduced before they move.
    days = points.select("pattern", "day").distinct()
    low, high = points.agg(F.min("day"), F.max("day")).first()
    levels = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS - 1)),
        lambda n: F.struct(n.alias("level"), F.call_function("shiftright", F.col("day"), n).alias("block")),
    )
    first = F.greatest(_day("valid_from"), F.lit(low or 0))
    end = F.least(F.coalesce(_day("valid_to"), F.lit(high or 0)), F.lit(high or 0)) + 1
    covered = valid.select("list", "pattern", "valid_from", "valid_to", F.inline(_blocks(first, end)))
    in_day = days.select("pattern", "day", F.inline(levels)).join(covered, ["pattern", "level", "block"]).drop("level", "block")
    in_day = _each_salt(stored(in_day, "url-days"))
    active = points.join(in_day, ["pattern", "day", "salt"]).filter(
        (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    )
    answers = active.groupBy("host", "fetched_at").agg(
        F.count("*").alias("n_active"),
        F.array_sort(F.collect_set(F.when(F.col("list") != ALLOW, F.col("list")))).alias("blocked_by"),
        F.max(F.col("list") == ALLOW).alias("allowed"),
    )
    judged = asked.join(stored(answers, "url-answers"), ["host", "fetched_at"], "left").select("id", "host", "fetched_at", "n_active", "blocked_by", "allowed")
    none = rows.filter(F.col("host").isNull() | F.col("fetched_at").isNull()).select(
        "id", "host", "fetched_at", F.lit(None).cast("long").alias("n_active"), F.lit(None).cast("array<string>").alias("blocked_by"), F.lit(None).cast("boolean").alias("allowed")
    )
    allowed = F.coalesce("allowed", F.lit(False))
    lists = F.coalesce("blocked_by", F.array().cast("array<string>"))
    return judged.unionAll(none).select(
        F.col("id").alias(id_column),
        "host",
        "fetched_at",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        lists.alias("blocked_by"),
        allowed.alias("allowed"),
        ((F.size(lists) > 0) & ~allowed).alias("blocked"),
    )
