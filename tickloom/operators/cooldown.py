"""The cooldown gate: an event fires when the last fired one is at least a gap ago.

Each decision depends on the one before, yet no task sees more than a bounded part of them:

1. the instants of a key are numbered, and equally many in a row make a bin;
2. per bin, a step function tells for every last fired time before it which one a walk leaves it with.
   Steps of neighbouring bins are composed, ``FAN`` at a time, into those of wider ones, until one
   is left for each key;
3. the way down: a wide bin whose entry is known tells the entry of each bin inside it;
4. every bin is walked from its own entry.

All four run in parallel over (key, bin). Which last fired time matters is limited by the gap, so a step function has at
most as many steps as there are instants in one gap, and never more than a bin has rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.stamps import at_micros, micros
from tickloom.operators.counters import numbered
from tickloom.session import stored

# Instants of a bin, and bins that are composed or followed at once.
BIN_ROWS = 65_536
FAN = 32

_NEVER = -(2**62)


def _merged(upto: np.ndarray, exits: np.ndarray, first: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps with equal exits as one, without those that no walk can enter at which fired before ``first``."""
    last_of_step = np.append(exits[1:] != exits[:-1], True)
    upto, exits = upto[last_of_step], exits[last_of_step]
    reachable = int(np.searchsorted(upto, first + gap)) + 1
    return upto[:reachable], exits[:reachable]


def bin_steps(times: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the entry-to-exit function of the sorted distinct ``times`` of a bin.

    A walk whose first allowed time is at most ``upto[i]`` (and above ``upto[i-1]``) fires last at
    ``exits[i]``; beyond the last step it fires nothing.
    """
    size = len(times)
    following = np.searchsorted(times, times + gap)
    # Pointer doubling: jump to the following fired time until every walk has left the bin.
    end = np.where(following == size, np.arange(size), following)
    while not np.array_equal(end, end[end]):
        end = end[end]
    return _merged(times, times[end], int(times[0]), gap)


def leave(upto: np.ndarray, exits: np.ndarray, entries: np.ndarray, gap: int) -> np.ndarray:
    """Last fired time after a bin, for last fired times before it."""
    step = np.searchsorted(upto, entries + gap)
    return np.where(step < len(upto), exits[np.minimum(step, len(upto) - 1)], entries)


def composed(bins: list[tuple[np.ndarray, np.ndarray]], first: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps of consecutive bins as those of one that begins at ``first``."""
    upto, exits = bins[0]
    for more_upto, more_exits in bins[1:]:
        beyond = int(np.searchsorted(more_upto, upto[-1], "right"))
        exits = np.append(leave(more_upto, more_exits, exits, gap), more_exits[beyond:])
        upto, exits = _merged(np.append(upto, more_upto[beyond:]), exits, first, gap)
    return upto, exits


def fired_times(times: np.ndarray, allowed_from: int, gap: int) -> list[int]:
    """Times of sorted ``times`` that fire when nothing before ``allowed_from`` may."""
    fired = []
    at = int(np.searchsorted(times, allowed_from))
    while at < len(times):
        fired.append(int(times[at]))
        at = int(np.searchsorted(times, times[at] + gap))
    return fired


def binned(events: DataFrame, key: str, time: str, gap: int, last: DataFrame | None, bin_rows: int) -> DataFrame:
    """(key, us, bin): the instants that may fire, numbered and cut into bins of ``bin_rows``.

    Nothing fires before the gap after ``last`` is over, so these instants go; of the others the first one fires
    whatever came before, as in a walk that nothing fired before.
    """
    instants = events.select(key, micros(F.col(time)).alias("us"))
    if last is not None:
        before = last.groupBy(key).agg(F.max(micros(F.col("raised_at"))).alias("before"))
        free = F.col("before").isNull() | (F.col("us") >= F.col("before") + gap)
        instants = instants.join(before, key, "left").where(free).select(key, "us")
    placed = numbered(instants, ("us",), key)
    return placed.select(key, "us", F.expr(f"(processed - 1) div {bin_rows}").alias("bin"))


def cooled_instants(
    events: DataFrame,
    key: str,
    time: str,
    gap_seconds: int,
    last: DataFrame | None = None,
    bin_rows: int = BIN_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """(key, time) of the events that fire; ``last`` (key, raised_at) holds what fired before.

    ``events`` holds each (key, time) once; rows without a key do not fire.
    """
    gap = gap_seconds * 1_000_000
    schema_key = f"{key} {events.schema[key].dataType.simpleString()}"
    placed = binned(events, key, time, gap, last, bin_rows)
    wide = 1 + (placed.agg(F.max("bin")).first()[0] or 0)
    ddl = f"{schema_key}, bin bigint, first bigint, upto array<bigint>, exits array<bigint>"

    def row(frame: pd.DataFrame, number: int, first: int, steps: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({key: [frame[key].iloc[0]], "bin": [number], "first": [first], "upto": [steps[0]], "exits": [steps[1]]})

    def steps_of_bin(times: pd.DataFrame) -> pd.DataFrame:
        ordered = np.sort(times["us"].to_numpy())
        return row(times, times["bin"].iloc[0], int(ordered[0]), bin_steps(ordered, gap))

    def steps_of_block(bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("bin")
        first = int(bins["first"].iloc[0])
        pairs = [(np.asarray(u), np.asarray(e)) for u, e in zip(bins["upto"], bins["exits"])]
        return row(bins, bins["bin"].iloc[0] // fan, first, composed(pairs, first, gap))

    def follow(bins: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("bin")
        fired, entries = int(entry["last_fired"].iloc[0]), []
        for upto, exits in zip(bins["upto"], bins["exits"]):
            entries.append(fired)
            fired = int(leave(np.asarray(upto), np.asarray(exits), np.array([fired]), gap)[0])
        return pd.DataFrame({key: bins[key].to_numpy(), "bin": bins["bin"].to_numpy(), "last_fired": np.array(entries, "int64")})

    def walk(times: pd.DataFrame, entry: pd.DataFrame | None = None) -> pd.DataFrame:
        fired: list[int] = []
        if len(times):
            before = _NEVER if entry is None else int(entry["last_fired"].iloc[0])
            fired = fired_times(np.sort(times["us"].to_numpy()), before + gap, gap)
        row_key = times[key].iloc[0] if len(times) else None
        return pd.DataFrame({key: pd.Series([row_key] * len(fired), dtype=object), "us": np.array(fired, "int64")})

    # Up: the functions of every width that has more than one bin.
    levels = []
    functions = placed.where(F.col("bin").isNotNull()).groupBy(key, "bin").applyInPandas(steps_of_bin, ddl)
    while wide > 1:
        levels.append(stored(functions, "steps"))
        wide = -(-wide // fan)
        functions = levels[-1].groupBy(key, F.expr(f"bin div {fan}")).applyInPandas(steps_of_block, ddl)
    bins, walked = placed.where(F.col("bin").isNotNull()).groupBy(key, "bin"), f"{schema_key}, us bigint"
    if levels:
        # Down: nothing fired before the first bin of a key.
        entries = levels[-1].where("bin = 0").select(key, "bin", F.lit(_NEVER).alias("last_fired"))
        for level in reversed(levels):
            blocks = level.withColumn("block", F.expr(f"bin div {fan}"))
            inside = entries.withColumnRenamed("bin", "block")
            entries = (
                blocks.groupBy(key, "block")
                .cogroup(inside.groupBy(key, "block"))
                .applyInPandas(follow, f"{schema_key}, bin bigint, last_fired bigint")
            )
        fired = bins.cogroup(stored(entries, "entries").groupBy(key, "bin")).applyInPandas(walk, walked)
    else:
        fired = bins.applyInPandas(lambda times: walk(times), walked)
    back = at_micros(F.col("us")).cast(events.schema[time].dataType)
    return fired.select(key, back.alias(time))
