"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A bare time of day would parse to today's date; insist on a full date first.
_DATE_FIRST = r"^\s*\d{4}-\d{2}-\d{2}"


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to an instant; NULL where it does not parse."""
    return F.when(text.rlike(_DATE_FIRST), text.try_cast("timestamp"))


# Other ways to write a time that a TIMESTAMP column takes.
_LOADED = (
    "yyyyMMdd['T'][ ]HHmmss",
    "yyyyMMdd['T'][ ]HHmm",
    "yyyyMMdd",
    "yyyy/M/d[ H:mm[:ss]]",
    "MMMM d[,] yyyy[ H:mm[:ss]]",
    "MMM d[,] yyyy[ H:mm[:ss]]",
    "d MMMM yyyy[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
)


def loaded_timestamp(text: Column) -> Column:
    """What a TIMESTAMP column makes of a text: ISO-8601, digits without separators, or the month by name.

    Texts that begin as ISO-8601 are tried as nothing else, so the other forms cost only those that need them.
    """
    trimmed = F.trim(text)
    other = F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(form)) for form in _LOADED])
    return F.when(text.rlike(_DATE_FIRST), iso_timestamp(text)).otherwise(other)


def iso_text(stamp: Column) -> Column:
    """UTC instant (session zone UTC) as ISO-8601 text with offset."""
    return F.concat(F.replace(stamp.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def micros(stamp: Column) -> Column:
    return F.unix_micros(stamp.cast("timestamp"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in seconds with its fraction."""
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def at_micros(value: Column) -> Column:
    return F.timestamp_micros(value)
