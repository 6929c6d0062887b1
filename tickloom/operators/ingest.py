"""Validation, load checks and the split into price rows and dead letters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import payload as P
from tickloom.functions.stamps import iso_timestamp, loaded_timestamp
from tickloom.schemas import SYMBOL_LENGTH, TICK_FIELDS

INSERTED = "inserted"
INVALID = "invalid"
LOAD_FAILED = "load_failed"

# The texts written to the dead letter.
NOT_AN_OBJECT = "Event payload is not a JSON object"
MISSING = "Missing required fields: "
BAD_NUMBER = "Numeric fields contain invalid values"
BLANK_SYMBOL = "Symbol is empty"

_PRICES = ("price", "open", "high", "low")

# A symbol that any rule accepts as it is, written the same as JSON text or as a value.
_ORDINARY_SYMBOL = r"^[A-Za-z^][A-Za-z0-9._^=-]{0,19}\z"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, and only where the result is asked for."""
    return F.transform(F.array(value), use)[0]


def _validation_error(tick: Column) -> Column:
    """First rule a tick breaks; NULL when it breaks none."""
    prices = F.array(*[tick[name] for name in _PRICES])
    symbol, volume = P.Loose(tick["symbol"]), P.Loose(tick["volume"])
    missing = P.missing_fields(tick, TICK_FIELDS)
    return (
        F.when(tick.isNull(), F.lit(NOT_AN_OBJECT))
        .when(missing != "", F.concat(F.lit(MISSING), missing))
        .when(~(F.forall(prices, lambda field: P.Loose(field).float_ok) & volume.int_ok), F.lit(BAD_NUMBER))
        .when(symbol.is_text & symbol.text.rlike(P.BLANK_TEXT), F.lit(BLANK_SYMBOL))
    )


def _too_long(symbol: Column) -> Column:
    """Longer than the column; blanks beyond its length do not count."""
    return F.rtrim(F.substring(symbol, SYMBOL_LENGTH + 1, 2**31 - 1)) != ""


def _load_error(tick: Column, values: Column) -> Column:
    """First column that would refuse a tick that passed validation; NULL when none does."""
    symbol, stamp = P.Loose(tick["symbol"]), P.Loose(tick["event_time"])
    scalar = symbol.is_text | symbol.is_number | symbol.is_boolean | symbol.is_null
    rule = (
        F.when(~scalar, F.lit("symbol is not a scalar"))
        .when(symbol.text.contains("\0"), F.lit("symbol holds a NUL character"))
        .when(_too_long(symbol.text), F.lit("symbol is too long"))
    )
    for place, name in enumerate(_PRICES):
        rule = rule.when(P.Loose(tick[name]).beyond_double, F.lit(f"{name} is out of range"))
        rule = rule.when(values["prices"][place].isNull(), F.lit(f"{name} is not numeric"))
    rule = rule.when(values["volume"].isNull(), F.lit("volume is not a bigint"))
    rule = rule.when(~stamp.is_null & values["event_time"].isNull(), F.lit("event_time is not a timestamp"))
    return F.concat(F.lit("Load error: "), rule)


def _values(tick: Column) -> Column:
    """What the columns of the price table would hold."""
    symbol, stamp = P.Loose(tick["symbol"]), P.Loose(tick["event_time"])
    return F.struct(
        F.substring(symbol.text, 1, SYMBOL_LENGTH).alias("symbol"),
        F.transform(F.array(*[tick[name] for name in _PRICES]), lambda field: P.Loose(field).as_price).alias("prices"),
        P.Loose(tick["volume"]).as_volume.alias("volume"),
        F.when(stamp.is_text, loaded_timestamp(stamp.text)).alias("event_time"),
    )


def _ruled(tick: Column) -> Column:
    """Values and first errors of a loosely read tick."""
    return _let(
        _values(tick),
        lambda values: F.struct(
            values.alias("values"),
            _validation_error(tick).alias("invalid"),
            _load_error(tick, values).alias("unloaded"),
        ),
    )


def _plain() -> Column:
    """True for a tick whose fields all have their types and need no further rule."""
    symbol = F.col("typed.symbol")
    present = [F.col(f"typed.{name}").isNotNull() for name in TICK_FIELDS[:-1]]
    return F.coalesce(
        reduce(lambda a, b: a & b, present)
        & F.col("typed_time").isNotNull()
        & symbol.rlike(_ORDINARY_SYMBOL),
        F.lit(False),
    )


def classify(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per message with ``status``, ``error_message`` and the converted tick fields.

    Envelope columns are carried along unchanged; the payload text is added as
    ``payload``. A narrow job with two speeds: a payload whose fields parse in their
    own types, with an ordinary symbol, is accepted as it is; only the others are
    parsed again field by field and put through the rules. The verdict leaves through
    a one-row generator, so that a filter on it is not pushed below the parse, which
    would then run twice.
    """
    envelope = [name for name in messages.columns if name != value]
    text = F.try_validate_utf8("payload")
    typed = messages.select(*envelope, F.col(value).cast("string").alias("payload")).select(
        *envelope, "payload", P.typed_tick(text).alias("typed")
    )
    timed = typed.select("*", iso_timestamp(F.col("typed.event_time")).alias("typed_time"))
    marked = timed.select("*", _plain().alias("plain"))
    judged = marked.select("*", F.when(~F.col("plain"), _let(P.loose_tick(text), _ruled)).alias("ruled"))

    def either(plain: Column, slow: Column) -> Column:
        return F.when(F.col("plain"), plain).otherwise(slow)

    verdict = F.struct(
        F.when(F.col("ruled.invalid").isNotNull(), INVALID)
        .when(F.col("ruled.unloaded").isNotNull(), LOAD_FAILED)
        .otherwise(INSERTED)
        .alias("status"),
        F.coalesce("ruled.invalid", "ruled.unloaded").alias("error_message"),
    )
    price_columns = ("price", "open_price", "high_price", "low_price")
    return judged.select("*", F.explode(F.array(verdict)).alias("verdict")).select(
        *envelope,
        "payload",
        "verdict.*",
        either(F.col("typed.symbol"), F.col("ruled.values.symbol")).alias("symbol"),
        *[
            either(F.col(f"typed.{field}"), F.col("ruled.values.prices")[place]).alias(column)
            for place, (field, column) in enumerate(zip(_PRICES, price_columns))
        ],
        either(F.col("typed.volume"), F.col("ruled.values.volume")).alias("volume"),
        either(F.col("typed_time"), F.col("ruled.values.event_time")).alias("event_time"),
    )


def price_rows(classified: DataFrame, *extra: str) -> DataFrame:
    """The accepted branch in the columns of the price table."""
    return classified.where(F.col("status") == INSERTED).select(
        "symbol", "price", "open_price", "high_price", "low_price", "volume", "event_time", *extra
    )


def dead_letters(classified: DataFrame, *extra: str) -> DataFrame:
    """The refused branch: where the message came from, why it was refused, its raw text."""
    return classified.where(F.col("status") != INSERTED).select(
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        "error_message",
        "payload",
        *extra,
    )


def split_counts(classified: DataFrame) -> DataFrame:
    """Messages per status and error; the counts add up to the input."""
    return classified.groupBy("status", "error_message").agg(F.count(F.lit(1)).alias("messages"))
