"""Reading a JSON tick: presence, types and the number texts that are accepted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import TICK_DDL, TICK_FIELDS

_ONE = {"allowSingleQuotes": "false"}
_STRICT = _ONE | {"columnNameOfCorruptRecord": "broken"}

# Texts a float or int conversion accepts: blanks around, single underscores between digits.
_DIGITS = r"[0-9](_?[0-9])*"
FLOAT_TEXT = (
    rf"(?iU)^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|nan|inf(inity)?)\s*$"
)
INT_TEXT = rf"(?U)^\s*[+-]?{_DIGITS}\s*$"

# Texts a numeric or bigint column accepts: no underscores, no sign before nan.
NUMERIC_TEXT = r"(?i)^\s*([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|nan|[+-]?inf(inity)?)\s*$"
BIGINT_TEXT = r"^\s*[+-]?[0-9]+\s*$"

BLANK_TEXT = r"(?U)^\s*$"


def _read(payload: Column, tick_ddl: str) -> Column:
    """Parse the payload as the value of a key with another key behind it.

    Text after the payload's object then breaks the outer object, hides the ``end`` key or
    adds keys of its own; ``_alone`` refuses the last.
    """
    wrapped = F.concat(F.lit('{"tick":'), payload, F.lit(',"end":true}'))
    return F.from_json(wrapped, f"tick STRUCT<{tick_ddl}>, end BOOLEAN, broken STRING", _STRICT)


def _alone(payload: Column) -> Column:
    """Whether the payload is one value: between brackets, keys behind it are no JSON and a second value counts."""
    wrapped = F.concat(F.lit("["), payload, F.lit("]"))
    return F.size(F.from_json(wrapped, "ARRAY<STRUCT<`-` STRING>>", _ONE)) == 1


def typed_tick(payload: Column) -> Column:
    """Struct of the fields in their column types; NULL unless every present field has its type."""
    read = _read(payload, TICK_DDL)
    return F.when(read.end & read.broken.isNull() & _alone(payload), read.tick)


def loose_tick(payload: Column) -> Column:
    """Struct with one VARIANT per field; NULL unless the payload is one JSON object.

    A missing key is SQL NULL, a JSON null is a VARIANT of type VOID, the last of
    duplicate keys wins and NaN tokens survive.
    """
    read = _read(payload, ", ".join(f"{name} VARIANT" for name in TICK_FIELDS))
    return F.when(read.end & _alone(payload), read.tick)


class Loose:
    """Rules on a VARIANT field, told apart by its type name.

    The names are STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, ARRAY<..> and OBJECT<..>.
    """

    def __init__(self, value: Column):
        self.value = value
        self.kind = F.schema_of_variant(value)

    @property
    def text(self) -> Column:
        return F.try_variant_get(self.value, "$", "string")

    @property
    def is_number(self) -> Column:
        return self.kind.isin("BIGINT", "DOUBLE") | self.kind.startswith("DECIMAL")

    @property
    def is_text(self) -> Column:
        return self.kind == "STRING"

    @property
    def is_boolean(self) -> Column:
        return self.kind == "BOOLEAN"

    @property
    def is_null(self) -> Column:
        return self.kind == "VOID"

    @property
    def float_ok(self) -> Column:
        """Would a float conversion take the value? Numbers, booleans and float texts do."""
        return self.is_number | self.is_boolean | (self.is_text & self.text.rlike(FLOAT_TEXT))

    @property
    def int_ok(self) -> Column:
        """Would an int conversion take the value? NaN and infinity do not, nor do texts with a fraction."""
        number = F.try_variant_get(self.value, "$", "double")
        endless = (self.kind == "DOUBLE") & (F.isnan(number) | (F.abs(number) == float("inf")))
        return (
            (self.is_number & ~endless) | self.is_boolean | (self.is_text & self.text.rlike(INT_TEXT))
        )

    @property
    def as_price(self) -> Column:
        """Value as stored in a price column, NULL where the column refuses it."""
        return F.when(self.is_number, F.try_variant_get(self.value, "$", "double")).when(
            self.is_text & self.text.rlike(NUMERIC_TEXT) & ~self.beyond_double, _trimmed(self.text).try_cast("double")
        )

    @property
    def beyond_double(self) -> Column:
        """A number text with digits that a double holds only as infinity, such as ``"1e400"``."""
        endless = F.abs(_trimmed(self.text).try_cast("double")) == float("inf")
        return self.is_text & self.text.rlike(NUMERIC_TEXT) & self.text.rlike("[0-9]") & endless

    @property
    def as_volume(self) -> Column:
        """Value as stored in a bigint column: fractions round half away from zero, NULL if out of range."""
        number = F.round(F.try_variant_get(self.value, "$", "decimal(38,18)"), 0).try_cast("bigint")
        return F.when(self.is_number, number).when(
            self.is_text & self.text.rlike(BIGINT_TEXT), _trimmed(self.text).try_cast("bigint")
        )


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def missing_fields(tick: Column, fields: Sequence[str]) -> Column:
    """Names of absent keys, in the given order, joined with a comma and a blank."""
    return F.concat_ws(", ", *[F.when(tick[name].isNull(), F.lit(name)) for name in fields])
