"""Each payload variation and what becomes of it."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from tickloom.functions.payload import loose_tick, typed_tick
from tickloom.operators import ingest
from tickloom.operators.parse import parse_ticks

GOOD = {
    "symbol": '"AAPL"',
    "price": "10.5",
    "open": "10.25",
    "high": "11",
    "low": "10.0",
    "volume": "1000",
    "event_time": '"2026-01-01T10:00:00.5+00:00"',
}
TIME = dt.datetime(2026, 1, 1, 10, 0, 0, 500000)


def tick(drop=(), tail="", **fields):
    body = {**GOOD, **fields}
    return "{" + ", ".join(f'"{k}": {v}' for k, v in body.items() if k not in drop) + tail + "}"


NOT_OBJECT = "Event payload is not a JSON object"
NUMERIC = "Numeric fields contain invalid values"

# name -> (payload, status, error, {column: value})
CASES = {
    "plain": (tick(), "inserted", None, {"symbol": "AAPL", "price": 10.5, "high_price": 11.0, "volume": 1000, "event_time": TIME}),
    "spaces around": ("  " + tick() + "\n", "inserted", None, {"symbol": "AAPL"}),
    "extra key": (tick(tail=', "venue": [1, {"a": 2}]'), "inserted", None, {"symbol": "AAPL"}),
    "not json": ("hello", "invalid", NOT_OBJECT, {}),
    "empty": ("", "invalid", NOT_OBJECT, {}),
    "null message": (None, "invalid", NOT_OBJECT, {}),
    "truncated": (tick()[:-1], "invalid", NOT_OBJECT, {}),
    "array": ("[" + tick() + "]", "invalid", NOT_OBJECT, {}),
    "scalar": ("5", "invalid", NOT_OBJECT, {}),
    "json null": ("null", "invalid", NOT_OBJECT, {}),
    "text after": (tick() + " tail", "invalid", NOT_OBJECT, {}),
    "two objects": (tick() + tick(), "invalid", NOT_OBJECT, {}),
    "two objects, comma": (tick() + "," + tick(), "invalid", NOT_OBJECT, {}),
    "brace after": (tick() + "}", "invalid", NOT_OBJECT, {}),
    "bracket after": (tick() + "]", "invalid", NOT_OBJECT, {}),
    "single quotes": (tick().replace('"', "'"), "invalid", NOT_OBJECT, {}),
    "one missing": (tick(drop=["high"]), "invalid", "Missing required fields: high", {}),
    "two missing": (tick(drop=["open", "volume"]), "invalid", "Missing required fields: open, volume", {}),
    "all missing": ("{}", "invalid", "Missing required fields: symbol, price, open, high, low, volume, event_time", {}),
    "other case": (tick(drop=["price"], Price="1"), "invalid", "Missing required fields: price", {}),
    "missing beats number": (tick(drop=["low"], price='"abc"'), "invalid", "Missing required fields: low", {}),
    "price text": (tick(price='"1.5"'), "inserted", None, {"price": 1.5}),
    "price text with blanks": (tick(price='" 1.5 "'), "inserted", None, {"price": 1.5}),
    "price exponent text": (tick(price='"15e-1"'), "inserted", None, {"price": 1.5}),
    "price underscore text": (tick(price='"1_000"'), "load_failed", "Load error: price is not numeric", {}),
    "price bad underscore": (tick(price='"1__0"'), "invalid", NUMERIC, {}),
    "price type suffix": (tick(price='"1d"'), "invalid", NUMERIC, {}),
    "price hex text": (tick(price='"0x10"'), "invalid", NUMERIC, {}),
    "price empty text": (tick(price='""'), "invalid", NUMERIC, {}),
    "price null": (tick(price="null"), "invalid", NUMERIC, {}),
    "price word": (tick(price='"abc"'), "invalid", NUMERIC, {}),
    "price array": (tick(price="[1]"), "invalid", NUMERIC, {}),
    "price object": (tick(price='{"a": 1}'), "invalid", NUMERIC, {}),
    "price true": (tick(price="true"), "load_failed", "Load error: price is not numeric", {}),
    "low true": (tick(low="true"), "load_failed", "Load error: low is not numeric", {}),
    "price NaN": (tick(price="NaN"), "inserted", None, {"price": math.nan}),
    "price NaN text": (tick(price='"NaN"'), "inserted", None, {"price": math.nan}),
    "price signed nan text": (tick(price='"-nan"'), "load_failed", "Load error: price is not numeric", {}),
    "price infinity text": (tick(price='"-inf"'), "inserted", None, {"price": -math.inf}),
    "price Infinity text": (tick(price='" Infinity "'), "inserted", None, {"price": math.inf}),
    "price text beyond a double": (tick(price='"1e400"'), "load_failed", "Load error: price is out of range", {}),
    "price text beyond a double, below": (tick(low='" -1e400 "'), "load_failed", "Load error: low is out of range", {}),
    "price text of many digits": (tick(price='"' + "9" * 400 + '"'), "load_failed", "Load error: price is out of range", {}),
    "price text at the limit": (tick(price='"1.7e308"'), "inserted", None, {"price": 1.7e308}),
    "price text near zero": (tick(price='"1e-400"'), "inserted", None, {"price": 0.0}),
    "volume text": (tick(volume='"10"'), "inserted", None, {"volume": 10}),
    "volume text with blanks": (tick(volume='" +10 "'), "inserted", None, {"volume": 10}),
    "volume fraction": (tick(volume="12.7"), "inserted", None, {"volume": 13}),
    "volume half": (tick(volume="-12.5"), "inserted", None, {"volume": -13}),
    "volume exponent": (tick(volume="1e3"), "inserted", None, {"volume": 1000}),
    "volume fraction text": (tick(volume='"12.7"'), "invalid", NUMERIC, {}),
    "volume underscore text": (tick(volume='"1_0"'), "load_failed", "Load error: volume is not a bigint", {}),
    "volume null": (tick(volume="null"), "invalid", NUMERIC, {}),
    "volume NaN": (tick(volume="NaN"), "invalid", NUMERIC, {}),
    "volume infinity": (tick(volume="Infinity"), "invalid", NUMERIC, {}),
    "volume true": (tick(volume="true"), "load_failed", "Load error: volume is not a bigint", {}),
    "volume at the limit": (tick(volume=str(2**63 - 1)), "inserted", None, {"volume": 2**63 - 1}),
    "volume too large": (tick(volume=str(2**63)), "load_failed", "Load error: volume is not a bigint", {}),
    "volume huge": (tick(volume="1" + "0" * 60), "load_failed", "Load error: volume is not a bigint", {}),
    "number beats symbol": (tick(volume="null", symbol='" "'), "invalid", NUMERIC, {}),
    "symbol null": (tick(symbol="null"), "inserted", None, {"symbol": None, "price": 10.5, "volume": 1000}),
    "symbol number": (tick(symbol="5"), "inserted", None, {"symbol": "5"}),
    "symbol true": (tick(symbol="true"), "inserted", None, {"symbol": "true"}),
    "symbol object": (tick(symbol='{"a": 1}'), "load_failed", "Load error: symbol is not a scalar", {}),
    "symbol array": (tick(symbol='["A"]'), "load_failed", "Load error: symbol is not a scalar", {}),
    "symbol object text": (tick(symbol='"{}"'), "inserted", None, {"symbol": "{}"}),
    "symbol blank": (tick(symbol='"   "'), "invalid", "Symbol is empty", {}),
    "symbol tab": (tick(symbol='" \\t "'), "invalid", "Symbol is empty", {}),
    "symbol wide blank": (tick(symbol='"\\u2003"'), "invalid", "Symbol is empty", {}),
    "symbol empty": (tick(symbol='""'), "invalid", "Symbol is empty", {}),
    "symbol 20": (tick(symbol='"' + "A" * 20 + '"'), "inserted", None, {"symbol": "A" * 20}),
    "symbol 21": (tick(symbol='"' + "A" * 21 + '"'), "load_failed", "Load error: symbol is too long", {}),
    "symbol 20 and newline": (tick(symbol='"' + "A" * 20 + '\\n"'), "load_failed", "Load error: symbol is too long", {}),
    "symbol 20 and blanks": (tick(symbol='"' + "A" * 20 + '   "'), "inserted", None, {"symbol": "A" * 20}),
    "symbol nul": (tick(symbol='"A\\u0000B"'), "load_failed", "Load error: symbol holds a NUL character", {}),
    "symbol padded": (tick(symbol='" AAPL "'), "inserted", None, {"symbol": " AAPL "}),
    "time null": (tick(event_time="null"), "inserted", None, {"event_time": None, "price": 10.5}),
    "time garbage": (tick(event_time='"garbage"'), "load_failed", "Load error: event_time is not a timestamp", {}),
    "time empty": (tick(event_time='""'), "load_failed", "Load error: event_time is not a timestamp", {}),
    "time number": (tick(event_time="5"), "load_failed", "Load error: event_time is not a timestamp", {}),
    "time of day only": (tick(event_time='"10:00"'), "load_failed", "Load error: event_time is not a timestamp", {}),
    "time offset": (tick(event_time='"2026-01-01T15:30:00.5+05:30"'), "inserted", None, {"event_time": TIME}),
    "time in digits": (tick(event_time='"20240101T100000"'), "inserted", None, {"event_time": dt.datetime(2024, 1, 1, 10)}),
    "time in digits to the minute": (tick(event_time='"20240101 1000"'), "inserted", None, {"event_time": dt.datetime(2024, 1, 1, 10)}),
    "date in digits": (tick(event_time='"20240101"'), "inserted", None, {"event_time": dt.datetime(2024, 1, 1)}),
    "month by name": (tick(event_time='"January 5, 2024 10:00:30"'), "inserted", None, {"event_time": dt.datetime(2024, 1, 5, 10, 0, 30)}),
    "month by short name": (tick(event_time='" 5 jan 2024 9:30"'), "inserted", None, {"event_time": dt.datetime(2024, 1, 5, 9, 30)}),
    "date with dashes": (tick(event_time='"5-Mar-2024"'), "inserted", None, {"event_time": dt.datetime(2024, 3, 5)}),
    "date with slashes": (tick(event_time='"2024/1/5 10:00"'), "inserted", None, {"event_time": dt.datetime(2024, 1, 5, 10)}),
    "digits that are no date": (tick(event_time='"20241301"'), "load_failed", "Load error: event_time is not a timestamp", {}),
    "time impossible": (tick(event_time='"2026-02-30T00:00:00+00:00"'), "load_failed", "Load error: event_time is not a timestamp", {}),
    "duplicate key": (tick(tail=', "price": 2.5'), "inserted", None, {"price": 2.5}),
    "duplicate key, last bad": (tick(tail=', "price": "abc"'), "invalid", NUMERIC, {}),
    "duplicate key, first bad": (tick(price='"abc"', tail=', "price": 3.5'), "inserted", None, {"price": 3.5}),
}

# What the window stream makes of a payload: None when the row has no event time.
STREAM = {
    "plain": {"symbol": "AAPL", "price": 10.5, "volume": 1000, "event_time": TIME},
    "not json": None,
    "empty": None,
    "array": None,
    "json null": None,
    "one missing": {"price": 10.5, "high": None},
    "price text": {"price": None, "volume": 1000},
    "volume text": {"volume": None, "price": 10.5},
    "volume fraction": {"volume": None},
    "price true": {"price": None},
    "price NaN": {"price": math.nan},
    "price NaN text": {"price": math.nan},
    "volume NaN": {"volume": None},
    "volume null": {"volume": None},
    "volume too large": {"volume": None},
    "symbol null": {"symbol": None, "price": 10.5},
    "symbol number": {"symbol": "5"},
    "symbol object": {"symbol": '{"a": 1}'},
    "symbol 21": {"symbol": "A" * 21},
    "symbol blank": {"symbol": "   "},
    "time garbage": None,
    "time null": None,
    "time of day only": None,
    "time offset": {"event_time": TIME},
    "duplicate key": {"price": 2.5},
}


def same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    if isinstance(a, str) and isinstance(b, str) and a[:1] == "{":
        return json.loads(a) == json.loads(b)
    return a == b


@pytest.fixture(scope="module")
def messages(spark):
    rows = [
        (name, "ticks", i % 4, i, None if case[0] is None else bytearray(case[0], "utf-8"))
        for i, (name, case) in enumerate(CASES.items())
    ]
    return spark.createDataFrame(rows, "name string, topic string, partition int, offset bigint, value binary")


@pytest.fixture(scope="module")
def classified(messages):
    return {row.name: row for row in ingest.classify(messages).collect()}


@pytest.mark.parametrize("name", CASES)
def test_consumer_rule(classified, name):
    payload, status, error, values = CASES[name]
    row = classified[name]
    assert (row.status, row.error_message, row.payload) == (status, error, payload)
    for column, value in values.items():
        assert same(row[column], value), (column, row[column], value)


@pytest.fixture(scope="module")
def parsed(messages):
    return {row.name: row for row in parse_ticks(messages, keep=("name",)).collect()}


@pytest.mark.parametrize("name", STREAM)
def test_stream_rule(parsed, name):
    row, expected = parsed[name], STREAM[name]
    if expected is None:
        assert row.event_time is None
        return
    for column, value in expected.items():
        assert same(row[column], value), (column, row[column], value)


def test_split_is_complete(messages):
    classified = ingest.classify(messages)
    good, bad = ingest.price_rows(classified), ingest.dead_letters(classified)
    assert good.count() + bad.count() == messages.count()
    assert sum(r.messages for r in ingest.split_counts(classified).collect()) == messages.count()
    assert bad.where("error_message IS NULL").count() == 0


def test_plain_rows_skip_the_rules_with_the_same_result(spark, messages, monkeypatch):
    """Sending every payload through the rules gives what the shortcut gives."""
    usual = sorted(map(str, ingest.price_rows(ingest.classify(messages), "name").collect()))
    monkeypatch.setattr(ingest, "_plain", lambda: ingest.F.lit(False))
    ruled = sorted(map(str, ingest.price_rows(ingest.classify(messages), "name").collect()))
    assert usual == ruled


def test_payload_is_parsed_once_per_speed(messages):
    plan = ingest.price_rows(ingest.classify(messages))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)


HOSTILE = {
    "bytes that are no text": b"\xff\xfe" + tick().encode(),
    "one bad byte in a symbol": tick(symbol='"A@"').encode().replace(b"@", b"\xff"),
    "deep nesting": tick(tail=', "x": ' + "[" * 3000 + "]" * 3000).encode(),
    "deep nesting in a field": tick(price="[" * 3000 + "]" * 3000).encode(),
    "number of 5000 digits": tick(volume="1" * 5000).encode(),
    "byte order mark": b"\xef\xbb\xbf" + tick().encode(),
    "other encoding": tick().encode("utf-16"),
    "leading nul": b"\x00" + tick().encode(),
}


def test_hostile_bytes_end_in_the_dead_letter(spark):
    rows = [(name, "ticks", 0, n, bytearray(value)) for n, (name, value) in enumerate(HOSTILE.items())]
    frame = spark.createDataFrame(rows, "name string, topic string, partition int, offset bigint, value binary")
    got = {r.name: r.error_message for r in ingest.classify(frame).select("name", "error_message").collect()}
    assert got == dict.fromkeys(HOSTILE, NOT_OBJECT)
    assert parse_ticks(frame).count() == len(HOSTILE)


def test_a_long_payload_is_read_whole(spark):
    value = bytearray(tick(tail=', "note": "' + "a" * 22_000_000 + '", "price": 77.5'), "utf-8")
    frame = spark.createDataFrame([("t", 0, 0, value)], "topic string, partition int, offset bigint, value binary")
    assert ingest.classify(frame).select("price").first().price == 77.5


@pytest.mark.parametrize("form", ['{t},"z":1', '{t},"tick":{t}', '{},"tick":{t}', '{},"z":1,"tick":{t}', '{t},{t}', '{t}],[{t}', '{t},"end":true}'])
def test_keys_behind_the_payload_make_no_tick(spark, form):
    """Text that would be valid inside another object is no JSON object by itself."""
    tick = '{"symbol":"A","price":1,"open":1,"high":1,"low":1,"volume":1,"event_time":"2024-01-01T00:00:00Z"}'
    payload = form.replace("{t}", tick)
    row = spark.createDataFrame([(payload,)], "p string").select(typed_tick(F.col("p")).alias("a"), loose_tick(F.col("p")).alias("b")).first()
    assert (row.a, row.b) == (None, None)
    whole = spark.createDataFrame([(tick,)], "p string").select(typed_tick(F.col("p")).alias("a")).first()
    assert whole.a.symbol == "A"
