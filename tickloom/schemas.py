"""Tick, envelope and table schemas as DDL text."""

from __future__ import annotations

# The keys every tick carries, in the order missing ones are reported.
TICK_FIELDS = ("symbol", "price", "open", "high", "low", "volume", "event_time")

# The payload schema of the window stream.
TICK_DDL = (
    "symbol STRING, price DOUBLE, open DOUBLE, high DOUBLE, low DOUBLE, volume BIGINT, event_time STRING"
)

# Fixed value: the longest symbol the price tables hold.
SYMBOL_LENGTH = 20

ENVELOPE_DDL = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value BINARY"
