"""Texts that the corpus tests share."""

import hashlib

LONG = " ".join(f"w{n % 997}x{n % 13}" for n in range(60_000))

# Nulls, empty and very long texts, ties, repeated rows.
ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, LONG),
    (5, LONG),
    (6, "one two three"),
    (6, "one two three"),
    (None, "one two three"),
    (None, None),
    (7, "a\x00b é \U0001f600 tail"),
    (8, "x" * 300_000),
    (9, "line one is long enough to count as a run of its own here\n" * 3),
]


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()
