"""Benchmark decontamination with one Aho-Corasick automaton.

Normalised texts are ASCII-lowercased words joined by single spaces. The patterns are every second
half-window of the items (each window of consecutive item words holds one whole), or the whole of an
item shorter than a window. One scan of the normalised text finds all of them, overlapping ones too;
around each the words of text and item are compared as far as they agree, which gives every
occurrence of every window. Word numbers lead back to character offsets of the original text. A benchmark
beyond ``BLOCK_BYTES`` is dealt to blocks by hash; only one block is held and broadcast at a time, each is
an automaton of its own that a worker builds once, and what the passes find is joined by row.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import in_arrow, slices, stored_narrow
from tickloom.session import stored

WINDOW = 10

# Bytes of item text in one automaton (its nodes take some 50 times as much in a task).
BLOCK_BYTES = 4 << 20

# ASCII letters (folded), digits and all bytes of non-ASCII characters make words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_RUN = "struct<first: int, end: int, start: int, stop: int>"
_FOUND = f"id long, key long, n_words long, items array<string>, runs array<{_RUN}>"
_RUNS = pa.list_(pa.struct([(name, pa.int32()) for name in ("first", "end", "start", "stop")]))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


def joined(own: list[bytes]) -> str:
    """Words with a space at either end and between; one character a byte."""
    return f" {b' '.join(own).decode('latin-1')} "


class Items:
    """A block of items and the automaton over their patterns."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int):
        self.items, self.width = items, width
        half = (width + 1) // 2
        places: dict[str, list[tuple[int, int, int]]] = {}
        for number, (_, own) in enumerate(items):
            if len(own) < width:
                places.setdefault(joined(own), []).append((number, 0, len(own)))
                continue
            for at in range(0, len(own) - half + 1, half):
                places.setdefault(joined(own[at : at + half]), []).append((number, at, half))
        self.automaton = ahocorasick.Automaton()
        for pattern, found in places.items():
            self.automaton.add_word(pattern, (len(pattern), found))
        self.automaton.make_automaton()

    def occurrences(self, text: str, own: list[bytes]) -> list[tuple[int, int, str]]:
        """(first word, end word, item) of every longest run of words that an item shares with the text."""
        if not self.items:
            return []
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        starts: list[int] = []
        for end, (size, places) in self.automaton.iter(text):
            starts = starts or [m.start() for m in re.finditer(" ", text)]
            first = bisect_left(starts, end + 1 - size)
            for number, at, n in places:
                runs = found.setdefault((number, first - at), [])
                if runs and first + n <= runs[-1][1]:
                    continue  # inside the run found before on the same alignment
                item = self.items[number][1]
                a, b, left, right = first, first + n, at, at + n
                while a and left and own[a - 1] == item[left - 1]:
                    a, left = a - 1, left - 1
                while b < len(own) and right < len(item) and own[b] == item[right]:
                    b, right = b + 1, right + 1
                runs.append((a, b))
        return [
            (a, b, self.items[number][0])
            for (number, _), runs in found.items()
            for a, b in runs
            if b - a >= min(self.width, len(self.items[number][1]))
        ]


# The automaton in use, kept between the tasks of one worker.
_LAST: dict[str, Items] = {}


def _built(key: str, block: Broadcast, width: int) -> Items:
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Items(block.value, width)
    return _LAST[key]


def merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def original_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets [start, end) in the original text of runs of word numbers."""
    edges = [m.span() for m in WORD.finditer(raw)]
    spans, chars, at = [], 0, 0
    for first, end in runs:
        start, stop = edges[first][0], edges[end - 1][1]
        chars += len(raw[at:start].decode("utf-8"))
        length = len(raw[start:stop].decode("utf-8"))
        spans.append((chars, chars + length))
        chars, at = chars + length, stop
    return spans


def _scan(docs: DataFrame, items: list[tuple[str, list[bytes]]], width: int) -> DataFrame:
    """(id, key, n_words, items, runs) of every row against one block of items."""
    key, block = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(items)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices(batch, "body"):
                known = _built(key, block, width)
                normal = [words(raw) for raw in raws]
                hits = [known.occurrences(joined(own), own) for own in normal]
                runs = [merged((a, b) for a, b, _ in found) for found in hits]
                spans = [original_spans(raw, own) if own else [] for raw, own in zip(raws, runs)]
                placed = [[(*run, *span) for run, span in zip(*pair)] for pair in zip(runs, spans)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("key"),
                        pa.array([len(own) for own in normal], pa.int64()),
                        pa.array([sorted({item for _, _, item in found}) for found in hits], pa.list_(pa.string())),
                        pa.array([[dict(zip(("first", "end", "start", "stop"), run)) for run in own] for own in placed], _RUNS),
                    ],
                    ["id", "key", "n_words", "items", "runs"],
                )

    return in_arrow(docs, scan, _FOUND)


def _together(runs: Column) -> Column:
    """Sorted runs as one where they meet."""

    def add(done: Column, run: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(
            last["first"].alias("first"),
            F.greatest(last["end"], run["end"]).alias("end"),
            last["start"].alias("start"),
            F.greatest(last["stop"], run["stop"]).alias("stop"),
        )
        apart = (F.size(done) == 0) | (run["first"] > last["end"])
        return F.when(apart, F.concat(done, F.array(run))).otherwise(F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)))

    return F.aggregate(F.sort_array(runs), F.array().cast(f"array<{_RUN}>"), add)


def _joined(passes: list[DataFrame]) -> DataFrame:
    """One row per document from those of every pass. Repeated rows have one answer."""
    more = reduce(DataFrame.unionAll, [rows.filter(F.size("items") > 0).select("id", "key", "items", "runs") for rows in passes[1:]])
    more = more.distinct().groupBy(F.col("id").alias("hit_id"), F.col("key").alias("hit_key")).agg(
        F.flatten(F.collect_list("items")).alias("more_items"), F.flatten(F.collect_list("runs")).alias("more_runs")
    )
    first = passes[0]
    both = first.join(stored_narrow(more, "contamination-hits"), first["id"].eqNullSafe(F.col("hit_id")) & (first["key"] == F.col("hit_key")), "left")
    items = F.array_sort(F.array_distinct(F.concat("items", F.coalesce("more_items", F.array().cast("array<string>")))))
    runs = _together(F.concat("runs", F.coalesce("more_runs", F.array().cast(f"array<{_RUN}>"))))
    return both.select("id", "key", "n_words", items.alias("items"), F.when(F.col("more_runs").isNull(), F.col("runs")).otherwise(runs).alias("runs"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    key_column: str | None = None,
) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items, spans (characters of the original), items_sha256, contaminated.

    A word is hit when it lies inside an occurrence of ``width`` consecutive words of an item, or of a
    whole item that is shorter. Null and empty texts have no words; items without words have no window;
    null item ids read as the empty name. Repeated rows are judged one by one; an empty benchmark hits
    nothing; no documents give no rows. Documents are scanned whole, once for each block of about ``block_bytes``
    of items, and are not shuffled; with several blocks what was found is written and joined. ``key_column`` names
    a column for the 64-bit hash of the row's text (``xxhash64``), which with the id tells the row that was judged.
    """
    name, text = F.coalesce(F.col(item_column).cast("string"), F.lit("")), F.col(item_text_column)
    asked = benchmark.filter(text.isNotNull()).select(name.alias("name"), text.alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    deal = F.pmod(F.xxhash64("name", "text"), F.lit(blocks))
    body = F.col(text_column)
    narrow = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(body).alias("key"), body.alias("body"))
    passes = []
    for number in range(blocks):
        block = [(row["name"], words(row["text"].encode())) for row in asked.filter(deal == number).collect()]
        rows = _scan(narrow, [(item, own) for item, own in block if own], width)
        passes.append(stored(rows, "contamination-pass") if blocks > 1 else rows)
    found = passes[0] if blocks == 1 else _joined(passes)
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda total, run: total + run["end"] - run["first"])
    judged = found.withColumn("n_hit", hit)
    return judged.select(
        F.col("id").alias(id_column),
        *([F.col("key").alias(key_column)] if key_column else []),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.transform("runs", lambda run: F.struct(run["start"].alias("start"), run["stop"].alias("end"))).alias("spans"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
