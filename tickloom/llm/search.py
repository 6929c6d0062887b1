"""Ranked lexical search of items among all documents, over classes of equal bags.

Bag deduplication: of a document only the terms of the items count, so it becomes a vector of (term, times)
and its length class ``m``. Equal vectors with equal ``m``, found by hash and held against each other in
full, score alike for every item; each such class is scored once. The best classes are then expanded into
their documents by ascending id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.tables import in_arrow, slices, stored_narrow
from tickloom.session import stored

# Items go through the documents in blocks of about so many bytes of text.
BLOCK_BYTES = 8 << 20

# A text is cut into words in parts of about this many bytes.
PART_BYTES = 1 << 20

# Single scores, and single contributions to them, that a task holds at once.
CELLS = 1 << 20
CONTRIBUTIONS = 1 << 21

# Parts in which the members of a class are looked up.
MEMBER_PARTS = 16

# Terms are made of these bytes; A-Z are read as a-z and all others part terms.
_LETTERS = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 32 for b in range(256))


def term_lists(raw: bytes, part_bytes: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text, in parts that end between terms."""
    plain = raw.translate(_PLAIN)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + part_bytes)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def bag(raw: bytes, number: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """Terms of a text, and how often each numbered one stands there."""
    total, counts = 0, Counter()
    for terms in term_lists(raw):
        total += len(terms)
        counts.update(map(number.get, terms))
    counts.pop(None, None)
    return total, counts


class Items:
    """The items of a block: their terms numbered, and for each term the items that hold it with their counts."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.names = [name for name, _ in items]
        counts = [Counter(term for part in term_lists(raw) for term in part) for _, raw in items]
        self.number = {term: n for n, term in enumerate(sorted(set().union(*counts)))}
        held = sorted((self.number[term], item, times) for item, own in enumerate(counts) for term, times in own.items())
        places = np.array(held, np.int64).reshape(-1, 3)
        self.start = np.searchsorted(places[:, 0], np.arange(len(self.number) + 1))
        self.item, self.times = places[:, 1], places[:, 2]


def term_weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def class_scores(items: Items, weights: np.ndarray, sizes: np.ndarray, terms: np.ndarray, times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores (bags, items) in whole numbers; bags of ``sizes`` terms lie one after the other, each with its ``m``."""
    out = np.zeros((len(sizes), len(items.names)), np.int64)
    flat = out.reshape(-1)
    own = np.repeat(np.arange(len(sizes)), sizes)
    times = times.astype(np.int64)
    gain = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 12 * m[own]))
    first, size = items.start[terms], np.diff(items.start)[terms]
    upto = np.cumsum(size)
    at = 0
    while at < len(terms):
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + CONTRIBUTIONS, "right")))
        many = size[at:end]
        pair = np.repeat(np.arange(at, end), many)
        place = np.arange(len(pair)) + np.repeat(first[at:end] - (upto[at:end] - many - before), many)
        np.add.at(flat, own[pair] * out.shape[1] + items.item[place], gain[pair] * items.times[place])
        at = end
    return out


class _Best:
    """The best classes of each item so far: (-score, no id, smallest id, class), in that order."""

    def __init__(self, items: int, limit: int):
        self.limit, self.rows = limit, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, firsts: list, classes: list[int]) -> None:
        for item in np.flatnonzero(scores.max(axis=0) >= self.least):
            column = scores[:, item]
            found = np.flatnonzero(column >= self.least[item])
            if len(found) > self.limit:
                bound = np.partition(column[found], -self.limit)[-self.limit]
                found = found[column[found] >= bound]
            rows = self.rows[item] + [(-int(column[n]), firsts[n] is None, firsts[n], classes[n]) for n in found]
            self.rows[item] = sorted(rows)[: self.limit]
            if len(self.rows[item]) == self.limit:
                self.least[item] = -self.rows[item][-1][0]


def _bags(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, times) of every document; the terms are numbers in ascending order."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices(batch, "body"):
                totals, terms, times = [], [], []
                for raw in raws:
                    total, counts = bag(raw, shared.value)
                    own = sorted(counts.items())
                    totals.append(total)
                    terms.append([term for term, _ in own])
                    times.append([n for _, n in own])
                columns = [part.column("id"), pa.array(totals, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "times"])

    counts = [T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType()))]
    return in_arrow(docs.select("id", "body"), run, T.StructType([docs.schema["id"], *counts]))


def _best_classes(classes: DataFrame, items: Items, weights: np.ndarray, limit: int) -> DataFrame:
    """(item, score, class, first) of the best classes per item, of each task on its own."""
    shared = classes.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = shared.value
        best = _Best(len(known.names), limit)
        step = max(1, CELLS // len(known.names))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                terms, times = part.column("terms"), part.column("times")
                sizes, m = terms.value_lengths().to_numpy(), part.column("m").to_numpy()
                scores = class_scores(known, weight, sizes, terms.flatten().to_numpy(), times.flatten().to_numpy(), m)
                best.add(scores, part.column("first").to_pylist(), part.column("class").to_pylist())
                kinds = [pa.int32(), pa.int64(), pa.int64(), batch.schema.field("first").type]
        rows = [(item, -score, number, first) for item, own in enumerate(best.rows) for score, _, first, number in own]
        if rows:
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "score", "class", "first"])

    schema = T.StructType(
        [T.StructField("item", T.IntegerType()), T.StructField("score", T.LongType()), T.StructField("class", T.LongType()), classes.schema["first"]]
    )
    return in_arrow(classes.select("class", "first", "terms", "times", "m"), run, schema)


def _ranked(rows: DataFrame, limit: int, *last: str) -> DataFrame:
    """The first ``limit`` rows of each item with their rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last(last[0]), *last[1:])
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def _search(docs: DataFrame, items: Items, limit: int) -> DataFrame:
    """(item, rank, id, score) for the items of one block."""
    bags = stored(_bags(docs, items.number), "search-bags")
    totals = bags.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
    documents, length = totals["documents"], max(1, totals["terms"] or 0)
    # As many rows as the block has terms.
    held = bags.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    frequency = np.zeros(len(items.number), np.int64)
    for row in held:
        frequency[row["term"]] = row["count"]

    vector = bags.filter(F.size("terms") > 0).withColumn("m", F.expr(f"75 + (25 * n * {documents}L) div {length}L"))
    vector = vector.select("id", "terms", "times", "m", F.xxhash64("terms", "times", "m").alias("hash"))
    same = ["hash", "terms", "times", "m"]
    classes = vector.groupBy(*same).agg(F.min("id").alias("first"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "search-classes")

    # A class stands at least as high as its first document, so no document of a later class can be among the first.
    found = stored_narrow(_best_classes(classes, items, term_weights(documents, frequency), limit), "search-found")
    best = stored_narrow(_ranked(found, limit, "first", "class").select("item", "score", "class"), "search-best")
    wanted = stored_narrow(classes.join(best.select("class").distinct(), "class").select("class", *same), "search-wanted")
    # A class may hold a third of all documents: its members are looked up, and limited, in parts.
    deal = F.pmod(F.xxhash64("id"), F.lit(MEMBER_PARTS)).cast("int")
    parts = wanted.withColumn("part", F.explode(F.array(*[F.lit(n) for n in range(MEMBER_PARTS)])))
    members = vector.withColumn("part", deal).join(parts, [*same, "part"])
    for group in (["class", "part"], ["class"]):
        order = Window.partitionBy(*group).orderBy(F.asc_nulls_last("id"))
        members = members.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
    members = stored_narrow(members.select("class", "id", "place"), "search-members")
    return _ranked(best.join(members, "class"), limit, "id", "class", "place").select("item", "rank", "id", "score")


def search_items(
    docs: DataFrame,
    items: DataFrame,
    limit: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item, rank, id, score): for every item its ``limit`` documents with the highest scores above 0.

    Equal scores go by ascending id, null ids last. Null and empty texts have no terms; an item without terms,
    or whose terms no document has, gives no row; no documents or no items give no rows. Rows that repeat an
    id are documents of their own, and items that repeat an id are ranked each on its own. Items pass in blocks
    of about ``block_bytes``, chosen by hash; only one block is held at a time, and each scans the documents
    once. A text is held whole by its task and cut into words in parts. Equal documents, however many, are one
    row before anything is scored, and only the first ``limit`` of a class are looked up. Ids may have any type
    that has an order; other columns are not looked at.
    """
    body = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("id"), body.alias("body"))
    asked = items.select(F.col(item_column).alias("name"), F.coalesce(F.col(item_text_column), F.lit("")).alias("body"))
    size = asked.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    deal = F.pmod(F.xxhash64(F.col("name").cast("string"), "body"), F.lit(blocks))
    results = []
    for number in range(blocks):
        held = Items([(row["name"], row["body"].encode()) for row in asked.filter(deal == number).collect()])
        if held.number:
            found = _search(rows, held, limit)
            schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", asked.schema["name"].dataType)])
            names = docs.sparkSession.createDataFrame(list(enumerate(held.names)), schema)
            results.append(found.join(F.broadcast(names), "item").select(F.col("name").alias(item_column), "rank", F.col("id").alias(id_column), "score"))
    if not results:
        kinds = [(item_column, asked.schema["name"].dataType), ("rank", T.IntegerType()), (id_column, rows.schema["id"].dataType), ("score", T.LongType())]
        return docs.sparkSession.createDataFrame([], T.StructType([T.StructField(*kind) for kind in kinds]))
    return reduce(DataFrame.unionAll, results)
