"""Exact dedup by content sort.

Texts are range-partitioned by sampled splitters over their leading bytes, refined by a hash
of the whole text and by the id, so that neither a shared beginning nor one text that a third
of the rows have makes a partition large. Spark's external sort then places equal texts next
to each other, and every text is compared in full with its neighbour. A group may run over
several partitions: of each partition only the first and the last run are looked at again,
one row each, and their texts are compared in full too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.tables import in_arrow, stored_narrow
from tickloom.session import stored

# Bytes of a text that go into a splitter; the sample of splitters on the driver stays small.
SPLITTER_BYTES = 32

# Place of a run in its partition.
INNER, HEAD, TAIL, WHOLE = 0, 1, 2, 3

_DECISIONS = "id long, keep_id long, size long, first boolean, sha string, part int, edge int, body string"
_DECISION_SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("keep_id", pa.int64()),
        ("size", pa.int64()),
        ("first", pa.bool_()),
        ("sha", pa.string()),
        ("part", pa.int32()),
        ("edge", pa.int32()),
        ("body", pa.string()),
    ]
)


def _sorted(docs: DataFrame, id_column: str, text_column: str, keep: str, normalise, *extra: Column) -> DataFrame:
    """Equal texts side by side, the one to keep first; null texts are empty, null ids come last."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), (normalise(text) if normalise else text).alias("body"), *extra
    )
    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    head = F.substring(F.col("body").cast("binary"), 1, SPLITTER_BYTES)
    rows = rows.withColumn("head", head).withColumn("mix", F.xxhash64("body"))
    ranged = rows.repartitionByRange("head", "mix", order)
    return ranged.sortWithinPartitions("head", "mix", "body", order)


def _starts(body: pa.Array, before: str | None) -> np.ndarray:
    """Rows whose text differs from the one above."""
    new = np.ones(len(body), bool)
    if len(body) > 1:
        new[1:] = pc.not_equal(body.slice(1), body.slice(0, len(body) - 1)).to_numpy(zero_copy_only=False)
    new[0] = before is None or body[0].as_py() != before
    return np.flatnonzero(new)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text with its run's size and first id. Held back are only the ids of the open run."""
    part = TaskContext.get().partitionId()
    ids: list[pa.Array] = []
    shas: list[str] = []
    text: str | None = None
    head = True

    def emit(ids: pa.Array, starts: np.ndarray, shas: list[str], first_edge: int, bodies: list[str | None]):
        sizes = np.diff(np.append(starts, len(ids)))
        run = np.repeat(np.arange(len(starts)), sizes)
        first = np.zeros(len(ids), bool)
        first[starts] = True
        edge = np.zeros(len(ids), np.int32)
        edge[: sizes[0]] = first_edge
        body = np.full(len(ids), None, object)
        body[starts] = bodies
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                ids.take(pa.array(starts[run])),
                pa.array(sizes[run], pa.int64()),
                pa.array(first),
                pa.array(shas, pa.string()).take(pa.array(run)),
                pa.array(np.full(len(ids), part, np.int32)),
                pa.array(edge),
                pa.array(body, pa.string()),
            ],
            schema=_DECISION_SCHEMA,
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        body, own = batch.column("body"), batch.column("id")
        starts = _starts(body, text)
        if len(starts):
            done = sum(map(len, ids))
            cut = int(starts[-1])
            sha = batch.column("sha")
            closed = [0] * bool(done) + [int(s) + done for s in starts[:-1]]
            if closed:
                joined = pa.concat_arrays([*ids, own.slice(0, cut)])
                names = shas + [sha[int(s)].as_py() for s in starts[:-1]]
                texts = [None] * len(closed)
                if head:
                    texts[0] = text if done else body[0].as_py()
                yield from emit(joined, np.array(closed), names, HEAD if head else INNER, texts)
                head = False
            ids, shas, text = [own.slice(cut)], [sha[cut].as_py()], body[cut].as_py()
        else:
            ids.append(own)
    if ids:
        yield from emit(pa.concat_arrays(ids), np.array([0]), shas, WHOLE if head else TAIL, [text])


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of every run with all its columns. One row is held back, to know the last."""
    part = TaskContext.get().partitionId()
    held, text, began = None, None, False

    def marked(rows: pa.RecordBatch, first_edge: int) -> pa.RecordBatch:
        edge = np.full(rows.num_rows, INNER, np.int32)
        edge[0] = first_edge
        columns = [*rows.columns, pa.array(np.full(rows.num_rows, part, np.int32)), pa.array(edge)]
        return pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "part", "edge"])

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _starts(batch.column("body"), text)
        text = batch.column("body")[batch.num_rows - 1].as_py()
        if not len(starts):
            continue
        firsts = batch.take(pa.array(starts))
        for rows in (held, firsts.slice(0, firsts.num_rows - 1)):
            if rows is not None and rows.num_rows:
                yield marked(rows, INNER if began else HEAD)
                began = True
        held = firsts.slice(firsts.num_rows - 1)
    if held is not None:
        yield marked(held, TAIL if began else WHOLE)


def _merged(segments: DataFrame) -> DataFrame:
    """Runs at partition ends, joined where the text goes on in the next partition.

    ``segments`` has one row per such run: part, edge, size, keep_id, body. At most two a partition.
    """
    # Two rows a partition, without their texts, are put in order by one task; the texts of neighbours meet in a join.
    place = Window.orderBy("part", "edge")
    own = segments.select("part", "edge", "size", "keep_id")
    numbered = stored_narrow(own.withColumn("n", F.row_number().over(place)), "exact-ends")
    texts = numbered.select("n", "part", "edge").join(segments.select("part", "edge", "body"), ["part", "edge"]).select("n", "body")
    above = texts.select((F.col("n") + 1).alias("n"), F.col("body").alias("above"))
    same = texts.join(above, "n").filter(F.col("body") == F.col("above")).select("n", F.lit(True).alias("on"))
    goes_on = numbered.join(stored_narrow(same, "exact-same"), "n", "left").withColumn("on", F.coalesce("on", F.lit(False)))
    group = F.sum(F.when(F.col("on"), 0).otherwise(1)).over(Window.orderBy("n"))
    grouped = goes_on.withColumn("g", group)
    totals = grouped.groupBy("g").agg(
        F.sum("size").alias("group_size"), F.min(F.struct("n", "keep_id")).alias("first")
    )
    joined = grouped.join(totals, "g").select(
        "part", "edge", "group_size", F.col("first.keep_id").alias("group_keep"), (~F.col("on")).alias("leads")
    )
    return stored_narrow(joined, "exact-groups")


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256 of the normalised text.

    Of equal texts one row stays, the one with the smallest (or largest) id. Null text is the empty
    text and null ids lose against all others. Rows that repeat an id and text are copies too: one of
    them stays. No rows give no rows. Texts are sorted and compared whole, whatever their length; other columns are
    not looked at.
    """
    ordered = _sorted(docs, id_column, text_column, keep, normalise)
    ready = ordered.select("id", "body", F.sha2(F.col("body").cast("binary"), 256).alias("sha"))
    runs = stored(in_arrow(ready, _decide, _DECISIONS), "exact-runs")
    ends = runs.filter((F.col("edge") > INNER) & F.col("first")).select("part", "edge", "size", "keep_id", "body")
    groups = _merged(ends)

    def result(size: str, keep_id: str, kept: Column) -> list[Column]:
        return [
            F.col("id").alias(id_column),
            F.col(keep_id).alias("keep_id"),
            F.col(size).alias("group_size"),
            kept.alias("kept"),
            F.col("sha").alias("text_sha256"),
        ]

    inner = runs.filter(F.col("edge") == INNER).select(result("size", "keep_id", F.col("first")))
    outer = runs.filter(F.col("edge") > INNER).join(groups, ["part", "edge"])
    return inner.unionAll(outer.select(result("group_size", "group_keep", F.col("first") & F.col("leads"))))


def unique_rows(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The rows that stay, with all their columns. Texts cross the network once, or twice when normalised."""
    blank = "_".join(["null", *docs.columns])  # a name that no column has
    others = [name for name in docs.columns if normalise or name != text_column]
    carried = F.struct(
        *(F.col(f"`{name}`") for name in others), F.col(f"`{text_column}`").isNull().alias(blank)
    ).alias("doc")
    ordered = _sorted(docs, id_column, text_column, keep, normalise, carried).select("doc", "body")
    schema = T.StructType(ordered.schema.fields + [T.StructField(name, T.IntegerType()) for name in ("part", "edge")])
    rows = stored(in_arrow(ordered, _firsts, schema), "exact-rows")
    ends = rows.filter(F.col("edge") > INNER).select(
        "part", "edge", F.lit(1).cast("long").alias("size"), F.lit(0).cast("long").alias("keep_id"), "body"
    )
    again = _merged(ends).filter(~F.col("leads")).select("part", "edge")
    inner = rows.filter(F.col("edge") == INNER)
    outer = rows.filter(F.col("edge") > INNER).join(again, ["part", "edge"], "left_anti")
    text = F.when(~F.col("doc").getField(blank), F.col("body")).alias(text_column)
    columns = [
        text if name not in others else F.col("doc").getField(name).alias(name) for name in docs.columns
    ]
    return inner.select(columns).unionAll(outer.select(columns))
