"""Near-duplicate detection by a join over MinHash signature coordinates.

Documents with the same shingle set are one class and go on as one. Each class is posted under every
coordinate of its signature with the value it has there. Two sets of the wanted similarity agree in at
least T of K coordinates but for a negligible chance, so

* a class with fewer than T values that any other class shares has no partner (most end here);
* ordered from rare to common, two partners share one of the first ``m - T + 1`` of their m shared
  values, so only those are joined (prefix filter), and what many texts have in common stays out;
* first every posting is joined to its smallest member only; then postings whose members are already
  connected are skipped, and in the others only members of different components meet, those of the
  largest one not among themselves. A long posting is met block by block of its members, in as many tasks.

Where two members meet, parity sketches of their sets bound their similarity from above, so pairs that
cannot be links are turned down inside the join. What is left and agrees in at least T values is
confirmed on the full shingle sets. Components of the confirmed links are the answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.tables import in_arrow, slices, stored_narrow
from tickloom.session import stored

WORDS = 5
PERCENT = 80
COORDINATES = 64
# Chance that a pair at the wanted similarity agrees in too few coordinates.
MISS = 1e-9

# Bits of a sketch: each is the parity of the shingles that fall on it.
SKETCH_BITS = 2048

# Members of a posting that are compared with all the others in one place; a longer one is split in blocks.
MEMBERS = 1024

# A task hashes this many bytes of text at once.
HASH_BYTES = 1 << 20

# ASCII letters folded; blank, tab, line feed, vertical tab, form feed and return part words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))

_DRAW = np.random.default_rng(20240607)
_BYTE = _DRAW.integers(0, 2**64, 256, np.uint64)
_BASE, _SHORT = _DRAW.integers(0, 2**64, 2, np.uint64) | np.uint64(1)


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def match_threshold(coordinates: int, similarity: float, miss: float = MISS) -> int:
    """The most coordinates that a pair of this similarity agrees in with a chance of ``1 - miss`` at least."""
    below = 0.0
    for n in range(coordinates + 1):
        below += comb(coordinates, n) * similarity**n * (1 - similarity) ** (coordinates - n)
        if below > miss:
            return n
    return coordinates


def _hash_words(folded: bytes) -> np.ndarray:
    """A 64-bit hash for each word of a folded text: random numbers of its bytes times powers of their place."""
    data = np.frombuffer(folded, np.uint8)
    inside = data != 32
    if not inside.any():
        return np.empty(0, np.uint64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    kept = data[inside]
    starts = np.flatnonzero(first[inside])
    lengths = np.diff(np.append(starts, len(kept)))
    powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(lengths.max() - 1, _BASE)))
    place = np.arange(len(kept)) - np.repeat(starts, lengths)
    return _mixed(np.add.reduceat(_BYTE[kept] * powers[place], starts))


def word_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the words of one text, worked through in parts cut at blanks."""
    folded, parts, at = raw.translate(FOLD), [], 0
    while at < len(folded):
        end = len(folded) if len(folded) - at <= HASH_BYTES else folded.find(b" ", at + HASH_BYTES)
        end = len(folded) if end < 0 else end
        parts.append(_hash_words(folded[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_sets(raws: list[bytes], width: int) -> list[np.ndarray]:
    """Per text its distinct shingles as sorted 64-bit hashes.

    A text of fewer than ``width`` words, but not none, has one shingle: all its words.
    """
    weights = _odd(width, 11)
    if sum(map(len, raws)) <= 2 * HASH_BYTES:
        # Short texts together; the blank between them ends the last word of each.
        hashes = _hash_words(b" ".join(raws).translate(FOLD))
        counts = _word_counts(raws)
    else:
        own = [word_hashes(raw) for raw in raws]
        hashes, counts = np.concatenate(own), np.array([len(h) for h in own])
    ends = np.cumsum(counts)
    total = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for n in range(width if len(total) else 0):
        total += hashes[n : n + len(total)] * weights[n]
    out = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= width:
            out.append(np.unique(_mixed(total[end - count : end - width + 1])))
        elif count:
            out.append(_mixed((hashes[end - count : end] * weights[:count]).sum(keepdims=True) + _SHORT * np.array([count], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _word_counts(raws: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(raws).translate(FOLD) + b" ", np.uint8)
    inside = data != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = np.cumsum([0] + [len(raw) + 1 for raw in raws])
    seen = np.concatenate([[0], np.cumsum(first)])
    return np.diff(seen[bounds])


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Minima of each set under ``coordinates`` orders (rows of empty sets mean nothing)."""
    out = np.zeros((len(sets), coordinates), np.uint64)
    full = [n for n, own in enumerate(sets) if len(own)]
    if not full:
        return out
    values = np.concatenate([sets[n] for n in full])
    starts = np.cumsum([0] + [len(sets[n]) for n in full[:-1]])
    for n, (turn, times) in enumerate(zip(_odd(coordinates, 13), _odd(coordinates, 17))):
        # Folding with the order's own numbers also tells the coordinates apart.
        out[full, n] = np.minimum.reduceat((values ^ turn) * times, starts) ^ (turn >> np.uint64(1))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Parity bits of each set. Two sketches differ in no more bits than their sets in elements."""
    out = np.zeros((len(sets), SKETCH_BITS // 64), np.int64)
    for row, own in enumerate(sets):
        odd = np.bincount((own >> np.uint64(7)) % np.uint64(SKETCH_BITS), minlength=SKETCH_BITS) & 1
        out[row] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return out


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))


def _classes(sets: list[np.ndarray]) -> list[bytes | None]:
    return [hashlib.blake2b(own, digest_size=16).digest() if len(own) else None for own in sets]


def _signed(docs: DataFrame, width: int, coordinates: int) -> DataFrame:
    """Per row: id, key, n_shingles, class (digest of the set, null if empty) and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices(batch, "body", HASH_BYTES):
                sets = shingle_sets(raws, width)
                sizes = np.array([len(own) for own in sets])
                signed = signatures(sets, coordinates)[sizes > 0]
                columns = [
                    part.column("id"),
                    part.column("key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(_classes(sets), pa.binary()),
                    _lists(signed.ravel(), np.where(sizes > 0, coordinates, 0)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "n_shingles", "class", "signature"])

    return in_arrow(docs, run, "id long, key long, n_shingles long, class binary, signature array<long>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Per row whose text is of the ``class`` it came with: id, shingle set, its size and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices(batch, "body", HASH_BYTES):
                sets = shingle_sets(raws, width)
                sizes = np.array([len(own) for own in sets])
                lists = _lists(np.concatenate(sets), sizes)
                bits = _lists(sketches(sets).ravel(), np.full(len(sets), SKETCH_BITS // 64))
                columns = [part.column("id"), lists, pa.array(sizes, pa.int64()), bits]
                out = pa.RecordBatch.from_arrays(columns, ["id", "set", "n", "sketch"])
                meant = part.column("class").to_pylist()
                yield out.filter(pa.array([a == b for a, b in zip(meant, _classes(sets))], pa.bool_()))

    return in_arrow(docs, run, "id long, set array<long>, n long, sketch array<long>")


def _may_link(left: list[Column], right: list[Column], n: Column, m: Column, percent: int) -> Column:
    """False where sketch words rule out the similarity: sets that differ in d elements share (n + m - d) / 2."""
    differ = F.lit(0)
    for x, y in zip(left, right):
        differ = differ + F.bit_count(x.bitwiseXOR(y))
    # meet / union >= p / 100 with meet = (n + m - d) / 2 and union = (n + m + d) / 2
    return (n + m - differ) * 100 >= (n + m + differ) * percent


def _words(array: str) -> list[Column]:
    return [F.get(array, F.lit(n)) for n in range(SKETCH_BITS // 64)]


def _folded() -> list[Column]:
    """Half as many words: two parities make one. A join condition of this size is still compiled."""
    words = _words("sketch")
    half = len(words) // 2
    return [a.bitwiseXOR(b).alias(f"w{n}") for n, (a, b) in enumerate(zip(words[:half], words[half:]))]


def _shared(posts: DataFrame, least: int) -> DataFrame:
    """(id, posts): the values of each id that other ids share, rare ones first, where there are ``least`` of them."""
    common = posts.groupBy("post").agg(F.count("*").alias("n")).filter("n > 1")
    # At most one row per coordinate in the list of an id.
    own = posts.join(common, "post").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("own"))
    return own.filter(F.size("own") >= least).select("id", F.col("own.post").alias("posts"))


def _confirmed(pairs: DataFrame, known: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame:
    """The pairs (a, b) that agree in ``least`` values and whose sets are as similar as wanted."""

    def both(pairs: DataFrame, table: DataFrame) -> DataFrame:
        return pairs.join(table.alias("x"), F.col("a") == F.col("x.id")).join(table.alias("y"), F.col("b") == F.col("y.id"))

    agree = F.size(F.array_intersect("x.posts", "y.posts")) >= least
    may = _may_link(_words("x.sketch"), _words("y.sketch"), F.col("x.n"), F.col("y.n"), percent)
    close = both(pairs, known).filter(may & agree).select("a", "b")
    meet = F.size(F.array_intersect("x.set", "y.set")).cast("long")
    union = F.col("x.n") + F.col("y.n") - meet
    alike = both(stored_narrow(close, "near-close"), sets.select("id", "set", "n")).filter(meet * 100 >= union * percent)
    return stored_narrow(alike.select("a", "b"), "near-links")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    key_column: str | None = None,
) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reached over links), kept (id is component_id).

    Links join texts whose sets of ``words``-word shingles have a Jaccard similarity of ``percent`` or
    more. Words and shingles are compared by 64-bit hashes. Null texts and texts without words have no
    shingle and no link. Rows that repeat an id and text are one document; an id with several texts is judged
    text by text. A row without id belongs to the class of its text and is kept only if that has no id. No
    rows give no rows; other columns are not looked at. A text is held whole by its task, and its shingle set
    stands in one row. ``key_column`` names a column for the 64-bit hash of
    the row's text (``xxhash64``), which with the id tells the row that was judged.
    """
    least = match_threshold(coordinates, percent / 100)
    body = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(body).alias("key"), body.alias("body"))
    signed = stored(_signed(rows, words, coordinates).withColumn("row", F.monotonically_increasing_id()), "near-signed")
    worded = signed.filter(F.col("class").isNotNull())

    # One row per class goes on, one with the smallest id. From here to the groups "id" is the number of that
    # row in the table just written, so no two classes share one.
    classes = stored_narrow(
        worded.groupBy("class")
        .agg(F.min("id").alias("rep"), F.min_by("row", "id").alias("first"), F.count("*").alias("n"))
        .filter("rep is not null"),
        "near-classes",
    )
    more = classes.filter("n > 1").select("class", "first")
    copies = stored_narrow(
        worded.filter("id is not null").select("class", "row").join(more, "class").filter("row != first").select("row"),
        "near-copies",
    )
    singles = worded.filter("id is not null").join(copies, "row", "left_anti").select(F.col("row").alias("id"), "signature")

    posts = singles.select("id", F.explode("signature").alias("post"))
    first = stored_narrow(_shared(posts, least), "near-shared")
    # Without the classes that fell out, fewer values are shared.
    shared = _shared(first.select("id", F.explode("posts").alias("post")), least)
    shared = stored_narrow(shared.join(classes.select(F.col("first").alias("id"), "rep", "class"), "id"), "near-shared")
    # Other texts of these ids come along and are told apart by the class.
    wanted = shared.select("rep", "class", F.col("id").alias("first"))
    bodies = rows.join(wanted, rows["id"] == wanted["rep"]).select(F.col("first").alias("id"), "class", "body")
    sets = stored(_sets(bodies, words), "near-sets")
    known = stored_narrow(shared.drop("class").join(sets.select("id", "n", "sketch"), "id"), "near-known")
    prefix = F.slice("posts", F.lit(1), F.size("posts") - least + 1)
    postings = shared.select("id", "rep", F.explode(prefix).alias("post"))

    # Every posting against the member with the smallest id of its rows.
    centres = postings.groupBy("post").agg(F.min_by("id", "rep").alias("a"), F.count("*").alias("n")).filter("n > 1")
    near = postings.join(centres, "post").filter("id != a")
    near = near.select(F.least("id", "a").alias("a"), F.greatest("id", "a").alias("b")).distinct()
    links = _confirmed(near, known, sets, least, percent)
    reached = components(links)

    # What is still apart in a posting. The largest component in it meets the others, not itself.
    labelled = postings.join(reached, postings["id"] == reached["node"], "left").select(
        "post", "id", F.coalesce("label", "id").alias("label")
    )
    labelled = stored_narrow(labelled, "near-labelled")
    sizes = labelled.groupBy("post", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("post").agg(
        F.max(F.struct("n", "label")).alias("most"),
        F.count("*").alias("labels"),
        F.ceil(F.sum("n") / MEMBERS).alias("blocks"),
    )
    mixed = mixed.filter("labels > 1").select("post", F.col("most.label").alias("largest"), "blocks")
    apart = stored_narrow(labelled.join(mixed, "post").join(known.select("id", "n", *_folded()), "id"), "near-apart")
    left, right = ([F.col(f"{side}.{name}") for name in apart.columns if name[0] == "w"] for side in "xy")
    meet = (
        (F.col("x.post") == F.col("y.post"))
        & (F.col("x.block") == F.col("y.block"))
        & (F.col("x.label") != F.col("y.label"))
        & ((F.col("y.label") == F.col("y.largest")) | (F.col("x.id") < F.col("y.id")))
        & _may_link(left, right, F.col("x.n"), F.col("y.n"), percent)
    )
    # One side has a member in its own block, the other in every block, so a pair meets once.
    every = apart.filter("label != largest").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    once = apart.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    across = every.alias("x").join(once.alias("y"), meet)
    across = across.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    more_links = _confirmed(across, known, sets, least, percent)
    reached = components(links.unionAll(more_links))

    named = classes.join(reached, classes["first"] == reached["node"], "left").select("class", "rep", "first", "n", "label")
    named = named.filter("n > 1 or label is not null").withColumn("label", F.coalesce("label", "first"))
    named = stored_narrow(named, "near-named")
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    groups = stored_narrow(named.join(smallest, "label").select("class", "component_id"), "near-groups")
    own = ["id", "key", "n_shingles"]
    grouped = worded.join(groups, "class", "left").select(*own, F.coalesce("component_id", "id").alias("component_id"))
    alone = signed.filter(F.col("class").isNull()).select(*own, F.col("id").alias("component_id"))
    out = grouped.unionAll(alone)
    return out.select(
        F.col("id").alias(id_column),
        *([F.col("key").alias(key_column)] if key_column else []),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
