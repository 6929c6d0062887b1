"""Line dedup by a suffix array over line numbers. DataFrame functions only.

A text is the sequence of its lines that are not blank; a blank line goes with the line before it. Lines are
numbered by content, and only places whose line stands elsewhere too go on. Prefix doubling sorts their
suffixes: level j ranks every place by its next 2**j lines, from the ranks of level j - 1 at the place
itself and 2**(j-1) lines on, until no rank holds two places; the order is then the suffix array. Places of one
rank are an interval whose common prefix has 2**j lines at least. The exact common prefix of neighbours in the
array is put together from the levels, the longest first; the longer one of a place's two is the longest run
that begins there and stands elsewhere too. Runs that do not go on to the left either are the maximal ones.

Of every interval the first place stays and the later copies go. An interval of a longer prefix lies
inside one of a single line, so what goes is every line that stands earlier, in whatever run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored_narrow

PLACE = ["d", "pos"]

_BLANK = r"^[\x20\x09-\x0D]*\z"

# A key with more than this share of all rows is joined apart; there are at most so many of them.
HOT_KEYS = 1000

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once for each row."""
    return F.transform(F.array(value), use)[0]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _tokens(text: Column) -> Column:
    """For each line that is not blank: two hashes, and the lines [begin, end) that go with it."""

    def spread(own: Column) -> Column:
        placed = F.transform(own, lambda line, at: F.struct(line.alias("line"), at.alias("at")))
        return _let(F.filter(placed, lambda token: ~token["line"].rlike(_BLANK)), lambda found: named(own, found))

    def named(own: Column, found: Column) -> Column:
        return F.transform(
            found,
            lambda token, n: F.struct(
                F.xxhash64(token["line"]).alias("a"),
                F.xxhash64(F.lit(1), token["line"]).alias("b"),
                F.when(n == 0, 0).otherwise(token["at"]).alias("begin"),
                F.coalesce(F.get(found, n + 1)["at"], F.size(own)).alias("end"),
            ),
        )

    return _let(_lines(text), spread)


def _without(text: Column, gone: Column) -> Column:
    """The lines of a text that lie in none of the sorted spans [begin, end)."""

    def kept(own: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), F.transform(gone, lambda span: span["end"]))
        after = F.concat(F.transform(gone, lambda span: span["begin"]), F.array(F.size(own)))
        gaps = F.filter(F.arrays_zip(before.alias("s"), after.alias("e")), lambda gap: gap["e"] > gap["s"])
        return F.array_join(F.flatten(F.transform(gaps, lambda gap: F.slice(own, gap["s"] + 1, gap["e"] - gap["s"]))), "\n")

    return _let(_lines(text), kept)


def _ranked(rows: DataFrame, keys: list[str], label: str, least: int = 1) -> DataFrame:
    """Keys of ``rows`` that occur ``least`` times, with ``n`` and ranks in their order.

    Counting comes first, with partial sums; so equal keys, however many, are one row when they are sorted.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    ordered = counts.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored_narrow(ordered.withColumn("rank", F.monotonically_increasing_id()), label)


def _with_ranks(rows: DataFrame, keys: list[str], ranks: DataFrame) -> DataFrame:
    """``rows`` joined with the ranks of their keys; rows of very frequent keys are not gathered."""
    total = ranks.agg(F.sum("n")).first()[0] or 0
    # At most HOT_KEYS rows, as their counts add up to no more than all.
    hot = F.broadcast(stored_narrow(ranks.filter(F.col("n") * HOT_KEYS > total), "runs-hot"))
    few = rows.join(hot, keys)
    return rows.join(hot, keys, "left_anti").join(ranks, keys).unionByName(few)


def _levels(lines: DataFrame) -> list[DataFrame]:
    """Per level (d, pos, rank, n) of the places whose line is repeated; the last one has no rank twice."""
    names = _ranked(lines, ["a", "b"], "runs-ranks", least=2)
    levels = [stored_narrow(_with_ranks(lines.select(*PLACE, "a", "b"), ["a", "b"], names).select(*PLACE, "rank", "n"), "runs-level")]
    while not levels[-1].filter("n > 1").isEmpty():
        here, step = levels[-1], 2 ** (len(levels) - 1)
        ahead = here.select("d", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        pairs = here.select(*PLACE, F.col("rank").alias("this")).join(ahead, PLACE, "left")
        # A run that ends here, or goes on with a line that stands nowhere else, is like no other.
        alone = F.col("next").isNull()
        pairs = pairs.select(
            *PLACE,
            "this",
            F.coalesce("next", F.lit(-1)).alias("next"),
            F.when(alone, F.col("d")).otherwise(-1).alias("own_d"),
            F.when(alone, F.col("pos")).otherwise(-1).alias("own_pos"),
        )
        pairs, keys = stored_narrow(pairs, "runs-pairs"), ["this", "next", "own_d", "own_pos"]
        named = _with_ranks(pairs, keys, _ranked(pairs, keys, "runs-ranks"))
        levels.append(stored_narrow(named.select(*PLACE, "rank", "n"), "runs-level"))
    return levels


def _neighbours(order: DataFrame) -> DataFrame:
    """(d, pos, e, qos): every place but the last with the one that follows it in the suffix array."""
    part = F.shiftright("rank", _ROW_BITS)
    ends = order.groupBy(part.alias("part")).agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    # One row for each partition of the sort.
    over = ends.select("last", F.lead("first").over(Window.orderBy("part")).alias("jump")).filter("jump is not null")
    over = stored_narrow(over, "runs-ends")
    follower = order.select(F.col("rank").alias("at"), F.col("d").alias("e"), F.col("pos").alias("qos"))
    inside = order.withColumn("at", F.col("rank") + 1).join(follower, "at")
    across = order.join(over, F.col("rank") == F.col("last")).withColumn("at", F.col("jump")).join(follower, "at")
    return stored_narrow(inside.select(*PLACE, "e", "qos").unionAll(across.select(*PLACE, "e", "qos")), "runs-pairs")


def _common(pairs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``pairs`` with ``lines``, the length of the common prefix of the two places."""
    pairs = pairs.withColumn("lines", F.lit(0))
    for level in range(len(levels) - 1, -1, -1):
        shared = levels[level].filter("n > 1")
        one = shared.select("d", F.col("pos").alias("x"), F.col("rank").alias("one"))
        other = shared.select(F.col("d").alias("e"), F.col("pos").alias("y"), F.col("rank").alias("other"))
        moved = pairs.withColumns({"x": F.col("pos") + F.col("lines"), "y": F.col("qos") + F.col("lines")})
        met = moved.join(one, ["d", "x"], "left").join(other, ["e", "y"], "left")
        more = F.when(F.col("one") == F.col("other"), 2**level).otherwise(0)
        pairs = stored_narrow(met.select(*PLACE, "e", "qos", (F.col("lines") + more).alias("lines")), "runs-common")
    return pairs


def _longest(levels: list[DataFrame]) -> DataFrame:
    """(d, pos, lines): the longest run from each place that stands elsewhere too."""
    pairs = _common(_neighbours(levels[-1].select(*PLACE, "rank")), levels[:-1])
    both = pairs.select(*PLACE, "lines").unionAll(pairs.select(F.col("e").alias("d"), F.col("qos").alias("pos"), "lines"))
    return stored_narrow(both.groupBy(*PLACE).agg(F.max("lines").alias("lines")), "runs-longest")


def _maximal(longest: DataFrame) -> DataFrame:
    """Those of the longest runs that are not the rest of one that begins a line before."""
    before = longest.select("d", (F.col("pos") + 1).alias("pos"), (F.col("lines") - 1).alias("rest"))
    return longest.join(before, PLACE, "left").filter("rest is null or rest < lines").drop("rest")


class _Corpus:
    """The texts of a table as numbered documents and the places of their lines.

    ``texts`` has (doc, key, mark, weight) of the rows, ``copies`` the documents whose text an earlier one has,
    ``docs`` the others with their number ``d`` in the order of id and hash, null ids last.
    """

    def __init__(self, rows: DataFrame, id_column: str, text_column: str):
        text = F.col(text_column)
        rows = rows.filter(text.isNotNull()).select(
            F.col(id_column).alias("doc"), F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("mark"), text.alias("body")
        )
        order = F.struct(F.col("doc").isNull().alias("last"), "doc", "key")
        firsts = rows.groupBy("key", "mark").agg(F.min(order).alias("first"), F.count("*").alias("rows"))
        firsts = firsts.select("key", "mark", "first.last", "first.doc", "rows")
        ordered = firsts.repartitionByRange("last", "doc", "key").sortWithinPartitions("last", "doc", "key")
        self.docs = stored_narrow(ordered.withColumn("d", F.monotonically_increasing_id()), "runs-docs")
        several = self.docs.filter("rows > 1").select("key", "mark", F.col("doc").alias("kept"), F.col("rows").alias("n"))
        several = stored_narrow(several, "runs-several")
        copied = _with_ranks(rows.select("doc", "key", "mark"), ["key", "mark"], several)
        copied = copied.select("doc", "key", (~F.col("doc").eqNullSafe(F.col("kept"))).alias("later")).distinct()
        copied = stored_narrow(copied, "runs-copied")
        # Repeated rows of one document are no copies of each other.
        later = copied.filter("later")
        self.copied = copied.join(later.select("key").distinct(), "key", "left_semi")

        split = rows.select("doc", "key", "mark", F.posexplode(_tokens(F.col("body"))).alias("pos", "token"))
        lines = split.select("doc", "key", "mark", "pos", "token.*")
        later = later.select(F.col("doc").alias("later_doc"), F.col("key").alias("later_key"))
        lines = lines.join(later, F.col("doc").eqNullSafe(F.col("later_doc")) & (F.col("key") == F.col("later_key")), "left_anti")
        lines = lines.join(self.docs.select("key", "mark", "d"), ["key", "mark"])
        # Rows that repeat an id and text are one document.
        repeated = self.docs.filter("rows > 1").select("d")
        once = lines.select("d", "pos", "a", "b", "begin", "end")
        self.lines = stored_narrow(once.join(repeated, "d", "left_anti").unionByName(once.join(repeated, "d").dropDuplicates(PLACE)), "runs-lines")
        self.levels = _levels(self.lines)


def maximal_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_key, first_line, end_line, lines): the maximal repeated runs, place by place.

    ``lines`` counts lines that are not blank, ``first_line`` and ``end_line`` bound them in the text. A run is listed
    where it cannot be made longer in either direction and still stand elsewhere too. Texts that are equal are
    one here: theirs are the runs that other texts have part in.
    """
    corpus = _Corpus(docs, id_column, text_column)
    runs = _maximal(_longest(corpus.levels))
    first = corpus.lines.select("d", "pos", F.col("begin").alias("first_line"))
    last = corpus.lines.select("d", F.col("pos").alias("last"), F.col("end").alias("end_line"))
    placed = runs.withColumn("last", F.col("pos") + F.col("lines") - 1).join(first, PLACE).join(last, ["d", "last"])
    return placed.join(corpus.docs, "d").select(
        F.col("doc").alias(id_column), F.col("key").alias("text_key"), "first_line", "end_line", F.col("lines").cast("long").alias("lines")
    )


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_lines, n_removed, longest_run, spans removed (null for all lines) and the text without them.

    Of every run of lines that stands again the first copy stays and the later ones go, in whatever document;
    earlier is by id (null last), then by hash of the text, then by line. Blank lines (ASCII white space only)
    make no run; one goes with the line before it, or with the first line where there is none. ``longest_run`` is the
    length of the longest run of the text that stands elsewhere too, in lines that are not blank, 0 for none.
    Null texts have no lines and stay null; an empty text is one empty line and keeps it. Rows that
    repeat an id and text are one document and are treated alike. No rows give no rows; ids may have any type that
    has an order; other columns are not looked at. A very long text is split and put together within
    its row; its lines are sorted as rows like those of all others.
    """
    corpus = _Corpus(docs, id_column, text_column)
    place = corpus.levels[0].select("rank", F.struct(*PLACE).alias("place"))
    first = place.groupBy("rank").agg(F.min("place").alias("first"))
    stays = first.select("first.*")
    gone = corpus.levels[0].select(*PLACE).join(stays, PLACE, "left_anti").join(corpus.lines.select(*PLACE, "begin", "end"), PLACE)
    spans = gone.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    longest = _maximal(_longest(corpus.levels)).groupBy("d").agg(F.max("lines").alias("lines"))
    found = spans.join(longest, "d", "full").join(corpus.docs.select("d", "doc", "key"), "d").select("doc", "key", "spans", "lines")
    found = found.withColumn("later", F.lit(None).cast("boolean"))
    copied = corpus.copied.select("doc", "key", F.lit(None).cast(found.schema["spans"].dataType).alias("spans"), F.lit(None).cast("int").alias("lines"), "later")
    # A document may be the first of several equal texts and share lines with others too.
    merged = found.unionAll(copied).groupBy("doc", "key").agg(
        F.max("spans").alias("spans"), F.max("lines").alias("lines"), F.max("later").alias("later")
    )
    merged = stored_narrow(merged, "runs-gone")

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"), F.xxhash64(text_column).alias("hash"))
    joined = rows.join(merged, rows["id"].eqNullSafe(merged["doc"]) & (rows["hash"] == merged["key"]), "left")
    own = _lines(F.col("body"))
    words = F.size(F.filter(own, lambda line: ~line.rlike(_BLANK)))
    whole = F.coalesce(F.col("later"), F.lit(False)) & (words > 0)
    text = F.when(whole, F.lit("")).when(F.col("spans").isNotNull(), _without(F.col("body"), F.col("spans"))).otherwise(F.col("body"))
    n_lines = F.when(F.col("body").isNull(), 0).otherwise(F.size(own)).cast("long")
    cut = F.aggregate("spans", F.lit(0), lambda total, span: total + span["end"] - span["begin"])
    removed = F.when(whole, n_lines).when(F.col("spans").isNotNull(), cut).otherwise(0).cast("long")
    longest_run = F.when(F.col("later").isNotNull(), words).otherwise(F.coalesce("lines", F.lit(0))).cast("long")
    return joined.select(
        F.col("id").alias(id_column),
        n_lines.alias("n_lines"),
        removed.alias("n_removed"),
        longest_run.alias("longest_run"),
        F.when(~whole, F.coalesce("spans", F.array().cast(merged.schema["spans"].dataType))).alias("spans"),
        text.alias("text"),
    )
