"""Quality rules with thresholds that follow the data. DataFrame functions only.

Every text is measured. Per language and source the measures of the texts that pass the base rules go into
quantile sketches: counts per bucket, where a bucket holds whole numbers that agree in their first eight
binary digits, so a quantile read from it is low by less than 1/128. Sketches merge by adding counts: those of
the sources give that of a language, those of the languages that of the table. From the quartiles of a sketch
follow the fences of a measure; documents are joined with the fences of their group and judged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored_narrow
from tickloom.session import stored

# Base rules: too short, or more than this share of words in repeated windows.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Measures with the least distance of the quartiles that counts: a group in which nearly all
# documents are alike would otherwise turn away every one that differs a little.
MEASURES = {
    "word_length": 50,  # thousandths of a character per word
    "symbol_share": 100,  # ten-thousandths of the characters in words
    "dup_line_share": 1000,  # ten-thousandths of the lines with a word
    "repeat_share": 1000,  # ten-thousandths of the words
}

# A fence lies so many quartile distances beyond its quartile.
REACH = 5

# A group with fewer measured documents is judged by its language, a language with fewer by all.
LEAST_ROWS = 200

# The first binary digits that a bucket keeps.
DIGITS = 8

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

# Parts that the documents of one group are dealt to in a join by group.
SALTS = 16


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once for each row."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more.

    Windows are compared by 64-bit hashes, sorted with their places; equal ones are neighbours.
    """

    def covered(places: Column) -> Column:
        own = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda total, n: total + n)

    def again(ranked: Column) -> Column:
        def same(at: Column, i: Column) -> Column:
            return F.coalesce(F.get(ranked, i)["h"] == at["h"], F.lit(False))

        found = F.filter(ranked, lambda at, i: same(at, i - 1) | same(at, i + 1))
        return _let(F.sort_array(F.transform(found, lambda at: at["p"])), covered)

    def windows(hashes: Column) -> Column:
        firsts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0)))
        each = F.transform(
            firsts, lambda h, i: F.struct(F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)).alias("h"), i.alias("p"))
        )
        return _let(F.sort_array(each), again)

    return _let(F.transform(words, lambda word: F.xxhash64(word)), windows)


def text_measures(text: Column) -> Column:
    """Counts of a whole text as a struct: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Words are what stands between ASCII blanks. ``n_lines`` are lines with a word, ``n_dup_lines`` those of
    them that are equal to an earlier one. Null counts as empty: all counts are 0.
    """
    whole = F.coalesce(text, F.lit(""))
    plain = F.translate(whole, BLANKS, " " * len(BLANKS))
    words = F.array_remove(F.split(plain, " "), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.translate(whole, BLANKS, "")).cast("long").alias("word_chars"),
            (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    return _let(words, counts)


def _measures() -> dict[str, Column]:
    """The judged measures as whole numbers, from the counts of a text with words."""
    return {
        "word_length": F.expr("1000 * word_chars div n_words"),
        "symbol_share": F.expr("10000 * n_symbols div word_chars"),
        "dup_line_share": F.expr("10000 * n_dup_lines div n_lines"),
        "repeat_share": F.expr("10000 * n_repeat_words div n_words"),
    }


def _bucket(value: Column) -> Column:
    """The least number with the same first digits."""
    spare = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def quantile_sketches(measured: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bucket, rows): counts per bucket of the measures, partly summed before the shuffle."""
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in _measures().items()]))
    return measured.select(*keys, each).groupBy(*keys, "measure", _bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("rows"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of larger groups from those of their parts."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("rows").alias("rows"))


def fences(sketches: DataFrame, keys: list[str], least_rows: int = LEAST_ROWS, reach: int = REACH) -> DataFrame:
    """One row per group of at least ``least_rows`` documents: (keys, <measure>_low, <measure>_high, ...)."""
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("rows").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = sketches.withColumn("upto", upto).withColumn("n", F.sum("rows").over(group)).filter(F.col("n") >= least_rows)
    quartiles = ranked.groupBy(*keys, "measure").agg(
        F.min(F.when(4 * F.col("upto") >= F.col("n"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("n"), F.col("bucket"))).alias("q3"),
    )
    columns = []
    for name, width in MEASURES.items():
        room = reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(width))
        own = F.col("measure") == name
        columns += [F.max(F.when(own, F.col("q1") - room)).alias(f"{name}_low"), F.max(F.when(own, F.col("q3") + room)).alias(f"{name}_high")]
    return quartiles.groupBy(*keys).agg(*columns)


def _salted(found: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """The fences once for each salt, with names of their own."""
    own = [F.col(c).alias(f"{prefix}_{c}") for c in found.columns if c not in keys]
    named = found.select(*[F.col(c).alias(f"{prefix}_{c}") for c in keys], *own)
    return named.select("*", F.explode(F.array(*[F.lit(n) for n in range(SALTS)])).alias(f"{prefix}_salt"))


def judge_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least_rows: int = LEAST_ROWS,
    reach: int = REACH,
) -> DataFrame:
    """Per row: id, the counts of ``text_measures``, base_failed, failed (names of rules), kept.

    A document fails the base rules with fewer than 50 words or with more than half its words in repeated
    windows. The others are measured against the fences of their language and source, of their language where
    that group has fewer than ``least_rows`` such documents, and of all where the language has fewer too; a
    value on a fence passes. Null languages and sources are groups of their own; null and empty texts fail the
    base rules. Rows are judged one by one, so repeated ones alike, and each counts in its group. No rows give
    no rows. A text is worked through whole within its row, with about 60 bytes for each word; two different
    windows of one text are taken for equal with a chance of (words squared) / 2**65. The ids may have any
    type; other columns are not looked at. The join deals a group to ``SALTS`` parts.
    """
    group = [F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("")) for c in (lang_column, source_column)]
    raw = docs.select(F.col(id_column).alias("id"), group[0].alias("lang"), group[1].alias("source"), text_measures(F.col(text_column)).alias("m"))
    short = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    measured = stored(raw.select("id", "lang", "source", "m.*").withColumn("base_failed", short), "rules-measured")

    sketches = stored_narrow(quantile_sketches(measured.filter(~F.col("base_failed")), ["lang", "source"]), "rules-sketches")
    by_source = stored_narrow(_salted(fences(sketches, ["lang", "source"], least_rows, reach), ["lang", "source"], "own"), "rules-fences")
    of_langs = merged(sketches, ["lang"])
    by_lang = stored_narrow(_salted(fences(of_langs, ["lang"], least_rows, reach), ["lang"], "wide"), "rules-fences")
    overall = fences(merged(of_langs.withColumn("all", F.lit(0)), ["all"]), ["all"], 1, reach).first()

    salt = F.pmod(F.xxhash64("id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    rows = measured.withColumn("salt", salt)
    rows = rows.join(
        by_source, (rows["lang"] == by_source["own_lang"]) & (rows["source"] == by_source["own_source"]) & (rows["salt"] == by_source["own_salt"]), "left"
    )
    rows = rows.join(by_lang, (rows["lang"] == by_lang["wide_lang"]) & (rows["salt"] == by_lang["wide_salt"]), "left")

    def fence(name: str) -> Column:
        return F.coalesce(f"own_{name}", f"wide_{name}", F.lit(overall[name] if overall else None).cast("long"))

    outside = [
        F.when((value < fence(f"{name}_low")) | (value > fence(f"{name}_high")), F.lit(name)) for name, value in _measures().items()
    ]
    failed = F.when(~F.col("base_failed"), F.array_compact(F.array(*outside))).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("failed", failed).select(
        F.col("id").alias(id_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "failed",
        (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
    )
