"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.bpe import encode_texts
from tickloom.llm.decontaminate import contamination
from tickloom.llm.exact import exact_dedup
from tickloom.llm.langid import predict_language, train_language
from tickloom.llm.merkle import folded, leaf_digest, merkle_manifest, proof_digest
from tickloom.llm.near import near_duplicates
from tickloom.llm.oracles import ORACLES  # noqa: F401
from tickloom.llm.quality import score_quality, train_quality
from tickloom.llm.rules import judge_quality
from tickloom.llm.runs import dedup_lines
from tickloom.llm.search import search_items
from tickloom.llm.shard import byte_shards
from tickloom.llm.tables import held_out, read
from tickloom.llm.urls import domains, host_of, judge_captures
from tickloom.llm.warc import derive_records, record_id

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SHARDS = 24


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def ranks_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op1_decontaminate")
def op1_decontaminate(spark, sf_dir):
    """Words of every document that lie in a window of ten words of a benchmark item."""
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


@query("op2_byte_shards")
def op2_byte_shards(spark, sf_dir):
    """Contiguous shards of nearly equal bytes."""
    placed = byte_shards(read(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op3_quality")
def op3_quality(spark, sf_dir):
    """Quality score of every document; the model sees two thirds of the labels at most."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs, read(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op5_exact_dedup")
def op5_exact_dedup(spark, sf_dir):
    """Every document with the copy that stays for it."""
    return exact_dedup(read(spark, sf_dir, "documents"), keep="largest")


@query("op9_language")
def op9_language(spark, sf_dir):
    """Language of every document; the model sees two thirds of the rows at most."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict_language(docs, train_language(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query("op10_byte_bpe")
def op10_byte_bpe(spark, sf_dir):
    """Token counts and digests of the ids and of what they decode to."""
    return encode_texts(read(spark, sf_dir, "documents"), ranks_path(), public_tokenizers.PATTERN)


@query("op4_near_dedup")
def op4_near_dedup(spark, sf_dir):
    """Components of documents whose four-word shingle sets are similar by 80 percent."""
    return near_duplicates(read(spark, sf_dir, "documents"), words=4)


def page_responses(pages: DataFrame) -> DataFrame:
    """Pages as response records, with names and dates that follow from their ids."""
    moment = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 61)
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    return pages.select(
        "page_id",
        record_id("response", F.col("page_id").cast("string")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        "html",
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size).alias("http"),
    )


@query("op6_warc_derivatives")
def op6_warc_derivatives(spark, sf_dir):
    """Metadata and conversion records of every page."""
    return derive_records(page_responses(read(spark, sf_dir, "pages")), http_headers_column="http", keep=("page_id",))


def _number(*parts: Column) -> Column:
    """A number below 2**24 that follows from texts."""
    return F.conv(F.substring(F.md5(F.concat_ws(" ", *parts)), 1, 6), 16, 10).cast("long")


LISTS = ("adult", "allow", "malware", "spam")
MONTH_MINUTES = 30 * 24 * 60


def list_entries(hosts: DataFrame) -> DataFrame:
    """Three dated entries on each list for some of the hosts and their parent domains."""
    patterns = hosts.select(F.explode(domains(F.col("host"))).alias("pattern")).filter(F.instr("pattern", ".") > 0).distinct()
    kinds = [F.struct(F.lit(name).alias("list"), F.lit(n).alias("n")) for name in LISTS for n in range(3)]
    each = patterns.select("pattern", F.inline(F.array(*kinds)))
    draw = _number(F.col("pattern"), F.col("list"), F.col("n").cast("string"))
    minute = draw % MONTH_MINUTES
    return each.filter(_number(F.col("pattern"), F.col("list")) % 3 == 0).select(
        "list",
        "pattern",
        F.when(draw % 5 < 3, "add").otherwise("remove").alias("action"),
        F.timestamp_seconds(F.lit(1704067200) + minute * 60).alias("listed_at"),
    )


@query("op7_url_filter")
def op7_url_filter(spark, sf_dir):
    """Every page's address against the lists as they stood when it was fetched."""
    pages = read(spark, sf_dir, "pages")
    fetched = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 7919 % MONTH_MINUTES * 60)
    captures = pages.select("page_id", "url", fetched.alias("fetched_at"))
    entries = list_entries(pages.select(host_of(F.col("url")).alias("host")).filter("host is not null").distinct())
    judged = judge_captures(captures, entries, id_column="page_id")
    return judged.select(
        "page_id", "host", F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"), "n_active",
        F.array_join("blocked_by", ",").alias("blocked_by"), "allowed", "blocked",
    )


@query("op8_line_runs")
def op8_line_runs(spark, sf_dir):
    """Every document without the later copies of repeated runs of lines, and its longest run that stands elsewhere."""
    cleaned = dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "longest_run", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


LEAF = ("doc_id", "source", "lang", "n_chars", "text")


@query("op11_merkle_manifest")
def op11_merkle_manifest(spark, sf_dir):
    """Roots and proofs of the documents, and whether a seventh of tampered ones is noticed."""
    docs = read(spark, sf_dir, "documents")
    fields = {name: F.col(name) for name in LEAF}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = F.when(tampered, leaf_digest((fields | {"n_chars": F.col("n_chars") + 1}).values()))
    found = merkle_manifest(
        docs, list(fields.values()), F.col("lang"), F.col("doc_id"), {"doc_id": F.col("doc_id"), "claimed": claimed}
    )
    proven = found.withColumn("folded_root", folded(F.coalesce("claimed", "leaf"), F.col("path")))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op12_quality_rules")
def op12_quality_rules(spark, sf_dir):
    """Every document with its counts, judged by base rules and by the fences of its language and source."""
    judged = judge_quality(read(spark, sf_dir, "documents"))
    return judged.withColumn("failed", F.array_join("failed", ","))


@query("op13_ranked_search")
def op13_ranked_search(spark, sf_dir):
    """The twenty best documents of every benchmark item."""
    return search_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
