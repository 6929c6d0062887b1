"""From raw documents to token ids: rejected, copied, near-copied and contaminated documents go.

Each stage takes (spark, docs, sf_dir) and gives documents again, the last one token ids. ``run`` writes
what a stage keeps and reads it again for the next.

Each row is judged by itself, also where ids repeat or are null; no rows give no rows. Other columns of
the documents pass through, whatever their names. A text is held whole by the task that judges it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.bpe import encode_texts
from tickloom.llm.decontaminate import contamination
from tickloom.llm.exact import unique_rows
from tickloom.llm.near import near_duplicates
from tickloom.llm.quality import score_quality, train_quality
from tickloom.llm.tables import read
from tickloom.session import stored

KEY = "text_key"


def _without(docs: DataFrame, dropped: DataFrame, label: str) -> DataFrame:
    """The rows that were not dropped themselves, known by id (null too) and hash of the text.

    Dropped ones are written, so the planner sees their size.
    """
    gone = stored(dropped.select("doc_id", KEY).distinct(), label)
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone[KEY])
    return docs.join(gone, same, "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking places at its cut or above; equal texts fare alike, null is scored as empty.

    Without labels of both kinds nothing is known and nothing goes.
    """
    score = "_".join(["score", *docs.columns])  # a name that no column has
    scored = score_quality(docs, train_quality(docs, read(spark, sf_dir, "labels")), score_column=score)
    return scored.filter(F.col(f"`{score}`") >= 0.5).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id (a null id comes last); null counts as empty."""
    return unique_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8) the row with the smallest id.

    Rows without a word, null texts among them, are like no other and stay. Rows without id go if their
    class has an id.
    """
    return _without(docs, near_duplicates(docs, key_column=KEY).filter(~F.col("kept")), "pipeline-near")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item; null and empty texts stay."""
    found = contamination(docs, read(spark, sf_dir, "benchmark"), key_column=KEY)
    return _without(docs, found.filter("contaminated"), "pipeline-contaminated")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, with digests of the ids and of what they decode to; null and empty texts have none."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_texts(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokens),
]

# The classifier and the tokenizer are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(out, "pipeline-stage")
    return out
