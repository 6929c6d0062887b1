"""Language by string kernels.

The kernel of two texts is the number of byte n-grams (n from 1 to 3, a blended spectrum) that occur
in both, presence only, over the root of the product of their own numbers of n-grams. Nyström
landmarks turn it into vectors of fixed length, on which kernel ridge regression fits one output per
language against all others. Texts are scored in batches: presence matrix times landmark matrix times
coefficients.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import held_out, in_arrow, slices
from tickloom.session import stored

# Learned rows in all, of a language, and those among them that are landmarks, at most.
SAMPLE_ROWS = 4000
SAMPLE_PER_LANGUAGE = 200
LANDMARKS_PER_LANGUAGE = 24
RIDGE = 1e-3
UNKNOWN = "und"
HAS_LETTER = r"\p{L}"

# Texts in one matrix product.
ROWS_AT_ONCE = 256

# ASCII letters folded, other characters kept byte by byte, the rest space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# Codes of n-grams: single bytes, then pairs, then triples.
PAIRS_AT, TRIPLES_AT = 1 << 8, (1 << 8) + (1 << 16)
CODES = TRIPLES_AT + (1 << 24)


class Grams:
    """Distinct n-grams of texts; keeps a scratch table between calls."""

    def __init__(self):
        self.owner = np.zeros(CODES, np.int32)

    def of(self, raw: bytes) -> np.ndarray:
        folded = b" " + b" ".join(raw.translate(FOLD).split()) + b" "
        one = np.frombuffer(folded, np.uint8).astype(np.int32)
        two = (one[:-1] << 8) | one[1:]
        three = (two[:-1] << 8) | one[2:]
        codes = np.concatenate([one, two + PAIRS_AT, three + TRIPLES_AT])
        place = np.arange(len(codes), dtype=np.int32)
        self.owner[codes] = place  # of equal codes one place stays
        return codes[self.owner[codes] == place]


@dataclass(frozen=True)
class KernelModel:
    languages: list[str]
    grams: np.ndarray  # the n-grams of the landmarks, sorted
    landmarks: np.ndarray  # presence, n-grams x landmarks
    sizes: np.ndarray  # n-grams of each landmark
    coefficients: np.ndarray  # landmarks x languages
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def kernel(self, presence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return presence @ self.landmarks / np.sqrt(np.outer(sizes, self.sizes)).astype(np.float32)

    def outputs(self, presence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.kernel(presence, sizes) @ self.coefficients


def _presence(codes: list[np.ndarray], grams: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), len(grams)), np.float32)
    for row, own in enumerate(codes):
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        out[row, at[grams[at] == own]] = 1
    return out


def fit_kernel(codes: list[np.ndarray], languages: list[str], landmarks: int = LANDMARKS_PER_LANGUAGE) -> KernelModel:
    """Ridge regression on Nyström vectors. The first rows of each language are its landmarks."""
    names = sorted(set(languages))
    seen: dict[str, int] = {}
    chosen = []
    for row, name in enumerate(languages):
        seen[name] = seen.get(name, 0) + 1
        if seen[name] <= landmarks:
            chosen.append(row)
    grams = np.unique(np.concatenate([codes[row] for row in chosen]))
    presence = _presence(codes, grams)
    sizes = np.array([len(own) for own in codes], np.float64)
    bare = KernelModel(names, grams, presence[chosen].T.copy(), sizes[chosen], np.zeros((len(chosen), len(names))))
    between = bare.kernel(presence, sizes).astype(np.float64)
    values, vectors = np.linalg.eigh(between[chosen])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    mapped = between @ root
    targets = np.array([[1.0 if own == name else -1.0 for name in names] for own in languages])
    # Every language weighs the same, however many rows it has.
    weight = np.array([1 / languages.count(own) for own in languages]) * len(languages) / len(names)
    left = (mapped * weight[:, None]).T @ mapped + RIDGE * len(languages) * np.eye(mapped.shape[1])
    solved = np.linalg.solve(left, (mapped * weight[:, None]).T @ targets)
    return KernelModel(names, grams, bare.landmarks, bare.sizes, (root @ solved).astype(np.float32))


def train_language(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> KernelModel | None:
    """Learn from at most ``per_language`` rows of each language, none held out; None if there is none.

    Rows are taken by the smallest hashes of their id, languages in turn, ``sample_rows`` at most in all.
    A first filter on the hash, by the number of rows of the language, leaves a few times as many before
    they are ranked. Rows without id, language or letter are not learned from.
    """
    ids = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(language_column).cast("string").alias("language")
    ).filter(F.col("id").isNotNull() & F.col("language").isNotNull() & ~held_out("id"))
    # A row per language, written so that the planner sees its size and need not move the ids to it.
    counts = stored(ids.groupBy("language").count(), "language-counts")
    draw = F.xxhash64("id", "language")
    share = draw / F.lit(float(2**64)) + 0.5
    near = ids.join(counts, "language").filter(share * F.col("count") <= 2.0 * per_language + 50)
    rank = F.row_number().over(Window.partitionBy("language").orderBy(draw, "id"))
    chosen = near.distinct().withColumn("n", rank).filter(F.col("n") <= per_language)
    chosen = chosen.select("id", "language", "n").orderBy("n", "language").limit(sample_rows)
    texts = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(language_column).cast("string").alias("language"),
        F.col(text_column).alias("body"),
    ).filter(F.col("body").rlike(HAS_LETTER))
    # At most sample_rows rows are sent to all tasks, and as many texts come back as n-grams.
    sample = texts.join(F.broadcast(chosen), ["id", "language"]).select("language", "n", "body")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grams()
        for batch in batches:
            for part, raws in slices(batch, "body"):
                codes = pa.array([np.sort(own.of(raw)) for raw in raws], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), codes], ["language", "n", "codes"])

    found = in_arrow(sample, grams, "language string, n int, codes array<int>").distinct().toArrow()
    rows = sorted(
        (n, language, codes.values.to_numpy().tobytes())
        for n, language, codes in zip(found["n"].to_pylist(), found["language"].to_pylist(), found["codes"])
    )
    if not rows:
        return None
    return fit_kernel([np.frombuffer(codes, np.int32) for _, _, codes in rows], [language for _, language, _ in rows])


# The model in use with its lookup table, kept between the tasks of one worker.
_LAST: dict[str, tuple[KernelModel, Grams, np.ndarray]] = {}


def _ready(key: str, model: Broadcast) -> tuple[KernelModel, Grams, np.ndarray]:
    if key not in _LAST:
        _LAST.clear()
        place = np.full(CODES, -1, np.int32)
        place[model.value.grams] = np.arange(len(model.value.grams))
        _LAST[key] = (model.value, Grams(), place)
    return _LAST[key]


def predict_language(
    docs: DataFrame, model: KernelModel | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, lang_pred, score (0 to 1).

    Null texts, texts without a letter and, without a model, all texts are ``und`` with score 0.
    Of languages with equal scores the first by name is given. Every row is judged by itself, so repeated rows
    agree; no rows give no rows. A text is held whole by its task, its distinct n-grams number 16 million at
    most; other columns are not looked at.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.when(F.col(text_column).rlike(HAS_LETTER), F.col(text_column)).alias("body"),
    )
    if model is None:
        return rows.select(F.col("id").alias(id_column), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent, key = docs.sparkSession.sparkContext.broadcast(model), model.key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, grams, place = _ready(key, sent)
        for batch in batches:
            for part, raws in slices(batch, "body"):
                names = np.full(len(raws), UNKNOWN, object)
                scores = np.zeros(len(raws))
                known = np.flatnonzero(part.column("body").is_valid().to_numpy(zero_copy_only=False))
                for start in range(0, len(known), ROWS_AT_ONCE):
                    some = known[start : start + ROWS_AT_ONCE]
                    presence = np.zeros((len(some), len(own.grams)), np.float32)
                    sizes = np.empty(len(some))
                    for n, row in enumerate(some):
                        codes = grams.of(raws[row])
                        at = place[codes]
                        presence[n, at[at >= 0]] = 1
                        sizes[n] = len(codes)
                    out = own.outputs(presence, sizes)
                    best = out.argmax(axis=1)
                    names[some] = np.array(own.languages, object)[best]
                    scores[some] = np.clip((out[np.arange(len(some)), best] + 1) / 2, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(names, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"]
                )

    scored = in_arrow(rows, run, "id long, lang_pred string, score double")
    return scored.withColumnRenamed("id", id_column)
