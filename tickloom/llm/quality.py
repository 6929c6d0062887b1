"""Quality scores by Bradley-Terry ranking.

A document is a vector of shares and ratios of its whole text. Every labelled row that may be learned
from makes a pair (better, worse) with every row of the other kind; the score is the weight vector under
which the better of a pair wins by logistic loss on the difference of their vectors. The cut is the quantile
of the scores at the share of worse documents among the learned rows.

The loss of a pair depends on two scores only. So the pairs are not made: rows are summed at the points of a
grid of scores, by the tasks that read them, and the slope over all pairs follows from two points at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.tables import held_out, in_arrow, slices
from tickloom.session import stored, work_scope

# Points of the score grid on either side of 0, their distance, and how many of them share a curvature. A row
# lies between two points, so the slope of a pair is off by STEP ** 2 / 80 at most.
POINTS = 1024
STEP = 1 / 16
COARSE = 8

# Bins of a pass that looks for a score by its rank.
RANK_BINS = 1000

# Byte classes whose shares of a text are features.
CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "space": (32, 9),
    "line": (10, 13),
    "stop": b".,;:?",
    "shout": b"!",
    "bar": b"|",
    "sign": b"#$%&*@^~+=<>\\/_",
    "quote": b"\"'`()[]{}-",
    "foreign": range(128, 256),
}
RATIOS = ("distinct_words", "same_as_before", "distinct_lines", "word_length", "log_bytes")
FEATURES = (*CLASSES, *RATIOS)

_OF_CLASS = np.zeros((256, len(CLASSES)))
for _n, _own in enumerate(CLASSES.values()):
    _OF_CLASS[list(_own), _n] = 1


def features(raw: bytes) -> np.ndarray:
    """One vector per text; an empty text has shares 0 and nothing repeated."""
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = counts @ _OF_CLASS / max(1, len(raw))
    own, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(own))
    repeated = sum(map(eq, own, own[1:])) / n
    length = min(20.0, sum(map(len, own)) / n) / 20
    ratios = (len(set(own)) / n if own else 1, repeated, len(set(lines)) / len(lines), length, np.log1p(len(raw)) / 20)
    return np.append(shares, ratios)


@dataclass(frozen=True)
class Ranking:
    """Scores of feature rows are ``sigmoid(sharpness * (rows @ weights - cut))``."""

    weights: np.ndarray
    cut: float
    sharpness: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sharpness * (rows @ self.weights - self.cut), -30, 30)))


class PairSums:
    """Rows of both kinds summed by their scores: all that the slope over all pairs depends on."""

    def __init__(self, width: int):
        # At every point counts and sums, at every coarse one counts, sums and products; worse rows first.
        points, squares = (2, 2 * POINTS + 1, width + 1), (2, 2 * POINTS // COARSE + 1, width + 1, width + 1)
        self.flat = np.zeros(np.prod(points) + np.prod(squares))
        self.points = self.flat[: np.prod(points)].reshape(points)
        self.squares = self.flat[np.prod(points) :].reshape(squares)

    def add(self, rows: np.ndarray, better: np.ndarray, weights: np.ndarray) -> PairSums:
        along = np.clip(rows @ weights / STEP, -POINTS, POINTS) + POINTS
        left = np.minimum(along.astype(int), 2 * POINTS - 1)
        coarse = np.rint(along / COARSE).astype(int)
        sides = np.column_stack([np.ones(len(rows)), rows])
        for kind in (0, 1):
            own = better == kind
            share, at = (along - left)[own], left[own]
            for n, column in enumerate(sides[own].T):
                sums = self.points[kind, :, n]
                sums += np.bincount(at, (1 - share) * column, len(sums)) + np.bincount(at + 1, share * column, len(sums))
            for place in np.unique(coarse[own]):
                part = sides[own & (coarse == place)]
                self.squares[kind, place] += part.T @ part
        return self

    def slopes(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean logarithm of the chance of all pairs, its slope, and its curvature (downwards)."""
        (at_worse, worse), (at_better, better) = (self._held(sums, sums[:, 0], 1) for sums in self.points)
        gaps = at_better[:, None] - at_worse
        pairs = better[:, 0].sum() * worse[:, 0].sum()
        lose = 1 / (1 + np.exp(gaps))
        value = -(better[:, 0] @ np.logaddexp(0, -gaps) @ worse[:, 0])
        slope = (lose @ worse[:, 0]) @ better[:, 1:] - (better[:, 0] @ lose) @ worse[:, 1:]
        (at_worse, worse), (at_better, better) = (self._held(sums, sums[:, 0, 0], COARSE) for sums in self.squares)
        lose = 1 / (1 + np.exp(at_better[:, None] - at_worse))
        bend = lose * (1 - lose)
        crossed = better[:, 0, 1:].T @ bend @ worse[:, 0, 1:]
        own = np.tensordot(bend @ worse[:, 0, 0], better, 1) + np.tensordot(better[:, 0, 0] @ bend, worse, 1)
        return value / pairs, slope / pairs, (own[1:, 1:] - crossed - crossed.T) / pairs

    @staticmethod
    def _held(sums: np.ndarray, counts: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the points that rows are summed at, and the sums there."""
        held = np.flatnonzero(counts > 0)
        return (held * points - POINTS) * STEP, sums[held]


def _ascended(summed: Callable[[np.ndarray], PairSums], width: int, penalty: float) -> np.ndarray:
    """The weights that make all pairs likeliest, by Newton steps, halved when one leads down."""
    weights, step, best = np.zeros(width), np.zeros(width), -np.inf
    for _ in range(50):
        tried = weights + step
        value, slope, curve = summed(tried).slopes()
        value -= penalty / 2 * tried @ tried
        if value < best - 1e-6:
            step = step / 2
            continue
        weights, best = tried, value
        step = np.linalg.solve(curve + penalty * np.eye(width), slope - penalty * weights)
        if np.abs(step).max() < 1e-5:
            break
    return weights


def _plain_scale(weights: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights of unscaled rows, to ten digits: the order in which tasks were summed does not show."""
    return np.array([float(f"{weight:.9e}") for weight in weights / scale])


def _undecided(width: int = len(FEATURES)) -> Ranking:
    return Ranking(np.zeros(width), 0.0, 1.0)


def fit_ranking(rows: np.ndarray, labels: np.ndarray, pairs: int | None = None, penalty: float = 1e-3) -> Ranking:
    """Fit on all pairs of rows with labels 1 (better) and 0. Without both kinds every score is 0.5.

    ``train_quality`` for rows at hand. ``pairs`` used to limit the pairs and is accepted without effect.
    """
    better, n_worse = labels == 1, int((labels == 0).sum())
    if not n_worse or n_worse == len(rows):
        return _undecided(rows.shape[1] if rows.ndim == 2 else len(FEATURES))
    scale = rows.std(axis=0)
    scale[scale < 1e-9] = 1.0
    scaled = (rows - rows.mean(axis=0)) / scale
    width = rows.shape[1]
    weights = _ascended(lambda tried: PairSums(width).add(scaled, better, tried), width, penalty)
    weights = _plain_scale(weights, scale)
    cut = float(np.quantile(rows @ weights, n_worse / len(rows), method="midpoint"))
    return Ranking(weights, cut, 1.0)


def _vectors(docs: DataFrame, *carried: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices(batch, "body"):
                vectors = pa.array([features(raw) for raw in raws], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), vectors], [*carried, "vector"])

    schema = T.StructType(docs.select(*carried).schema.fields + [T.StructField("vector", T.ArrayType(T.DoubleType()))])
    return in_arrow(docs.select(*carried, "body"), run, schema)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy().reshape(-1, len(FEATURES))


def _summed(learned: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> PairSums:
    """Sums over all learned rows: each task sums its own, and an aggregate by place adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = PairSums(len(FEATURES))
        for batch in batches:
            sums.add((_matrix(batch) - mean) / scale, batch.column("label").to_numpy() == 1, weights)
        held = np.flatnonzero(sums.flat)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(sums.flat[held])], ["place", "value"])

    total = PairSums(len(FEATURES))
    places = in_arrow(learned, run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    for place, value in places.collect():
        total.flat[place] = value
    return total


def _midpoint(scores: DataFrame, rank: int) -> float:
    """Midway between the ``rank``-th smallest score and the next one: exact, by counts in ever narrower bins."""
    score, before = F.col("score"), 0
    low, high = scores.agg(F.min(score), F.max(score)).first()
    while low < high:
        place = F.least(F.floor((score - low) / (high - low) * RANK_BINS), F.lit(RANK_BINS - 1))
        inside = scores.filter(score.between(low, high)).groupBy(place.alias("place"))
        for _, low, high, rows in sorted(inside.agg(F.min(score), F.max(score), F.count(score)).collect()):
            if before + rows >= rank:
                break
            before += rows
    upto, following = scores.agg(F.count(F.when(score <= low, 1)), F.min(F.when(score > low, score))).first()
    return low if upto > rank else (low + following) / 2


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    penalty: float = 1e-3,
) -> Ranking:
    """Learn from every labelled document that is not held out, and from all their pairs.

    Labels other than 0 and 1, null ids and ids with both labels are left out; repeated labels count once. The
    vectors of the learned rows are written once and read some twenty times; what comes to the driver are the sums of a
    fixed grid, moments and counts. The written rows are removed at the end.
    """
    clear = (
        labels.filter(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg(F.min(label_column).cast("int").alias("label"), F.max(label_column).cast("int").alias("other"))
        .filter(F.col("label") == F.col("other"))
    )
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("body"))
    # Vectors are joined, not texts: however many labels there are, a row moves as one vector.
    open_texts = texts.filter(F.col("id").isNotNull() & ~held_out("id"))
    vectors = _vectors(open_texts, "id").join(clear.select("id", "label"), "id")
    # Repeated rows of a document count once; their vectors are ordered, so the choice is the same each time.
    once = vectors.groupBy("id", "label").agg(F.min("vector").alias("vector")).select("label", "vector")
    with work_scope(docs.sparkSession):
        learned = stored(once, "vectors")
        columns = [F.col("vector")[n] for n in range(len(FEATURES))]
        moments = [*map(F.avg, columns), *map(F.stddev_pop, columns)]
        rows, n_better, *found = learned.agg(F.count("label"), F.sum("label"), *moments).first()
        if not n_better or n_better == rows:
            return _undecided()
        mean, scale = np.array(found).reshape(2, -1)
        scale[scale < 1e-9] = 1.0
        weights = _ascended(lambda tried: _summed(learned, mean, scale, tried), len(FEATURES), penalty)
        model = Ranking(_plain_scale(weights, scale), 0.0, 1.0)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(_matrix(batch) @ model.weights)], ["score"])

        scores = stored(in_arrow(learned, place, "score double"), "scores")
        return replace(model, cut=_midpoint(scores, rows - n_better))


def score_quality(docs: DataFrame, model: Ranking, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of the whole text; null and empty texts are scored as empty.

    Every row is scored by itself, so repeated rows agree; no rows give no rows. A text is held whole by its
    task, at about 50 times its bytes. A column that has the name of the score gives way to it.
    """
    docs = docs.drop(score_column)
    schema = T.StructType(docs.schema.fields + [T.StructField(score_column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raws in slices(batch, text_column):
                scores = model.scores(np.array([features(raw) for raw in raws]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*part.schema.names, score_column])

    return in_arrow(docs, run, schema)
