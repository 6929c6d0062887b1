"""The two fitted models against plain versions of what they are said to solve."""

import random
import zlib

import numpy as np
import pytest

from tickloom.llm.langid import Grams, fit_kernel
from tickloom.llm.quality import features, fit_ranking, train_quality

WORDS = {"a": "the and of that with from this".split(), "b": "der und die nicht mit von das".split(), "c": "les des une dans pour avec".split()}


def texts(per_language, seed):
    draw = random.Random(seed)
    return [(" ".join(draw.choice(own) + draw.choice(["", "s", "en"]) for _ in range(30)), name) for _ in range(per_language) for name, own in WORDS.items()]


def grams_of(text):
    folded = f" {text} ".encode()
    return {folded[n : n + size] for size in (1, 2, 3) for n in range(len(folded) - size + 1)}


def plain_outputs(learned, landmarks, asked, ridge=1e-3):
    """Ridge regression on the plain kernel matrix; the coefficients of the landmarks are solved for directly."""
    names = sorted({name for _, name in learned})
    seen, chosen = {}, []
    for text, name in learned:
        seen[name] = seen.get(name, 0) + 1
        if seen[name] <= landmarks:
            chosen.append(grams_of(text))

    def kernel(rows):
        return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in chosen] for x in rows])

    between = kernel([grams_of(text) for text, _ in learned])
    own = kernel(chosen)
    counts = [sum(name == other for _, other in learned) for _, name in learned]
    weight = np.diag([len(learned) / len(names) / n for n in counts])
    targets = np.array([[1.0 if name == other else -1.0 for other in names] for _, name in learned])
    left = between.T @ weight @ between + ridge * len(learned) * own
    solved = np.linalg.solve(left, between.T @ weight @ targets)
    return kernel([grams_of(text) for text, _ in asked]) @ solved


@pytest.mark.parametrize("landmarks", [4, 100])
def test_language_scores_are_those_of_the_plain_kernel(landmarks):
    """With fewer landmarks than rows, and with all of them (ridge regression on the whole matrix)."""
    learned, asked = texts(15, 1)[:-1], texts(10, 2)
    grams = Grams()
    model = fit_kernel([np.sort(grams.of(text.encode())) for text, _ in learned], [name for _, name in learned], landmarks)
    place = {int(g): n for n, g in enumerate(model.grams)}
    presence, sizes = np.zeros((len(asked), len(place)), np.float32), np.zeros(len(asked))
    for n, (text, _) in enumerate(asked):
        codes = grams.of(text.encode())
        sizes[n] = len(codes)
        presence[n, [place[int(c)] for c in codes if int(c) in place]] = 1
    assert sizes.tolist() == [len(grams_of(text)) for text, _ in asked]
    got, expected = model.outputs(presence, sizes), plain_outputs(learned, landmarks, asked)
    assert np.abs(got - expected).max() < 5e-3
    assert [model.languages[n] for n in got.argmax(axis=1)] == [name for _, name in asked]


def plain_ranking(rows, labels, penalty=1e-3, steps=20_000, rate=0.5):
    """Gradient ascent on the log-likelihood of all pairs (better, worse)."""
    better, worse = rows[labels == 1], rows[labels == 0]
    scale = rows.std(axis=0)
    gap = ((better[:, None] - worse[None]) / scale).reshape(-1, rows.shape[1])
    weights = np.zeros(rows.shape[1])
    for _ in range(steps):
        win = 1 / (1 + np.exp(-np.clip(gap @ weights, -30, 30)))
        step = gap.T @ (1 - win) / len(gap) - penalty * weights
        weights += rate * step
        if np.abs(step).max() < 1e-7:
            break
    return weights / scale


def test_quality_ranking_is_that_of_all_pairs():
    draw = np.random.default_rng(4)
    labels = (np.arange(240) % 3 > 0).astype(int)
    rows = draw.normal(size=(240, 4)) * [1, 5, 0.2, 1] + labels[:, None] * [0.8, 2.0, 0.05, 0.0]
    model, plain = fit_ranking(rows, labels), plain_ranking(rows, labels)
    mine, theirs = rows @ model.weights, rows @ plain
    assert np.corrcoef(mine, theirs)[0, 1] > 0.995
    assert np.abs(model.weights - plain).max() < 0.12 * np.abs(plain).max()
    better, worse = mine[labels == 1], mine[labels == 0]
    right = (better[:, None] > worse[None]).mean()
    best = (theirs[labels == 1][:, None] > theirs[labels == 0][None]).mean()
    assert right > best - 0.005
    assert model.cut == pytest.approx(np.quantile(mine, len(worse) / len(rows), method="midpoint"))
    assert ((model.scores(rows) >= 0.5) == (mine >= model.cut)).all()


def test_quality_weights_are_a_maximum():
    """No small step in any direction makes the drawn pairs likelier; with all pairs drawn that is the plain optimum."""
    draw = np.random.default_rng(5)
    labels = np.array([1] * 13 + [0] * 9)
    rows = draw.normal(size=(22, 3)) + labels[:, None] * 0.7
    model = fit_ranking(rows, labels, pairs=13 * 9)
    assert np.isfinite(model.weights).all() and (rows @ model.weights)[labels == 1].mean() > (rows @ model.weights)[labels == 0].mean()
    one_kind = fit_ranking(rows, np.ones(22))
    assert (one_kind.scores(rows) == 0.5).all()


def test_quality_weights_are_those_of_all_pairs_exactly():
    draw = np.random.default_rng(6)
    labels = (np.arange(500) % 3 > 0).astype(int)
    rows = draw.normal(size=(500, 4)) * [1, 5, 0.2, 1] + labels[:, None] * [0.8, 2.0, 0.05, 0.0]
    model, plain = fit_ranking(rows, labels), plain_ranking(rows, labels)
    assert np.abs((model.weights - plain) * rows.std(axis=0)).max() < 1e-3


def test_quality_learns_from_every_labelled_row(spark):
    """More rows than any sample held: weights and cut are those of all of them; odd labels and copies add nothing."""
    draw = random.Random(8)
    marks = ["", "!", "!!", ".", " 12", "\n"]
    labelled = [(n, int(draw.random() < 0.6)) for n in range(9000)]
    docs = [(n, " ".join(draw.choice(WORDS["a"]) + draw.choice(marks[label:]) for _ in range(draw.randint(3, 12)))) for n, label in labelled]
    learned = [(label, features(text.encode())) for (n, label), (_, text) in zip(labelled, docs) if zlib.crc32(b"%d" % n) % 3 != 1]
    assert len(learned) > 5500
    plain = fit_ranking(np.array([vector for _, vector in learned]), np.array([label for label, _ in learned]))
    labels = spark.createDataFrame([*labelled, *labelled[:50], (9001, 1), (9001, 0), (9002, 5), (None, 1)], "doc_id long, quality int")
    texts = spark.createDataFrame([*docs, *docs[:50], (9001, "x"), (9002, "y"), (None, "z"), (9003, None)], "doc_id long, text string")
    model = train_quality(texts.repartition(5), labels)
    assert model.weights == pytest.approx(plain.weights, rel=1e-6) and model.cut == pytest.approx(plain.cut, rel=1e-6)
