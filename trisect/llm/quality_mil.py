"""Document quality by attention-based multiple-instance learning, trained in numpy.

A document is a bag of passages. A passage is encoded from the mean of its hashed word embeddings and the mean of
its words' shapes. Gated attention, learned from document labels alone, weighs the passages; a logistic layer reads
the weighted passage representation. It is learned from a bounded sample of labelled documents, of which a part
is set aside to calibrate the score.

The score of a text depends on nothing but the text. A null or empty text is one passage of one empty word. Very long
texts are read whole; their passages are many, their memory is that of their words. Equal rows get equal results; an
empty table gives an empty table. Columns named like an output are replaced. Where the sample lacks a class,
all texts get its share of label 1 as their score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from trisect.llm.bytebpe import blocks
from trisect.llm.hashed_words import (
    SLOTS, Adam, WordNumbers, best_threshold, calibrate, constant_logit, means, row_sums, sigmoid, split_words, steady, training_sample,
    word_features,
)
from trisect.llm.tables import texts_of, with_columns

PASSAGE = 64
DIMENSIONS, HIDDEN, GATES = 12, 24, 16
SYMBOLS = "#*$%&|<>"
SHAPES = 8
MOST_REMEMBERED = 200_000


def word_shapes(pieces: list[str]) -> np.ndarray:
    """Numbers that describe how a piece looks, each about 0 to 1."""
    rows = [
        (
            min(len(p), 20) / 10, sum(map(p.count, SYMBOLS)) / 3, p.count("!") / 2, len(p) > 1 and p.isupper(),
            p == "|", p[:1].isupper(), p[-1:] in (".", ","), any(map(str.isdigit, p)),
        )
        for p in pieces
    ]
    return np.minimum(np.array(rows, np.float32).reshape(-1, SHAPES), 2)


class QualityModel:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        width = DIMENSIONS + SHAPES + 2
        make = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.p = {
            "rows": rng.normal(0, 0.3, (SLOTS, DIMENSIONS)).astype(np.float32),
            "encode": make(width, HIDDEN), "encode_shift": np.zeros(HIDDEN, np.float32),
            "tanh": make(HIDDEN, GATES), "gate": make(HIDDEN, GATES), "attend": make(GATES),
            "out": make(HIDDEN), "shift": np.zeros(1, np.float32),
        }
        self.slope, self.base = 1.0, 0.0

    def forward(self, features: np.ndarray, bags: np.ndarray, dot=steady):
        """Raw scores of bags and what the backward pass needs; ``bags`` holds where each bag begins, and the end."""
        p = self.p
        h = np.tanh(dot(features, p["encode"]) + p["encode_shift"])
        t, s = np.tanh(dot(h, p["tanh"])), sigmoid(dot(h, p["gate"]))
        logit = dot(t * s, p["attend"])
        size = np.diff(bags)
        top = np.maximum.reduceat(logit, bags[:-1])
        e = np.exp(logit - np.repeat(top, size))
        a = e / np.repeat(np.add.reduceat(e, bags[:-1]), size)
        z = np.add.reduceat(h * a[:, None], bags[:-1], axis=0)
        return dot(z, p["out"]) + p["shift"], (h, t, s, a, z)

    def score(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * raw.astype(np.float64) + self.base)


class Passages:
    """Passage features of texts; remembers the vectors and shapes of words."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self._forget()

    def _forget(self):
        self.numbers = WordNumbers()
        self.vectors = np.empty((0, DIMENSIONS), np.float32)
        self.shapes = np.empty((0, SHAPES), np.float32)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Features of all passages, and where the passages of each text begin."""
        if len(self.numbers) > MOST_REMEMBERED:
            self._forget()
        words, starts, bags = cut(texts, self.numbers)
        if self.numbers.new:
            flat, at = word_features(self.numbers.new)
            self.vectors = np.concatenate([self.vectors, means(self.rows, flat, at)])
            self.shapes = np.concatenate([self.shapes, word_shapes(self.numbers.new)])
            self.numbers.new = []
        return np.concatenate(
            [means(self.vectors, words, starts), passage_shapes(self.shapes, words, starts)], axis=1
        ), bags


def cut(texts: list[str], numbers: WordNumbers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, where each passage begins (and the end), where each text's passages begin (and the end)."""
    look = numbers.__getitem__
    words: list[int] = []
    sizes = []
    for text in texts:
        before = len(words)
        words.extend(map(look, split_words(text)))
        sizes.append(len(words) - before)
    size = np.array(sizes, np.int64)
    count = -(-size // PASSAGE)
    bags = np.concatenate([[0], np.cumsum(count)])
    ends = np.cumsum(size)
    inside = np.arange(int(bags[-1])) - np.repeat(bags[:-1], count)
    starts = np.repeat(ends - size, count) + inside * PASSAGE
    return np.array(words, np.int64), np.concatenate([starts, [len(words)]]), bags


def passage_shapes(shapes: np.ndarray, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean shapes, the share of words equal to the one before, and the passage's size."""
    same = np.concatenate([[0], words[1:] == words[:-1]]).astype(np.float32)
    same[starts[:-1]] = 0
    size = np.diff(starts)[:, None].astype(np.float32)
    return np.concatenate(
        [means(shapes, words, starts), np.add.reduceat(same, starts[:-1])[:, None] / size, size / PASSAGE], axis=1
    )


def train(sample: list, epochs: int = 6, batch: int = 32, rate: float = 0.004, seed: int = 11) -> QualityModel:
    """Fit on rows with text, label and weight. Every fifth row calibrates."""
    model, rng = QualityModel(seed), np.random.default_rng(seed)
    if len({row["label"] for row in sample}) < 2:
        model.p["out"][:], model.base = 0, constant_logit(sample)
        return model
    fit = [r for i, r in enumerate(sample) if i % 5] or sample
    numbers = WordNumbers()
    cuts = [cut([r["text"]], numbers)[:2] for r in fit]
    flat, offsets = word_features(list(numbers))
    shapes = word_shapes(list(numbers))
    label = np.array([r["label"] for r in fit], np.float32)
    weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6)).astype(np.float32)
    adam = Adam(model.p, rate)
    for _ in range(epochs):
        order = rng.permutation(len(fit))
        for begin in range(0, len(fit), batch):
            chosen = order[begin : begin + batch]
            _fit_batch(model, adam, [cuts[i] for i in chosen], flat, offsets, shapes, label[chosen], weight[chosen])
    check = [r for i, r in enumerate(sample) if not i % 5]
    if len({r["label"] for r in check}) < 2:
        check = sample
    passages = Passages(model.p["rows"])
    raw = np.concatenate([model.forward(*passages.of(run))[0] for run in blocks([r["text"] for r in check])])
    label = np.array([r["label"] for r in check], float)
    weight = np.array([r["weight"] for r in check], float)
    even = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    slope, _ = calibrate(raw, label, even)
    # The cut that serves both labels best is the score 0.3.
    cut_at = -best_threshold(-raw, 1 - label, weight)
    model.slope, model.base = slope, float(np.log(0.3 / 0.7) - slope * cut_at)
    return model


def _fit_batch(model, adam, cuts, flat, offsets, shapes, label, weight):
    p = model.p
    words = np.concatenate([w for w, _ in cuts])
    shift = np.cumsum([0, *(len(w) for w, _ in cuts)])
    starts = np.concatenate([*(s[:-1] + k for (_, s), k in zip(cuts, shift[:-1], strict=True)), shift[-1:]])
    bags = np.cumsum([0, *(len(s) - 1 for _, s in cuts)])
    local, inner = np.unique(words, return_inverse=True)
    span = offsets[local + 1] - offsets[local]
    begin = np.concatenate([[0], np.cumsum(span)])
    own = flat[np.arange(begin[-1]) + np.repeat(offsets[local] - begin[:-1], span)]
    vectors = means(p["rows"], own, begin)
    features = np.concatenate([means(vectors, inner, starts), passage_shapes(shapes, words, starts)], axis=1)
    raw, (h, t, s, a, z) = model.forward(features, bags, np.matmul)
    size = np.diff(bags)
    wrong = (weight * (sigmoid(raw) - label) / len(cuts)).astype(np.float32)
    each = np.repeat(wrong, size)[:, None]
    # z = sum of a h; a is a softmax, so its logit moves z by a (h - z).
    d_h = each * a[:, None] * p["out"]
    d_logit = (each * a[:, None] * (h - np.repeat(z, size, axis=0)) * p["out"]).sum(axis=1, keepdims=True)
    d_t, d_s = d_logit * p["attend"] * s * (1 - t * t), d_logit * p["attend"] * t * s * (1 - s)
    d_h = d_h + d_t @ p["tanh"].T + d_s @ p["gate"].T
    d_in = d_h * (1 - h * h)
    d_word = (d_in @ p["encode"].T)[:, :DIMENSIONS] / np.diff(starts)[:, None]
    decay = 1e-4
    adam.step({
        "out": z.T @ wrong + decay * p["out"], "shift": np.array([wrong.sum()], np.float32),
        "attend": ((t * s) * d_logit).sum(axis=0) + decay * p["attend"],
        "tanh": h.T @ d_t + decay * p["tanh"], "gate": h.T @ d_s + decay * p["gate"],
        "encode": features.T @ d_in + decay * p["encode"], "encode_shift": d_in.sum(axis=0),
    })
    moved = np.zeros_like(vectors)
    np.add.at(moved, inner, np.repeat(d_word, np.diff(starts), axis=0).astype(np.float32))
    adam.step_rows("rows", *row_sums(own, np.repeat(moved / span[:, None], span, axis=0)))


def fit(
    documents: DataFrame, labels: DataFrame, divisor: int = 5, held_out: int = 0, most: tuple[int, int] = (2000, 3000)
) -> QualityModel:
    """Learn from at most ``most[label]`` labelled documents of each class whose crc32(doc_id) remainder is not held out."""
    return train(training_sample(documents, labels, "quality", divisor, held_out, most))


def score(documents: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Add ``score``, 0 to 1, and ``n_passages``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        passages = Passages(model.p["rows"])

        def columns(batch):
            scores, counts = [np.empty(0)], [np.empty(0, np.int64)]
            for run in blocks(texts_of(batch, text)):
                features, bags = passages.of(run)
                scores.append(model.score(model.forward(features, bags)[0]))
                counts.append(np.diff(bags))
            return [np.concatenate(scores), np.concatenate(counts)]

        return columns

    return with_columns(documents, "score double, n_passages long", make)
