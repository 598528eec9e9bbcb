"""Toxicity by a convolutional text classifier, trained in numpy.

Words become means of hashed embedding rows. Filters of several widths slide over the words; each filter keeps its
largest answer in the text, and a logistic layer reads these. It is learned from a bounded sample of labelled
documents; a part of the sample is set aside to calibrate the score and to choose a threshold per language.
The language is used for the decision alone, never for the score.

The score of a text depends on nothing but the text. A null or empty text is one empty word and gets the score
that the model gives to it. Very long texts are read whole. Equal rows get equal results; an empty table gives
an empty table. Columns named like an output are replaced. Where the sample lacks a class, all texts
get its share of label 1 as their score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisect.llm.bytebpe import blocks
from trisect.llm.hashed_words import (
    SLOTS, Adam, WordNumbers, best_threshold, calibrate, constant_logit, means, row_sums, sigmoid, split_words, steady, training_sample,
    word_features,
)
from trisect.llm.tables import fresh_worker, texts_of, with_columns

WIDTHS = (1, 2, 3)
DIMENSIONS, FILTERS = 16, 12
# Words whose filter answers one task remembers; beyond it the memory is emptied.
MOST_REMEMBERED = 80_000


class ToxicityModel:
    """Weights, calibration and thresholds. ``taps`` holds, per width and place in it, a matrix of filters."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS
        taps = sum(WIDTHS)
        self.p = {
            "rows": rng.normal(0, 0.3, (SLOTS, DIMENSIONS)).astype(np.float32),
            "taps": rng.normal(0, 0.3, (taps, DIMENSIONS, FILTERS)).astype(np.float32),
            "bias": np.zeros(n, np.float32),
            "out": rng.normal(0, 0.3, n).astype(np.float32),
            "shift": np.zeros(1, np.float32),
        }
        self.slope, self.base = 1.0, 0.0
        self.threshold, self.by_language = 0.5, {}

    def answers(self, vectors: np.ndarray, dot=np.matmul) -> np.ndarray:
        """What each word gives to each tap: [words, taps, filters]."""
        flat = self.p["taps"].transpose(1, 0, 2).reshape(DIMENSIONS, -1)
        return dot(vectors, flat).reshape(len(vectors), -1, FILTERS)

    def pooled(self, answers: np.ndarray, words: np.ndarray, offsets: np.ndarray, places: bool = False):
        """Largest answer of each filter in each text; with ``places`` also where it begins.

        Two words that answer nothing stand after each text, so no window reaches into the next one.
        """
        best, where = [], []
        tap = 0
        for k, width in enumerate(WIDTHS):
            total = answers[words, tap].copy()
            for j in range(1, width):
                total[:-j] += answers[words[j:], tap + j]
            tap += width
            if not places:
                # Every other run is padding.
                bounds = np.stack([offsets[:-1], offsets[1:] - PAD], axis=1).ravel()
                top = np.maximum.reduceat(total, bounds, axis=0)[::2]
            else:
                top = np.empty((len(offsets) - 1, FILTERS), np.float32)
                at = np.empty((len(offsets) - 1, FILTERS), np.int64)
                for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:] - PAD, strict=True)):
                    at[i] = a + total[a:b].argmax(axis=0)
                    top[i] = total[at[i], np.arange(FILTERS)]
                where.append(at)
            best.append(top + self.p["bias"][k * FILTERS : (k + 1) * FILTERS])
        pooled = np.concatenate(best, axis=1)
        return (pooled, np.concatenate(where, axis=1)) if places else pooled

    def raw(self, pooled: np.ndarray, dot=np.matmul) -> np.ndarray:
        return dot(np.maximum(pooled, 0), self.p["out"]) + self.p["shift"]

    def score(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * raw.astype(np.float64) + self.base)


PAD = max(WIDTHS) - 1


def _numbered(texts: list[str], numbers: WordNumbers, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts with padding after each, and where each text begins."""
    look = numbers.__getitem__
    words: list[int] = []
    offsets = [0]
    for text in texts:
        words.extend(map(look, split_words(text)))
        words.extend([pad] * PAD)
        offsets.append(len(words))
    return np.array(words, np.int64), np.array(offsets, np.int64)


def train(sample: list, epochs: int = 8, batch: int = 48, rate: float = 0.004, seed: int = 7) -> ToxicityModel:
    """Fit on rows with text, lang, label, weight. Every fifth row calibrates and chooses thresholds."""
    model, rng = ToxicityModel(seed), np.random.default_rng(seed)
    if len({row["label"] for row in sample}) < 2:
        model.p["out"][:], model.base, model.threshold = 0, constant_logit(sample), 0.3
        return model
    fit = [r for i, r in enumerate(sample) if i % 5] or sample
    numbers = WordNumbers()
    pad = numbers[""]
    numbered = [_numbered([r["text"]], numbers, pad)[0] for r in fit]
    flat, offsets = word_features(list(numbers))
    label = np.array([r["label"] for r in fit], np.float32)
    weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6)).astype(np.float32)
    adam = Adam(model.p, rate)
    for _ in range(epochs):
        order = rng.permutation(len(fit))
        for begin in range(0, len(fit), batch):
            chosen = order[begin : begin + batch]
            _fit_batch(model, adam, [numbered[i] for i in chosen], flat, offsets, pad, label[chosen], weight[chosen])
    check = [r for i, r in enumerate(sample) if not i % 5]
    if len({r["label"] for r in check}) < 2:
        check = sample
    raw = np.concatenate([Scorer(model).raw(run) for run in blocks([r["text"] for r in check])])
    _calibrate(model, raw, check)
    return model


def _fit_batch(model, adam, texts, flat, offsets, pad, label, weight):
    p = model.p
    lengths = np.array([len(t) for t in texts])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    local, words = np.unique(np.concatenate(texts), return_inverse=True)
    span = offsets[local + 1] - offsets[local]
    starts = np.concatenate([[0], np.cumsum(span)])
    own = flat[np.arange(starts[-1]) + np.repeat(offsets[local] - starts[:-1], span)]
    vectors = means(p["rows"], own, starts)
    is_pad = local == pad
    vectors[is_pad] = 0
    pooled, at = model.pooled(model.answers(vectors), words, ends, places=True)
    live = pooled > 0
    wrong = weight * (sigmoid(model.raw(pooled)) - label) / len(texts)
    grad = np.where(live, wrong[:, None] * p["out"], 0).astype(np.float32)
    grads = {
        "out": (np.maximum(pooled, 0) * wrong[:, None]).sum(axis=0) + 1e-4 * p["out"],
        "shift": np.array([wrong.sum()], np.float32),
        "bias": grad.sum(axis=0),
        "taps": np.zeros_like(p["taps"]),
    }
    moved = np.zeros_like(vectors)
    tap = 0
    for k, width in enumerate(WIDTHS):
        part = slice(k * FILTERS, (k + 1) * FILTERS)
        g, place = grad[:, part], at[:, part]
        for j in range(width):
            word = words[place + j]
            grads["taps"][tap + j] = np.einsum("nfd,nf->df", vectors[word], g)
            push = g[:, :, None] * p["taps"][tap + j].T[None]
            np.add.at(moved, word.ravel(), push.reshape(-1, DIMENSIONS))
        tap += width
    moved[is_pad] = 0
    touched = np.flatnonzero(moved.any(axis=1))
    if len(touched):
        each = span[touched]
        at_rows = np.arange(each.sum()) + np.repeat(starts[touched] - np.cumsum(each) + each, each)
        adam.step_rows("rows", *row_sums(own[at_rows], np.repeat(moved[touched] / each[:, None], each, axis=0)))
    adam.step(grads)


def _calibrate(model: ToxicityModel, raw: np.ndarray, rows: list) -> None:
    label = np.array([r["label"] for r in rows], float)
    weight = np.array([r["weight"] for r in rows], float)
    even = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())
    slope, base = calibrate(raw, label, even)
    # The best cut of all languages together is the score 0.3.
    cut = best_threshold(raw, label, weight)
    model.slope, model.base = slope, float(np.log(0.3 / 0.7) - slope * cut)
    model.threshold = 0.3
    score = model.score(raw)
    languages = [r["lang"] for r in rows]
    for lang in sorted({x for x in languages if x}):
        mine = np.array([x == lang for x in languages])
        if min(label[mine].sum(), (1 - label[mine]).sum()) >= 20:
            # A language's cut moves the common one only as far as its own rows ask for it.
            own = best_threshold(score[mine], label[mine], weight[mine])
            own_f1, common_f1 = (_f1(score[mine] >= t, label[mine], weight[mine]) for t in (own, 0.3))
            model.by_language[lang] = own if own_f1 > common_f1 else 0.3


def _f1(called: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    return float(2 * (weight * called * label).sum() / max((weight * (called + label)).sum(), 1e-9))


class Scorer:
    """Raw scores of texts; remembers the filter answers of words."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self._forget()

    def _forget(self):
        self.numbers = WordNumbers()
        # Room that no word has used takes no memory; growing by copies would hold all answers twice.
        self.answers = np.empty((MOST_REMEMBERED * 5 // 4, sum(WIDTHS), FILTERS), np.float32)
        self.known = 0

    def _remember(self, answers: np.ndarray):
        known, self.known = self.known, self.known + len(answers)
        if self.known > len(self.answers):
            room = np.empty((2 * self.known, *self.answers.shape[1:]), np.float32)
            room[:known] = self.answers[:known]
            self.answers = room
        self.answers[known : self.known] = answers

    def raw(self, texts: list[str]) -> np.ndarray:
        if len(self.numbers) > MOST_REMEMBERED:
            self._forget()
        pad = self.numbers[""]
        words, offsets = _numbered(texts, self.numbers, pad)
        if self.numbers.new:
            flat, at = word_features(self.numbers.new)
            vectors = means(self.model.p["rows"], flat, at)
            vectors[[i for i, w in enumerate(self.numbers.new) if w == ""]] = 0
            self._remember(self.model.answers(vectors, steady))
            self.numbers.new = []
        return self.model.raw(self.model.pooled(self.answers, words, offsets), steady)


def fit(
    documents: DataFrame, labels: DataFrame, divisor: int = 4, held_out: int = 2, most: tuple[int, int] = (4000, 2000)
) -> ToxicityModel:
    """Learn from at most ``most[label]`` labelled documents of each class whose crc32(doc_id) remainder is not held out."""
    return train(training_sample(documents, labels, "toxic", divisor, held_out, most))


def score(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``score``, and ``toxic``: whether the score reaches the threshold of the row's language."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        fresh_worker()
        model = shared.value
        scorer = Scorer(model)

        def columns(batch):
            runs = [model.score(scorer.raw(run)) for run in blocks(texts_of(batch, text), 500_000)]
            return [np.concatenate([np.empty(0), *runs])]

        return columns

    scored = with_columns(documents, "score double", make)
    cut = F.lit(model.threshold)
    if "lang" in scored.columns:
        for lang, value in model.by_language.items():
            cut = F.when(F.col("lang").cast("string") == lang, F.lit(value)).otherwise(cut)
    return scored.withColumn("toxic", F.col("score") >= cut)


def keep_clean(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The documents that are not toxic, with their own columns, also where they are named like an output."""
    names = [f"_{i}" for i in range(len(documents.columns))]
    plain = documents.toDF(*names)
    by_name = dict(zip(documents.columns, names, strict=True))
    plain = plain.withColumn("lang", F.col(by_name["lang"])) if "lang" in by_name else plain
    scored = score(plain, model, by_name[text])
    return scored.where("NOT toxic").select(*names).toDF(*documents.columns)
