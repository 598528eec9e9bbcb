"""Words as hashed features, and what the two text classifiers share: samples, calibration, metrics.

A word is a run of non-white-space characters, lower-cased, without marks at its ends. Its features are a hash of the
word and hashes of its beginnings, so that rare and inflected words are not unknown.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.llm.tables import id_remainder, text_or_empty

SLOTS = 1 << 15
# Lengths of the beginnings of a word that are features of their own.
BEGINNINGS = range(3, 9)
MARKS = ".,;:!?\"'()[]|#*$%&<>"


def split_words(text: str) -> list[str]:
    """Pieces of a text as they stand; an empty text has one empty piece, so that every text has a word."""
    return text.split() or [""]


def word_features(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all pieces end to end, and where each begins. Every piece has one slot at least."""
    words = [p.lower().strip(MARKS) for p in pieces]
    own = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint32, len(words)) % SLOTS
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(length) - length
    known = np.clip(length - min(BEGINNINGS) + 1, 0, len(BEGINNINGS))
    offsets = np.concatenate([[0], np.cumsum(1 + known)])
    flat = np.empty(int(offsets[-1]), np.int64)
    flat[offsets[:-1]] = own
    hashed = np.zeros(len(words), np.uint64)
    for k in range(max(BEGINNINGS)):
        long_enough = np.flatnonzero(length > k)
        hashed[long_enough] = (hashed[long_enough] * np.uint64(0x01000193) + codes[begin[long_enough] + k] + np.uint64(k)) & np.uint64(
            0xFFFFFFFF
        )
        if k + 1 in BEGINNINGS:
            slot = ((hashed[long_enough] * np.uint64(0x9E3779B1)) >> np.uint64(9)) % np.uint64(SLOTS)
            flat[offsets[long_enough] + k + 2 - min(BEGINNINGS)] = slot
    return flat, offsets


class WordNumbers(dict):
    """Numbers pieces in the order they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece):
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


def means(table: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The mean of the table rows of each run; no run is empty."""
    sums = np.add.reduceat(table[flat], offsets[:-1], axis=0)
    return sums / np.diff(offsets)[:, None].astype(np.float32)


def training_sample(
    documents: DataFrame, labels: DataFrame, target: str, divisor: int, held_out: int, most: tuple[int, int]
) -> list:
    """(text, lang, label, weight) of a bounded sample of labelled documents outside the held-out remainder.

    Per class the ``most[label]`` rows with the smallest hash of id and text; they are the same on any partitioning.
    ``weight`` is how many labelled documents of its class a row stands for. Documents without text or label, and
    ids with contradicting labels, teach nothing.
    """
    agreed = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min(target).alias("label"), F.max(target).alias("_most"))
    agreed = agreed.where("label = _most AND label IN (0, 1)").select("_id", "label")
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    rows = documents.where((id_remainder("doc_id", divisor) != held_out) & (text_or_empty() != ""))
    narrow = rows.select(F.col("doc_id").alias("_id"), F.xxhash64("doc_id", "text").alias("_order"))
    joined = narrow.join(agreed, "_id")
    counts = {row["label"]: row["count"] for row in joined.groupBy("label").count().collect()}
    chosen = None
    for label in (0, 1):
        part = joined.where(F.col("label") == label).orderBy("_order", "_id").limit(most[label])
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most sum(most) keys; the rows of equal keys are equal documents.
    keys = F.broadcast(chosen.distinct())
    texts = rows.select(
        F.col("doc_id").alias("_id"), F.xxhash64("doc_id", "text").alias("_order"), F.col("text").cast("string").alias("text"),
        lang.alias("lang"),
    )
    sample = texts.join(keys, ["_id", "_order"]).dropDuplicates(["_id", "_order"]).collect()
    taken = {label: sum(row["label"] == label for row in sample) for label in (0, 1)}
    # Learn and calibrate in an order that has nothing to do with class.
    return [
        {"text": r["text"], "lang": r["lang"], "label": r["label"], "weight": counts[r["label"]] / taken[r["label"]]}
        for r in sorted(sample, key=lambda row: (row["_order"], row["_id"]))
    ]


def held_out_column(divisor: int, remainder: int) -> Column:
    return id_remainder("doc_id", divisor) == remainder


def steady(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A matrix product whose rows do not depend on the other rows, not even in the last digit, as BLAS's may."""
    return np.einsum("ij,jk->ik" if b.ndim == 2 else "ij,j->i", a, b, optimize=False)


def constant_logit(sample: list) -> float:
    """The logit of a score for samples of one class or none: the share of label 1, as good as 0 without labels."""
    share = np.clip(np.mean([row["label"] for row in sample]) if sample else 0.0, 1e-6, 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibrate(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of labels on raw scores, by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * raw + b)
        g = weight * (p - label)
        h = weight * np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * raw).sum() + 1e-2 * (a - 1), g.sum()])
        hess = np.array([[(h * raw * raw).sum() + 1e-2, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


def best_threshold(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The score from which on calling label 1 gives the best F1; midway to the next score below."""
    order = np.argsort(-score, kind="stable")
    s, y, w = score[order], label[order], weight[order]
    hits, called = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hits / (called + (w * y).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] / 2)


class Adam:
    """Adam steps for dense arrays; rows of tables are stepped sparsely with their own sums of squares."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            self.p[k] -= self.rate * m / (np.sqrt(v) + 1e-8)

    def step_rows(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        """Adagrad on the rows that a batch touched."""
        self.v[name][rows] += grad * grad
        self.p[name][rows] -= self.rate * 5 * grad / (np.sqrt(self.v[name][rows]) + 1e-6)


def row_sums(rows: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their gradients."""
    order = np.argsort(rows, kind="stable")
    rows, first = np.unique(rows[order], return_index=True)
    return rows, np.add.reduceat(grad[order], first, axis=0)
