"""Exact classifier metrics: ROC AUC (binary and one-vs-rest), accuracy, weighted F1, deciles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisect.functions.keys import join_groups, literal, row_hash
from trisect.functions.stats import ratio
from trisect.operators.ranking import (
    VALUE_ORDER,
    Buckets,
    add_buckets,
    at_positions,
    fit_buckets,
    order_by_value,
    running_totals,
    up_to,
)
from trisect.session import keep_columns, lookup

# Fixed values
METRIC_NAMES = {"auc": "ROC AUC", "accuracy": "Accuracy", "f1": "F1 Score"}
DECILES = 10
# Rows that a task holds when it packs scores.
PACKED_ROWS = 2_000_000


def label_cardinality(df: DataFrame, label: str) -> DataFrame:
    """Number of distinct labels and the task it implies: ``n_labels``, ``task``."""
    n = F.count_distinct(label).alias("n_labels")
    return df.agg(n).withColumn("task", F.when(F.col("n_labels") == 2, "binary").otherwise("multiclass"))


def _auc(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rank-sum AUC of ``score`` for the boolean ``positive``, per group; null if one side is empty.

    Scores are counted before they are sorted; a positive beats the negatives below its score and
    half of those level with it. The rows, whose scores a model may have to make, are read once.
    """
    rows = rows.withColumn("score", F.col("score").cast("double"))
    counts = keep_columns(
        rows.groupBy(*by, "score").agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")), "scores"
    )
    # A filter on the rows would make every score twice.
    counts = counts.where("score IS NOT NULL")
    binned = add_buckets(counts, fit_buckets(counts, ["score"]), {"score": "bucket"})
    ranked = running_totals(binned, by, "bucket", [F.col("score")], ["neg"])
    beaten = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    return ranked.groupBy(*by).agg(
        ratio(beaten, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )


def _packer(cuts: np.ndarray, most: int):
    """A function that packs batches of ``part, score, positive``: per part, side and bucket of scores, distinct scores with their counts.

    It is made inside, so that workers get it as it is and need not import this module.
    """
    size = len(cuts) + 1

    def shown(values):
        # Bytes of equal rank side by side: sorted numbers share their first ones, which compress well.
        return values.view(np.uint8).reshape(len(values), 8).T.tobytes()

    def packed(held):
        part, score, positive = (np.concatenate([h[i] for h in held]) for i in range(3))
        side = 2 * part + positive
        out = [], [], [], []
        for at in np.flatnonzero(np.bincount(side)):
            values = np.sort(score[side == at])
            new = (values[1:] != values[:-1]) & ~(np.isnan(values[1:]) & np.isnan(values[:-1]))
            first = np.flatnonzero(np.append(True, new))
            counts, values = np.diff(np.append(first, len(values))), values[first]
            ends = np.append(np.searchsorted(values, cuts, side="left"), len(values))
            starts = np.append(0, ends[:-1])
            for bucket in np.flatnonzero(ends > starts):
                a, b = starts[bucket], ends[bucket]
                row = (int(at) // 2 * size + int(bucket), bool(at % 2), shown(values[a:b]), shown(counts[a:b]))
                for column, value in zip(out, row):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["slot", "positive", "scores", "counts"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            batch = batch.filter(batch.column("score").is_valid())
            if batch.num_rows:
                part, positive = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "positive"))
                # Minus zero is level with zero.
                held.append((part, batch.column("score").to_numpy() + 0.0, positive))
                rows += batch.num_rows
            if rows >= most:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    return run


def _beaten():
    """A function from the packed scores of a part and bucket to its rows, and the negatives its positives beat within it."""

    def read(table, column, kind):
        blobs = [np.frombuffer(v.as_py(), np.uint8).reshape(8, -1).T.copy().view(kind).ravel() for v in table.column(column)]
        return np.concatenate([np.empty(0, kind), *blobs])

    def run(table):
        positive = table.column("positive")
        (pos_at, pos), (neg_at, neg) = (
            (read(t, "scores", np.float64), read(t, "counts", np.int64)) for t in (table.filter(positive), table.filter(pc.invert(positive)))
        )
        order = np.argsort(neg_at)
        neg_at, below = neg_at[order], np.append(0, np.cumsum(neg[order]))
        lower, upper = (below[np.searchsorted(neg_at, pos_at, side=s)] for s in ("left", "right"))
        beaten = float((pos * ((lower + upper) / 2)).sum())
        row = (table.column("slot")[0].as_py(), int(pos.sum()), int(neg.sum()), beaten)
        return pa.table({n: [v] for n, v in zip(("slot", "n_pos", "n_neg", "beaten"), row)})

    return run


def roc_auc_by(rows: DataFrame, buckets: Buckets) -> DataFrame:
    """Exact AUC per numbered ``part`` of rows with a ``score`` and a boolean ``positive``: ``part``, ``auc``, ``n_pos``, ``n_neg``.

    For many parts of a large table: scores are made once and shuffled once, by part and bucket, packed in binary columns of
    distinct scores with their counts. ``buckets`` of scores only decide how evenly the work is spread; parts without a score have no row.
    """
    cuts = buckets.cuts()
    parted = rows.select(F.col("part").cast("long").alias("part"), F.col("score").cast("double").alias("score"), "positive")
    slots = (
        parted.mapInArrow(_packer(cuts, PACKED_ROWS), "slot long, positive boolean, scores binary, counts binary")
        .groupBy("slot").applyInArrow(_beaten(), "slot long, n_pos long, n_neg long, beaten double")
    )
    # One row per part and bucket.
    part = F.floor(F.col("slot") / (len(cuts) + 1)).alias("part")
    earlier = Window.partitionBy("part").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    ranked = slots.select("*", part).withColumn("before", F.coalesce(F.sum("n_neg").over(earlier), F.lit(0)))
    beaten = F.sum(F.col("beaten") + F.col("n_pos").cast("double") * F.col("before"))
    return ranked.groupBy("part").agg(
        ratio(beaten, F.sum("n_pos").cast("double") * F.sum("n_neg")).alias("auc"),
        F.sum("n_pos").alias("n_pos"),
        F.sum("n_neg").alias("n_neg"),
    )


def roc_auc_binary(df: DataFrame, label: str, score: Column | str, positive=1) -> DataFrame:
    """Exact area under the ROC curve: ``auc``, ``n_pos``, ``n_neg``."""
    score = F.col(score) if isinstance(score, str) else score
    return _auc(df.select((F.col(label) == positive).alias("positive"), score.alias("score")), [])


def roc_auc_per_class(df: DataFrame, label: str, scores: dict[object, Column]) -> DataFrame:
    """One-vs-rest AUC of each class: ``class``, ``auc``, ``n_pos``, ``n_neg``."""
    long = df.select(F.inline(F.array(*[
        F.struct(
            F.lit(str(c)).alias("class"), score.cast("double").alias("score"), (F.col(label) == F.lit(c)).alias("positive")
        )
        for c, score in scores.items()
    ])))
    return _auc(long, ["class"])


def roc_auc_ovr_weighted(df: DataFrame, label: str, scores: dict[object, Column]) -> DataFrame:
    """One-vs-rest AUC averaged with the class frequencies as weights: ``auc``."""
    per_class = roc_auc_per_class(df, label, scores)
    weight = F.when(F.col("auc").isNotNull(), F.col("n_pos"))
    return per_class.agg(ratio(F.sum(F.col("auc") * weight), F.sum(weight)).alias("auc"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per label and prediction: ``label``, ``prediction``, ``n``."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy(confusion: DataFrame) -> DataFrame:
    """Share of right predictions, from a confusion matrix: ``accuracy``."""
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return confusion.agg(ratio(right, F.sum("n")).alias("accuracy"))


def f1_per_class(confusion: DataFrame) -> DataFrame:
    """F1 and support of each class, from a confusion matrix: ``class``, ``f1``, ``support``."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = confusion.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("actual"), F.col("n").alias("predicted"), none.alias("hits")),
    )))
    total = F.sum("actual") + F.sum("predicted")
    return sides.groupBy("class").agg(
        (2.0 * F.sum("hits") / total).alias("f1"), F.sum("actual").alias("support")
    )


def f1_weighted(confusion: DataFrame) -> DataFrame:
    """F1 averaged with the label counts as weights: ``f1``."""
    return f1_per_class(confusion).agg(
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1")
    )


def classification_report(
    df: DataFrame, label: str, prediction: str, scores: dict[object, Column]
) -> DataFrame:
    """The metric bundle as ``metric``, ``value``.

    ``scores`` maps each class to its score; with two classes the AUC is that of the second.
    """
    confusion = lookup(confusion_matrix(df, label, prediction))
    classes = list(scores)
    if len(classes) == 2:
        area = roc_auc_binary(df, label, scores[classes[1]], classes[1])
    else:
        area = roc_auc_ovr_weighted(df, label, scores)
    tables = {"auc": area, "accuracy": accuracy(confusion), "f1": f1_weighted(confusion)}
    rows = [t.select(F.lit(METRIC_NAMES[k]).alias("metric"), F.col(k).alias("value")) for k, t in tables.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def score_deciles(df: DataFrame, label: str, score: Column, key: Sequence[str], positive=1) -> DataFrame:
    """Lift table over ten equal groups by falling score; ties are ordered by row hash.

    ``decile`` (1 = highest), ``n``, ``positives``, ``min_score``, ``max_score``, ``rate``,
    ``lift``, ``gain`` (share of all positives up to this decile).
    """
    rows = df.select(
        *key, (-score.cast("double")).alias("_falling"), score.alias("score"), (F.col(label) == positive).alias("positive")
    )
    tie = row_hash(key)
    ends = {str(d): (lambda n, d=d: F.floor((n * d + DECILES - 1) / DECILES)) for d in range(1, DECILES)}
    cuts = at_positions(order_by_value(rows, "_falling", tie), [], "_bucket", VALUE_ORDER, ends)
    # Nine cut values at most.
    cuts = cuts.select("label", F.struct(*VALUE_ORDER).alias("cut"))
    found = sorted(cuts.collect(), key=lambda r: int(r["label"]))
    kind = cuts.schema["cut"].dataType
    passed = [F.when(up_to(rows, "_falling", tie, literal(r["cut"], kind)), 0).otherwise(1) for r in found]
    decile = sum(passed, F.lit(1))
    table = lookup(
        rows.select(decile.alias("decile"), "score", "positive")
        .groupBy("decile")
        .agg(
            F.count("*").alias("n"),
            F.count_if("positive").alias("positives"),
            F.min("score").alias("min_score"),
            F.max("score").alias("max_score"),
        )
    )
    totals = table.agg(F.sum("n").alias("all_n"), F.sum("positives").alias("all_positives"))
    ranked = running_totals(join_groups(table, totals, []), [], "decile", [], ["positives"])
    rate = ratio(F.col("positives"), F.col("n"))
    return ranked.select(
        "decile", "n", "positives", "min_score", "max_score",
        rate.alias("rate"),
        ratio(rate, ratio(F.col("all_positives"), F.col("all_n"))).alias("lift"),
        ratio(F.col("positives_before") + F.col("positives"), F.col("all_positives")).alias("gain"),
    )


def calibration_bins(df: DataFrame, label: str, probability: Column, bins: int = 10, positive=1) -> DataFrame:
    """Mean probability against observed rate in equal bins of 0..1: ``bin, n, mean_score, rate``."""
    place = F.least(F.floor(probability * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(place.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(probability).alias("mean_score"),
        F.avg((F.col(label) == positive).cast("double")).alias("rate"),
    )
