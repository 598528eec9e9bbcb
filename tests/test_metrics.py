import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from trisect.operators.metrics import (
    accuracy,
    calibration_bins,
    classification_report,
    confusion_matrix,
    f1_per_class,
    f1_weighted,
    label_cardinality,
    roc_auc_binary,
    roc_auc_ovr_weighted,
    roc_auc_per_class,
    score_deciles,
)


def scored(n=3000, seed=3):
    """Labels with scores of which a third are equal."""
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    s = np.where(rng.random(n) < 0.33, 0.5, np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 3))
    return pd.DataFrame({"k": range(n), "y": y, "s": s})


def auc_by_pairs(y, s):
    pos, neg = s[y], s[~y]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_equals_counting_pairs(spark, tiny_buckets):
    frame = scored()
    df = spark.createDataFrame(frame)
    expected = auc_by_pairs(frame["y"].to_numpy() == 1, frame["s"].to_numpy())
    row = roc_auc_binary(df, "y", "s").first()
    assert row["auc"] == pytest.approx(expected, abs=1e-13)
    assert (row["n_pos"], row["n_neg"]) == (frame["y"].sum(), (1 - frame["y"]).sum())
    raw = VectorAssembler(inputCols=["s"], outputCol="v").transform(df).withColumn("y", F.col("y").cast("double"))
    exact = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    assert exact.evaluate(raw) == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("classes", [1, 2])
def test_scores_are_made_once_per_row(spark, classes):
    made = spark.sparkContext.accumulator(0)

    def counted(s):
        made.add(1)
        return s

    df = spark.createDataFrame(scored()).withColumn("s", F.udf(counted, "double")("s"))
    if classes == 1:
        roc_auc_binary(df, "y", "s").collect()
    else:
        # Both classes of a row are scored together.
        roc_auc_per_class(df, "y", {0: -F.col("s"), 1: F.col("s")}).collect()
    assert made.value == 3000


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, s double")
    assert roc_auc_binary(df, "y", "s").first()["auc"] is None


def test_one_vs_rest(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"y": rng.choice(["a", "b", "c"], 900, p=[0.6, 0.3, 0.1])})
    for c in "abc":
        frame[c] = np.round(rng.random(900) + 0.3 * (frame["y"] == c), 2)
    df = spark.createDataFrame(frame)
    scores = {c: F.col(c) for c in "abc"}
    expected = {c: auc_by_pairs((frame["y"] == c).to_numpy(), frame[c].to_numpy()) for c in "abc"}
    found = {r["class"]: r["auc"] for r in roc_auc_per_class(df, "y", scores).collect()}
    assert found == pytest.approx(expected, abs=1e-13)
    weights = frame["y"].value_counts(normalize=True)
    weighted = sum(expected[c] * weights[c] for c in "abc")
    assert roc_auc_ovr_weighted(df, "y", scores).first()["auc"] == pytest.approx(weighted, abs=1e-13)


def test_confusion_based_metrics(spark):
    rng = np.random.default_rng(9)
    frame = pd.DataFrame({"y": rng.choice([0.0, 1.0, 2.0], 500), "p": rng.choice([0.0, 1.0, 3.0], 500)})
    df = spark.createDataFrame(frame)
    confusion = confusion_matrix(df, "y", "p")
    judge = lambda name: MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
    assert accuracy(confusion).first()[0] == pytest.approx((frame["y"] == frame["p"]).mean())
    assert f1_weighted(confusion).first()[0] == pytest.approx(judge("f1"))
    per_class = {r["class"]: (r["f1"], r["support"]) for r in f1_per_class(confusion).collect()}
    assert per_class[2.0] == (0.0, (frame["y"] == 2).sum()) and per_class[3.0] == (0.0, 0)


def test_report_and_cardinality(spark):
    df = spark.createDataFrame(scored(400)).withColumn("p", (F.col("s") > 0.5).cast("int"))
    found = {r["metric"]: r["value"] for r in classification_report(df, "y", "p", {0: 1 - F.col("s"), 1: F.col("s")}).collect()}
    assert list(found) == ["ROC AUC", "Accuracy", "F1 Score"]
    assert found["ROC AUC"] == roc_auc_binary(df, "y", "s").first()["auc"]
    assert label_cardinality(df, "y").first().asDict() == {"n_labels": 2, "task": "binary"}
    assert label_cardinality(df, "k").first()["task"] == "multiclass"


@pytest.mark.parametrize("n", [7, 10, 2003])
def test_deciles(spark, tiny_buckets, n):
    df = spark.createDataFrame(scored(n))
    found = score_deciles(df, "y", F.col("s"), ["k"]).orderBy("decile").toPandas()
    expected = pd.Series(np.arange(n) * 10 // n + 1).value_counts().sort_index()
    assert found["decile"].tolist() == expected.index.tolist() and found["n"].tolist() == expected.tolist()
    assert (found["min_score"].iloc[:-1].to_numpy() >= found["max_score"].iloc[1:].to_numpy()).all()
    assert found["gain"].iloc[-1] == 1.0


def test_calibration(spark):
    found = calibration_bins(spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.05)], "y int, s double"), "y", F.col("s"))
    assert {r["bin"]: (r["n"], r["rate"]) for r in found.collect()} == {9: (1, 1.0), 0: (2, 0.5)}


def test_deciles_without_positives(spark):
    df = spark.createDataFrame([(i, 0, i / 20) for i in range(20)], "k int, y int, s double")
    found = score_deciles(df, "y", F.col("s"), ["k"]).toPandas()
    assert found["n"].tolist() == [2] * 10 and found["lift"].isna().all() and (found["rate"] == 0).all()
