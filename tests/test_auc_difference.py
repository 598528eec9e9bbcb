import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from trisect.functions.stats import normal_two_sided
from trisect.operators.auc_difference import auc_difference
from trisect.plans.monitoring import validate_model


def plainly(y, a, b):
    """Areas, difference and its standard error, from all pairs of a positive and a negative row."""
    beats = [np.where(s[y == 1][:, None] == s[y == 0][None, :], 0.5, s[y == 1][:, None] > s[y == 0][None, :]) for s in (a, b)]
    areas = [m.mean() for m in beats]
    gap = beats[0] - beats[1]
    variance = gap.mean(axis=1).var(ddof=1) / (y == 1).sum() + gap.mean(axis=0).var(ddof=1) / (y == 0).sum()
    return areas, areas[0] - areas[1], math.sqrt(variance)


def table(spark, y, a, b):
    return spark.createDataFrame(list(zip(y.tolist(), a.tolist(), b.tolist(), strict=True)), "y int, a double, b double").repartition(5)


@pytest.mark.parametrize("levels,seed", [(3, 1), (20, 2), (100_000, 3)])
def test_equals_all_pairs(spark, tiny_buckets, levels, seed):
    rng = np.random.default_rng(seed)
    y = (rng.random(400) < 0.3).astype(int)
    a = np.floor(rng.normal(y * 1.0, 1) * levels) / levels
    b = np.floor((a + rng.normal(0, 1, 400)) * levels) / levels
    (auc_a, auc_b), delta, error = plainly(y, a, b)
    r = auc_difference(table(spark, y, a, b), "y", "a", F.col("b"), level=0.9).first()
    assert (r.n_pos, r.n_neg) == (y.sum(), 400 - y.sum())
    assert [r.auc_first, r.auc_second, r.delta, r.std_error] == pytest.approx([auc_a, auc_b, delta, error], abs=1e-12)
    reach = NormalDist().inv_cdf(0.95)
    assert [r.low, r.high] == pytest.approx([delta - reach * error, delta + reach * error], abs=1e-12)
    assert r.p_value == pytest.approx(2 * NormalDist().cdf(-abs(delta / error)), abs=1e-12)


def test_interval_holds_the_true_difference(spark):
    inside, truth = 0, NormalDist().cdf(1 / math.sqrt(2)) - NormalDist().cdf(0.5 / math.sqrt(2))
    for seed in range(12):
        rng = np.random.default_rng(seed)
        y = (np.arange(600) % 2).astype(int)
        r = auc_difference(table(spark, y, rng.normal(y, 1), rng.normal(0.5 * y, 1)), "y", "a", "b").first()
        inside += r.low <= truth <= r.high
    assert inside >= 10


def test_odd_rows(spark):
    schema = "y int, a double, b double"
    rows = [(1, 1.0, 1.0), (0, 0.0, 0.0), (None, 0.5, 0.5), (1, None, 9.0), (1, float("nan"), 9.0), (1, 2.0, 2.0)]
    r = auc_difference(spark.createDataFrame(rows, schema), "y", "a", "b").first()
    assert (r.n_pos, r.n_neg, r.auc_first, r.delta, r.std_error, r.p_value, r.low, r.z) == (2, 2, 1.0, 0.0, 0.0, 1.0, 0.0, None)
    one = auc_difference(spark.createDataFrame(rows[:2], schema), "y", "a", "b").first()
    assert (one.n_pos, one.auc_first, one.std_error, one.p_value, one.low) == (1, 1.0, None, None, None)
    for kept in ([], rows[:1]):
        none = auc_difference(spark.createDataFrame(kept, schema), "y", "a", "b").first()
        assert (none.n_pos, none.n_neg, none.auc_first, none.delta, none.p_value) == (len(kept), 0, None, None, None)


def test_normal_tail(spark):
    zs = [0.0, 1e-9, 0.1, -1.0, 1.96, 3.0, 5.0, 7.0, 7.2, 10.0]
    found = spark.createDataFrame([(z,) for z in zs], "z double").select("z", normal_two_sided(F.col("z")).alias("p")).collect()
    for r in found:
        exact = math.erfc(abs(r.z) / math.sqrt(2))
        assert r.p == pytest.approx(exact, rel=1e-3 if abs(r.z) > 7.05 else 1e-9, abs=1e-13 if abs(r.z) < 7.05 else 0)


def test_validation_uses_the_interval(spark):
    names = ["metric", "value"]
    new, old = (spark.createDataFrame([("ROC AUC", v)], names) for v in (0.81, 0.80))
    both = spark.createDataFrame([(float(i % 50), i < 500) for i in range(1000)], "x double, is_ref boolean")
    assert validate_model(new, old, both, ["x"]).first().accept
    for low, accept in ((-0.01, False), (0.005, True)):
        difference = spark.createDataFrame([(0.01, low, 0.03)], "delta double, low double, high double")
        rows = {(r.check, r.name): r for r in validate_model(new, old, both, ["x"], difference=difference).collect()}
        r = rows["difference", "ROC AUC"]
        assert (r.value, r.reference, r.passed) == (low, 0.0, accept) and all(x.accept == accept for x in rows.values())
