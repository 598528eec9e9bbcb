import math

import numpy as np
import pytest

from trisect.operators.drift import psi
from trisect.operators.joint_drift import fourier_features, joint_drift, permuted_distances


def table(spark, ref, cur):
    rows = [(*map(float, r), True) for r in ref] + [(*map(float, r), False) for r in cur]
    names = ", ".join(f"c{i} double" for i in range(ref.shape[1]))
    return spark.createDataFrame(rows, f"{names}, is_ref boolean").repartition(5)


def plainly(ref, cur, features, seed):
    mean, deviation = ref.mean(axis=0), ref.std(axis=0, ddof=1)
    w, b = fourier_features(ref.shape[1], features, seed)
    z = [math.sqrt(2 / features) * np.cos((x - mean) / deviation @ w.T + b) for x in (ref, cur)]
    return ((z[0].mean(axis=0) - z[1].mean(axis=0)) ** 2).sum()


def correlated(rng, n, r):
    a = rng.normal(size=n)
    return np.stack([a, r * a + math.sqrt(1 - r * r) * rng.normal(size=n)], axis=1)


@pytest.mark.parametrize("features,seed", [(1, 0), (16, 3), (64, 7)])
def test_equals_numpy(spark, features, seed):
    rng = np.random.default_rng(seed)
    ref, cur = rng.normal(3, 2, (300, 3)), rng.normal(3.5, 2, (200, 3))
    r = joint_drift(table(spark, ref, cur), ["c0", "c1", "c2"], features, seed).first()
    assert r.mmd2 == pytest.approx(plainly(ref, cur, features, seed), abs=1e-9) and (r.n_ref, r.n_cur) == (300, 200)


def test_finds_what_single_columns_hide(spark):
    rng = np.random.default_rng(1)
    df = table(spark, correlated(rng, 2000, 0.0), correlated(rng, 1200, 0.8))
    assert max(x.psi for x in psi(df, ["c0", "c1"]).collect()) < 0.05
    r = joint_drift(df, ["c0", "c1"]).first()
    assert r.p_value == 1 / 500
    assert joint_drift(df.repartition(2), ["c0", "c1"]).first().p_value == r.p_value


def test_no_alarm_without_drift(spark):
    p = []
    for seed in range(12):
        rng = np.random.default_rng(seed + 50)
        p.append(joint_drift(table(spark, correlated(rng, 900, 0.5), correlated(rng, 400, 0.5)), ["c0", "c1"], 32, permutations=199).first().p_value)
    assert sum(x < 0.1 for x in p) <= 4 and max(p) > 0.4


def test_blocks_are_as_good_as_rows():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(4000, 8))
    whole = permuted_distances(z, np.ones(4000), 2000, 300, 0)
    blocks = permuted_distances(z.reshape(200, 20, 8).sum(axis=1), np.full(200, 20.0), 100, 300, 0)
    assert np.median(blocks) == pytest.approx(np.median(whole), rel=0.15)
    assert np.quantile(blocks, 0.95) == pytest.approx(np.quantile(whole, 0.95), rel=0.2)


def test_odd_rows(spark):
    schema = "a double, b int, is_ref boolean"
    rows = [(1.0, 5, True), (2.0, 5, True), (None, 5, True), (float("nan"), 5, False), (float("inf"), 5, False), (1.0, None, False)]
    r = joint_drift(spark.createDataFrame(rows, schema), ["a", "b"]).first()
    assert tuple(r) == (None, None, 2, 0)
    r = joint_drift(spark.createDataFrame([*rows, (1.5, 5, False)], schema), ["a", "b"]).first()
    assert r.mmd2 > 0 and r.p_value is None and (r.n_ref, r.n_cur) == (2, 1)
    same = joint_drift(spark.createDataFrame(rows[:2] + [(1.0, 5, False), (2.0, 5, False)], schema), ["a", "b"]).first()
    assert same.mmd2 == pytest.approx(0, abs=1e-20)
    assert tuple(joint_drift(spark.createDataFrame([], schema), ["a"]).first()) == (None, None, 0, 0)
    with pytest.raises(ValueError):
        joint_drift(spark.createDataFrame([], schema), [])
