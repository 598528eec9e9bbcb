import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ranking import skewed

from trisect.functions.stats import ks_pvalue
from trisect.operators.drift import (
    both_sides,
    category_counts,
    divergences,
    histogram_by_edges,
    js_divergence,
    ks,
    marked,
    mean_var_diff,
    psi,
    reference_edges,
    split_report,
    stability_report,
)
from trisect.plans.monitoring import drift_alert, drift_by_period


def two(spark, reference, current):
    make = lambda values: spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    return both_sides(make(reference), make(current), ["x"])


GOLDEN = {
    "shifted": (range(1, 101), range(11, 111), 10, (1.6118094039148758, 0.036044322469359874, 0.1, -10.0, 0.0)),
    "binary": ([0] * 75 + [1] * 25, [0] * 60 + [1] * 40, 10,
               (0.10397207708399181, 0.012907622571982282, 0.15, -0.15, -0.05303030303030295)),
    "tiny": ([1, 2, 3, 4, 5], [0, 2, 2, 6], 2, (10.768227248144694, 0.2959593226938118, 0.35, 0.5, -3.833333333333333)),
    "constant": ([7] * 4, [7, 7, 8], 4, (0.1351550360360548, 0.0, 1 / 3, -1 / 3, -1 / 3)),
}


@pytest.mark.parametrize("case", GOLDEN)
def test_golden_reports(spark, case):
    reference, current, bins, expected = GOLDEN[case]
    row = stability_report(two(spark, [*reference, None, math.nan], [*current, None]), ["x"], bins).first()
    found = [row[c] for c in ("psi", "js_divergence", "ks_stat", "mean_diff", "var_diff")]
    np.testing.assert_allclose(found, expected, rtol=1e-12, atol=1e-14)


def test_golden_bins(spark):
    reference, current, bins, _ = GOLDEN["binary"]
    both = two(spark, reference, current)
    edges = reference_edges(both, ["x"], bins)
    assert edges["x"] == [0.0] * 8 + [1.0] * 3
    counts = {r["bin"]: (r["n_ref"], r["n_cur"]) for r in histogram_by_edges(both, edges).collect()}
    assert counts == {7: (75, 60), 9: (25, 40)}


def test_histogram_equals_numpy(spark):
    frame = skewed(3000).dropna()
    both = marked(spark.createDataFrame(frame), F.col("g") == "a", ["x"])
    edges = reference_edges(both, ["x"], 7)
    counts = {r["bin"]: (r["n_ref"], r["n_cur"]) for r in histogram_by_edges(both, edges).collect()}
    for side, part in enumerate([frame[frame["g"] == "a"], frame[frame["g"] != "a"]]):
        expected = np.histogram(part["x"], bins=edges["x"])[0]
        assert [counts.get(i, (0, 0))[side] for i in range(7)] == expected.tolist()


def ks_by_sorting(a, b):
    values = np.union1d(a, b)
    share = lambda x: np.searchsorted(np.sort(x), values, side="right") / len(x)
    return np.abs(share(a) - share(b)).max()


@pytest.mark.parametrize("shift", [0.0, 0.01, 3.0])
def test_ks_equals_sorting(spark, tiny_buckets, shift):
    frame = skewed(2500).dropna()
    frame["x"] += np.where(frame["g"] == "a", 0, shift)
    row = ks(marked(spark.createDataFrame(frame), F.col("g") == "a", ["x"]), ["x"]).first()
    a, b = frame[frame["g"] == "a"]["x"], frame[frame["g"] != "a"]["x"]
    assert row["ks_stat"] == pytest.approx(ks_by_sorting(a, b), abs=1e-15)
    assert (row["n_ref"], row["n_cur"]) == (len(a), len(b))


def test_ks_pvalue_series(spark):
    exact = lambda x: 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 2000))
    rows = spark.createDataFrame([(x / math.sqrt(50),) for x in (0.3, 0.8, 0.999, 1.001, 1.5, 3.0)], "d double")
    for r in rows.select("d", ks_pvalue(F.col("d"), F.lit(100), F.lit(100)).alias("p")).collect():
        assert r["p"] == pytest.approx(exact(r["d"] * math.sqrt(50)), rel=1e-9)
    tiny = rows.limit(1).select(ks_pvalue(F.lit(1e-6), F.lit(100), F.lit(100)).alias("p")).first()
    assert tiny["p"] == pytest.approx(1.0)


def test_properties(spark):
    frame = skewed(1200).dropna()
    df = spark.createDataFrame(frame)
    same = both_sides(df, df, ["x"])
    row = stability_report(same, ["x"]).first()
    assert row["psi"] == row["js_divergence"] == row["ks_stat"] == 0 and row["ks_pvalue"] == 1
    both = marked(df, F.col("g") == "a", ["x"], F.col("g") == "b")
    turned = both.withColumn("is_ref", ~F.col("is_ref"))
    assert ks(both, ["x"]).first()["ks_stat"] == pytest.approx(ks(turned, ["x"]).first()["ks_stat"], abs=1e-15)
    assert 0 <= js_divergence(both, ["x"]).first()["js_divergence"] <= math.log(2)


def test_open_ends_count_every_value(spark):
    both = two(spark, range(1, 101), range(11, 111))
    counts = histogram_by_edges(both, reference_edges(both, ["x"]), open_ends=True).toPandas()
    assert counts["bin"].notna().all() and counts["n_cur"].sum() == 100
    assert psi(both, ["x"], open_ends=True).first()["psi"] != psi(both, ["x"]).first()["psi"]


def test_categories(spark):
    both = spark.createDataFrame([("a", True)] * 3 + [("b", True)] + [("a", False)] * 2 + [(None, False)], "c string, is_ref boolean")
    row = divergences(category_counts(both, ["c"])).first()
    assert row["psi"] == pytest.approx((0.75 - 1) * math.log(0.75) + (0.25 - 1e-8) * math.log(0.25 / 1e-8))


def test_columns_must_be_named(spark):
    with pytest.raises(ValueError):
        stability_report(two(spark, [1], [1]), [None])
    with pytest.raises(ValueError):
        psi(spark.createDataFrame([("a", True)], "c string, is_ref boolean"), ["c"])


def test_columns_are_reported_once(spark):
    both = two(spark, [1, 2, 3], [2, 3, 4])
    assert stability_report(both, ["x", "x"]).count() == 1
    assert mean_var_diff(both, ["x"]).first()["mean_diff"] == -1


def test_split_report_and_alert(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("x"))
    assigned = df.withColumn("subset", F.when(F.col("id") < 500, "train").when(F.col("id") < 800, "test"))
    assert split_report(assigned, ["x"]).first()["ks_stat"] == 1.0
    both = marked(df, F.col("id") % 2 == 0, ["x"])
    assert drift_alert(both, ["x"]).first()["alert"] is False
    assert drift_alert(marked(df, F.col("id") < 500, ["x"]), ["x"]).first()["alert"] is True


def test_periods_without_some_bins(spark):
    rows = [(f"2024-01-{d:02d}", float(d)) for d in range(1, 31)] + [("2024-02-01", 5.0)] * 3
    df = spark.createDataFrame(rows, "t string, x double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    found = drift_by_period(df, "t", "month", F.col("t") < "2024-02-01", ["x"]).orderBy("period").collect()
    assert found[0]["psi"] == 0
    direct = psi(marked(df, F.col("t") < "2024-02-01", ["x"]), ["x"]).first()["psi"]
    assert found[1]["psi"] == pytest.approx(direct)


def test_periods_without_values_are_shown(spark):
    rows = [(f"2024-01-{d:02d}", float(d)) for d in range(1, 31)] + [("2024-02-01", None), ("2024-03-01", 5.0)]
    df = spark.createDataFrame(rows, "t string, x double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    found = drift_by_period(df, "t", "month", F.col("t") < "2024-02-01", ["x"]).orderBy("period").collect()
    assert [r["psi"] is None for r in found] == [False, True, False] and found[1]["column"] == "x"


def test_sides_and_columns_without_values(spark):
    rows = [(1.0, None, True), (2.0, None, True), (None, None, False)]
    both = spark.createDataFrame(rows, "x double, gone double, is_ref boolean")
    found = {r["column"]: r for r in stability_report(both, ["x", "gone"]).collect()}
    assert set(found) == {"x", "gone"}
    for row in found.values():
        assert all(row[c] is None for c in ("psi", "js_divergence", "ks_stat", "ks_pvalue", "mean_diff"))
