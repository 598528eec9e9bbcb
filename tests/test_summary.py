import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_ranking import skewed

from trisect.operators.summary import (
    box_summary,
    describe_columns,
    ecdf,
    histogram_equal_width,
    outlier_counts,
    target_by_bin,
    visual_report,
)


def test_equal_width_histogram_equals_numpy(spark):
    frame = skewed(2000)
    frame["x"] = np.log(frame["x"])
    found = histogram_equal_width(spark.createDataFrame(frame), ["x", "k"], ["g"]).toPandas()
    for group, part in frame.groupby("g"):
        for column in ("x", "k"):
            counts, edges = np.histogram(part[column].dropna(), bins=20)
            mine = found[(found["g"] == group) & (found["column"] == column)].sort_values("bin")
            assert mine["n"].tolist() == counts.tolist()
            np.testing.assert_allclose(mine["low"], edges[:-1], rtol=1e-12)
            np.testing.assert_allclose(mine["high"], edges[1:], rtol=1e-12)


def test_constant_column_is_widened(spark):
    found = histogram_equal_width(spark.createDataFrame([(3.0,)] * 4, "x double"), ["x"]).toPandas()
    assert (found["low"].min(), found["high"].max(), found["n"].sum()) == (2.5, 3.5, 4)
    assert found[found["n"] > 0]["bin"].tolist() == [10]


def test_box_and_outliers(spark, tiny_buckets):
    frame = skewed(1500)
    df = spark.createDataFrame(frame)
    found = box_summary(df, ["x"], ["g"]).toPandas().set_index("g")
    for group, part in frame.groupby("g"):
        x = part["x"].dropna()
        q1, median, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        row = found.loc[group]
        assert (row["q1"], row["median"], row["q3"]) == pytest.approx((q1, median, q3))
        assert row["whisker_low"] == min(x[x >= low].min(), q1) and row["whisker_high"] == max(x[x <= high].max(), q3)
        assert row["outliers"] == ((x < low) | (x > high)).sum()
    assert outlier_counts(df, ["x"]).first()["n"] == frame["x"].notna().sum()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ecdf_equals_sorting(spark, tiny_buckets, by):
    frame = skewed(1200)
    found = ecdf(spark.createDataFrame(frame), ["x"], by).toPandas()
    for key, part in frame.groupby(by) if by else [((), frame)]:
        mine = (found[found["g"] == key[0]] if by else found).sort_values("value")
        points = [lo + i / mine["n"].sum() for lo, n in zip(mine["cdf_low"], mine["n"]) for i in range(n)]
        x = np.sort(part["x"].dropna())
        assert np.repeat(mine["value"], mine["n"]).tolist() == x.tolist()
        np.testing.assert_allclose(points, np.arange(len(x)) / len(x), atol=1e-12)


def test_profile(spark):
    frame = skewed(800)
    row = describe_columns(spark.createDataFrame(frame), ["x"]).first()
    x = frame["x"].dropna()
    assert (row["n_rows"], row["nulls"], row["distinct"]) == (800, frame["x"].isna().sum(), x.nunique())
    centred = x - x.mean()
    assert row["skewness"] == pytest.approx((centred**3).mean() / (centred**2).mean() ** 1.5)
    assert row["kurtosis"] == pytest.approx((centred**4).mean() / (centred**2).mean() ** 2 - 3)
    assert (row["mean"], row["sd"], row["median"]) == pytest.approx((x.mean(), x.std(), x.median()))


def test_target_by_bin(spark):
    df = spark.range(100).withColumn("y", (F.col("id") >= 50).cast("int"))
    found = target_by_bin(df, ["id"], "y", 4).orderBy("bin").toPandas()
    assert found["n"].tolist() == [25] * 4 and found["target_mean"].tolist() == [0, 0, 1, 1]


def test_visual_report_has_every_subset(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": np.arange(30.0)}))
    assigned = df.withColumn("subset", F.when(F.col("x") < 15, "train").when(F.col("x") < 25, "test"))
    tables = visual_report(assigned, ["x"])
    assert set(tables) == {"histogram", "box", "ecdf"}
    for table in tables.values():
        assert {r["subset"] for r in table.select("subset").distinct().collect()} == {"train", "test"}
