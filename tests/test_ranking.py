import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trisect.functions.keys import ordinal, prefix_digits, row_hash
from trisect.operators.quantiles import quantiles
from trisect.operators.ranking import (
    VALUE_ORDER,
    _buckets,
    add_buckets,
    at_positions,
    fit_buckets,
    order_by_value,
    running_totals,
)


def skewed(n=4000, seed=1):
    """A third of the rows share one value, some are missing, the rest is heavy tailed."""
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(n) < 0.34, 7.0, np.round(rng.lognormal(2, 2, n), 3))
    frame = pd.DataFrame({"k": range(n), "g": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]), "x": values})
    frame.loc[rng.random(n) < 0.05, "x"] = np.nan
    return frame


def test_buckets_keep_the_order_and_isolate_frequent_values(spark, tiny_buckets):
    df = spark.createDataFrame(skewed()).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    fitted = fit_buckets(df, ["x"])["x"]
    assert fitted.parts > 1 and fitted.single
    rows = add_buckets(df, {"x": fitted}, {"x": "b"}).toPandas()
    ordered = rows.dropna(subset="x").sort_values("x")
    assert ordered["b"].is_monotonic_increasing
    assert rows[rows["x"].isna()]["b"].unique().tolist() == [fitted.missing * fitted.parts]
    seven = rows[rows["x"] == 7.0]["b"].unique()
    assert len(seven) == 1 and set(rows[rows["b"] == seven[0]]["x"]) == {7.0}


def test_bucket_count_follows_the_row_count():
    evenly = [float(i) for i in range(1025)]
    assert len(_buckets(evenly, 1000).edges) < 100
    assert _buckets(evenly, 1000).parts == 1
    assert _buckets(evenly, 10**12).parts >= 512
    # A value with a third of 10**12 rows is cut into pieces of a task's size.
    heavy = [0.0] * 342 + [float(i) for i in range(1, 684)]
    (digits,) = _buckets(heavy, 10**12).single.values()
    assert 10**12 / 3 / 16**digits <= 1_000_000
    assert prefix_digits(10) == 1


@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_totals_equal_a_plain_window(spark, tiny_buckets, by):
    frame = skewed()
    df = spark.createDataFrame(frame).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    rows = order_by_value(df, "x", row_hash(["k"]), ["k", *by]).withColumn("one", F.lit(1))
    found = running_totals(rows, by, "_bucket", [F.col(c) for c in VALUE_ORDER], ["one"]).toPandas()
    found = found.sort_values([*by, "_at", "_tie"])
    expected = found.groupby(by).cumcount() if by else pd.Series(range(len(found)), index=found.index)
    assert (found["one_before"] == expected).all()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_positions_equal_sorting(spark, tiny_buckets, by):
    df = spark.createDataFrame(skewed()).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    rows = order_by_value(df, "x", row_hash(["k"]), ["k", *by])
    places = {"first": lambda n: F.lit(1), "mid": lambda n: F.floor(n / 3), "last": lambda n: n, "none": lambda n: n + 1}
    found = at_positions(rows, by, "_bucket", VALUE_ORDER, places).toPandas()
    everything = rows.toPandas().sort_values([*by, "_at", "_tie"])
    groups = everything.groupby(by) if by else [((), everything)]
    for key, part in groups:
        mine = found if not by else found[found["g"] == key[0]]
        mine = mine.set_index("label")
        assert set(mine.index) == {"first", "mid", "last"}
        for label, place in {"first": 1, "mid": len(part) // 3, "last": len(part)}.items():
            assert mine.loc[label, "_tie"] == part.iloc[place - 1]["_tie"]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_equal_numpy(spark, tiny_buckets, by):
    frame = skewed()
    probabilities = [0, 0.1, 0.333, 0.5, 0.99, 1]
    found = quantiles(spark.createDataFrame(frame), ["x", "k"], probabilities, by).toPandas()
    groups = frame.groupby(by) if by else [(("",), frame)]
    for key, part in groups:
        for column in ("x", "k"):
            mine = found[found["column"] == column]
            mine = (mine if not by else mine[mine["g"] == key[0]]).sort_values("i")
            np.testing.assert_allclose(mine["quantile"], np.quantile(part[column].dropna(), probabilities), rtol=1e-14)


def test_ranks_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(skewed())
    once = quantiles(df.repartition(1), ["x"], [0.2, 0.7]).orderBy("i").collect()
    assert once == quantiles(df.repartition(7), ["x"], [0.2, 0.7]).orderBy("i").collect()


def test_ordinal_of_every_kind(spark):
    df = spark.sql("""
        SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00.000001' AS local, TIMESTAMP '1970-01-01 00:00:01Z' AS instant,
               DATE '1970-01-11' AS day, TRUE AS flag, 2.5D AS x, double('NaN') AS nan, CAST(3 AS DECIMAL(5, 1)) AS d, 'a' AS t
    """)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(*[ordinal(df, c).alias(c) for c in df.columns if c != "t"]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["local"] == pd.Timestamp("2024-03-10 02:30:00.000001").value / 1e9
    assert (row["instant"], row["day"], row["flag"], row["x"], row["nan"], row["d"]) == (1e6, 10, 1, 2.5, None, 3)
    with pytest.raises(ValueError):
        ordinal(df, "t")


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, k long")
    assert quantiles(df, ["x"], [0.5]).collect() == []
    assert fit_buckets(df, ["x"])["x"].edges == (-math.inf, 0.0, math.inf)
