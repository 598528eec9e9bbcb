import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_ranking import skewed

from trisect.functions.keys import row_hash
from trisect.operators.split import (
    SplitSpec,
    add_blocks,
    fit_split,
    parts,
    random_split_by_hash,
    split,
    split_in_blocks,
    stratum_quotas,
)


def sizes(assigned, *by):
    return {tuple(r[c] for c in (*by, "subset")): r["count"] for r in assigned.groupBy(*by, "subset").count().collect()}


@pytest.mark.parametrize("bad", [
    dict(method="x"),
    dict(method="random", target="y", key=("k",), train=0.5, test=0.2, backtest=0.2),
    dict(method="metric", metric="x", train=0.5, test=0.2, backtest=0.2),
    dict(method="random", key=("k",)),
    dict(method="time", key=("k",)),
    dict(method="metric"),
    dict(method="random", target="y", key=("k",), train="a", test="b", backtest="c"),
    dict(method="time", time="t", key=("k",), train=0.9, test=0.2),
    dict(method="random", target="y"),
])
def test_bad_specs_are_refused(bad):
    with pytest.raises(ValueError):
        SplitSpec(**bad)


def test_only_dataframes_are_split():
    with pytest.raises(ValueError):
        split(pd.DataFrame({"y": [1]}), SplitSpec("metric", metric="y"))


def test_metric_split_leaves_nulls_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 10)] + [(None,)], "x double")
    assigned = split(df, SplitSpec("metric", metric="x"))
    assert sizes(assigned) == {("train",): 5, ("test",): 2, ("backtest",): 2, (None,): 1}
    assert [p.count() for p in (parts(assigned).train, parts(assigned).test, parts(assigned).backtest)] == [5, 2, 2]


@pytest.mark.parametrize("n, expected", [(10, (7, 2, 1)), (15_000, (10_500, 2_999, 1_501))])
def test_time_shares_cut_at_truncated_positions(spark, n, expected):
    df = spark.range(n).withColumn("t", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id)"))
    found = sizes(split(df, SplitSpec("time", time="t", key=("id",), train=0.7, test=0.2)))
    assert tuple(found[(s,)] for s in ("train", "test", "backtest")) == expected


@pytest.mark.parametrize("spread", [False, True])
def test_time_split_equals_sorting(spark, spread, request):
    if spread:
        request.getfixturevalue("tiny_buckets")
    frame = skewed(1500)
    df = spark.createDataFrame(frame)
    found = split(df, SplitSpec("time", time="x", key=("k",), train=0.3, test=0.4, by=("g",))).toPandas()
    for _, part in found.groupby("g"):
        n = len(part)
        counts = part["subset"].value_counts()
        assert counts["train"] == int(0.3 * n) and counts["test"] == int((0.3 + 0.4) * n) - int(0.3 * n)
        order = {"train": 0, "test": 1, "backtest": 2}
        by_time = part.assign(x=part["x"].fillna(np.inf), s=part["subset"].map(order)).groupby("x")["s"].agg(["min", "max"])
        assert (by_time["min"].iloc[1:].to_numpy() >= by_time["max"].iloc[:-1].to_numpy()).all()
        assert (part[part["x"].isna()]["subset"] == "backtest").all()


def test_null_times(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i)) for i in range(8)] + [(8, None), (9, None)]
    df = spark.createDataFrame(rows, "k int, t timestamp")
    shares = split(df, SplitSpec("time", time="t", key=("k",), train=0.5, test=0.3))
    assert {r["subset"] for r in shares.where("t IS NULL").collect()} == {"backtest"}
    cuts = split(df, SplitSpec("time", time="t", train="2024-01-02", test=dt.datetime(2024, 1, 4)))
    assert sizes(cuts) == {("train",): 2, ("test",): 2, ("backtest",): 4, (None,): 2}


def test_zero_shares(spark):
    df = spark.range(20).withColumn("t", F.col("id")).withColumn("y", F.lit(1))
    assert sizes(split(df, SplitSpec("time", time="t", key=("id",), train=0.0, test=0.5))) == {("test",): 10, ("backtest",): 10}
    spec = SplitSpec("random", target="y", key=("id",), train=0.8, test=0.2, backtest=0.0)
    assert sizes(split(df, spec)) == {("train",): 16, ("test",): 4}


def test_stratified_sizes_and_repeatability(spark):
    frame = skewed(3001)
    df = spark.createDataFrame(frame).withColumn("s", F.when(F.col("g") != "c", F.col("g")))
    spec = SplitSpec("random", target="s", stratify=("x",), key=("k",))
    one = split(df.repartition(1), spec).select("k", "subset").orderBy("k").toPandas()
    many = split(df.repartition(9), spec).select("k", "subset").orderBy("k").toPandas()
    assert one.equals(many)
    assert one["subset"].value_counts().to_dict() == {"backtest": 601, "test": 600, "train": 1800}
    joined = frame.merge(one, on="k").groupby(["g", frame["x"].fillna(-1).rename("v")])["subset"].value_counts().unstack(fill_value=0)
    n = joined.sum(axis=1)
    assert ((joined["backtest"] - n * 601 / 3001).abs() < 1).all()


def test_quotas_of_many_strata_equal_those_of_few(spark):
    df = spark.createDataFrame(skewed(2000))
    for by in ((), ("g",)):
        spec = SplitSpec("random", target="x", key=("k",), train=0.5, test=0.3, backtest=0.2, by=by)
        few = stratum_quotas(df, spec).toPandas()
        many = stratum_quotas(df, spec, small=0).toPandas()
        order = [*spec.strata]
        few, many = (t.sort_values(order).reset_index(drop=True) for t in (few, many))
        assert few.equals(many[few.columns])
        totals = few.groupby("g")[["n", "n_backtest"]].sum() if by else few[["n", "n_backtest"]].sum().to_frame().T
        assert (totals["n_backtest"] == np.ceil(0.2 * totals["n"])).all()


def test_strata_are_not_joined_as_text(spark):
    rows = [(i, "a_b", "c") for i in range(10)] + [(i, "a", "b_c") for i in range(10, 20)]
    df = spark.createDataFrame(rows, "k int, p string, q string")
    found = sizes(split(df, SplitSpec("random", target="p", stratify=("q",), key=("k",))), "p")
    assert found == {(p, s): n for p in ("a", "a_b") for s, n in {"train": 6, "test": 2, "backtest": 2}.items()}


def test_many_groups_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("trisect.session.BROADCAST_ROWS", 2)
    df = spark.createDataFrame(skewed(600)).withColumn("g", F.when(F.col("g") != "c", F.col("g")))
    found = split(df, SplitSpec("metric", metric="k", by=("g",)))
    for (group, subset), n in sizes(found, "g").items():
        total = df.where(F.col("g").eqNullSafe(group)).count()
        assert abs(n / total - {"train": 0.6, "test": 0.2, "backtest": 0.2}[subset]) < 0.02


def test_hash_split_is_near_its_shares(spark):
    found = sizes(random_split_by_hash(spark.range(20_000), ["id"]))
    assert abs(found[("train",)] - 12_000) < 400 and abs(found[("test",)] - 4_000) < 300


def test_blocks(spark, tiny_buckets):
    df = spark.createDataFrame(skewed(1000))
    found = add_blocks(df, "k", ["k"], 100).toPandas()
    assert (found["block"] == found["k"] // 100).all()
    shared = add_blocks(df, "x", ["k"], 300)
    assert sorted(shared.groupBy("block").count().toPandas()["count"]) == [100, 300, 300, 300]
    spec = SplitSpec("metric", metric="x")
    whole = split_in_blocks(df, SplitSpec("random", target="g", key=("k",)), "k", 250)
    assert sorted(whole.groupBy("block").count().toPandas()["count"]) == [250] * 4
    assert spec.strata == ()


@pytest.mark.parametrize("spec", [
    SplitSpec("time", time="t", key=("k",), train=0.3, test=0.4),
    SplitSpec("time", time="t", train="2024-01-10", test="2024-02-01"),
    SplitSpec("time", time="k", key=("k",)),
    SplitSpec("metric", metric="x"),
    SplitSpec("metric", metric="k", train=0.55, test=0.25, backtest=0.2),
    SplitSpec("random", target="g", key=("k",)),
    SplitSpec("metric", metric="x", by=("g",)),
])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_parts_hold_the_assigned_rows(spark, spec, kind):
    if kind != "timestamp" and spec.time != "t":
        pytest.skip("no time column")
    frame = skewed(900).assign(day=lambda f: f["k"] // 12)
    moment = F.expr("date_add(DATE'2024-01-01', CAST(day AS INT))").cast(kind)
    df = spark.createDataFrame(frame).withColumn("t", F.when(F.col("k") % 50 > 0, moment))
    fitted = fit_split(df, spec)
    assigned = fitted.assign(df)
    for name in ("train", "test", "backtest"):
        mine = sorted(r["k"] for r in getattr(fitted.parts(df), name).select("k").collect())
        assert mine == sorted(r["k"] for r in assigned.where(F.col("subset") == name).select("k").collect()) and mine


def test_ranges_of_parts_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    found = fit_split(events, SplitSpec("time", time="ts", key=("event_id",))).parts(events)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in plan(found.train)
    assert "GreaterThanOrEqual(ts" in plan(found.test) and "LessThanOrEqual(ts" in plan(found.test)


def test_a_fitted_split_assigns_new_rows(spark):
    df = spark.range(100).withColumn("x", F.col("id").cast("double"))
    fitted = fit_split(df, SplitSpec("metric", metric="x"))
    new = spark.createDataFrame([(-5.0,), (65.0,), (1e9,)], "x double")
    assert [r["subset"] for r in fitted.assign(new).collect()] == ["train", "test", "backtest"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_the_session_time_zone_does_not_move_the_cuts(spark, zone, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        hours = F.expr("timestamp'2024-03-08' + make_interval(0, 0, 0, 0, CAST(id AS INT))").cast(kind)
        df = spark.range(100).select("id", hours.alias("t"))
        fitted = fit_split(df, SplitSpec("time", time="t", key=("id",), train=0.5, test=0.3))
        assert sizes(fitted.assign(df)) == {("train",): 50, ("test",): 30, ("backtest",): 20}
        assert fitted.parts(df).test.count() == 30
        if kind == "timestamp_ntz":
            cuts = SplitSpec("time", time="t", train=dt.datetime(2024, 3, 8, 9), test="2024-03-08 19:00:00")
            assert sizes(split(df, cuts)) == {("train",): 10, ("test",): 10, ("backtest",): 80}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_keys_are_told_apart_by_their_parts(spark):
    rows = [("a_b", "c"), ("a", "b_c"), ("x", None), (None, "x")]
    hashes = spark.createDataFrame(rows, "p string, q string").select(row_hash(["p", "q"])).distinct()
    assert hashes.count() == 4


def test_exact_sizes_with_null_key_parts(spark):
    df = spark.range(1000).select(
        F.lit(1).alias("y"),
        F.when(F.col("id") < 500, F.col("id").cast("string")).alias("p"),
        F.when(F.col("id") >= 500, (F.col("id") - 500).cast("string")).alias("q"),
    )
    spec = SplitSpec("random", target="y", key=("p", "q"), train=0.001, test=0.499, backtest=0.5)
    found = {r["subset"]: r["count"] for r in split(df, spec).groupBy("subset").count().collect()}
    assert found == {"train": 1, "test": 499, "backtest": 500}


@pytest.mark.parametrize("train,test", [
    ("2020-01-01", 0.2), (0.6, "2020-01-01"), ("2021-01-01", "2020-01-01"), ("not a time", "2021-01-01"), ("2020-01-01", True),
    ("2020-01-01T00:00:00+00:00", "2021-01-01"),
])
def test_bad_cut_points(train, test):
    with pytest.raises(ValueError):
        SplitSpec("time", time="t", train=train, test=test, key=("k",))


def test_blocks_need_a_key(spark):
    with pytest.raises(ValueError):
        split_in_blocks(spark.range(5), SplitSpec("metric", metric="id"), "id", 2)
