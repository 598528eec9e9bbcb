import numpy as np
import pytest
from pyspark.sql import functions as F

from trisect.operators import profiles
from trisect.operators.drift import both_sides, category_counts, divergences, psi
from trisect.sources.tables import read_artifact, write_artifact

N = 200_000


@pytest.fixture(scope="module")
def tables(spark):
    reference = spark.range(N).select(F.expr("id % 7").alias("day"), u(1), c(1, 5))
    current = spark.range(N).select(F.expr("id % 7").alias("day"), (u(2) * u(2)).alias("u"), c(2, 6))
    return reference.repartition(6).cache(), current.repartition(5).cache()


def u(seed):
    return (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_003)).cast("double") / 1_000_003).alias("u")


def c(seed, n):
    return F.concat(F.lit("c"), F.pmod(F.hash("id", F.lit(seed)), F.lit(n)).cast("string")).alias("c")


def test_ranks_are_within_the_bound(tables):
    reference, _ = tables
    whole = profiles.profile(reference, ["u"])
    merged = profiles.merge(profiles.profile(reference, ["u"], by=["day"]))
    values = np.sort([r.u for r in reference.select("u").collect()])
    asked = [i / 200 for i in range(201)]
    for table in (whole, merged):
        for r in profiles.profile_quantiles(table, asked).collect():
            low, high = np.searchsorted(values, r.quantile, "left") / N, np.searchsorted(values, r.quantile, "right") / N
            assert low - 0.002 <= asked[r.i] <= high + 0.002 and r.n == N


def test_merged_counts_and_moments_are_exact(tables):
    reference, _ = tables
    days = profiles.profile(reference, ["u"], ["c"], by=["day"])
    assert days.where("kind = 'number'").count() == 7
    exact = reference.agg(F.avg("u").alias("m"), F.var_samp("u").alias("v"), F.min("u").alias("low"), F.max("u").alias("high")).first()
    r = profiles.moments(profiles.merge(days)).first()
    assert (r.n, r.n_null, r.low, r.high) == (N, 0, exact.low, exact.high)
    assert [r["mean"], r.variance] == pytest.approx([exact.m, exact.v])
    merged = {x.value: x.n for x in profiles.merge(days).where("kind = 'category'").collect()}
    assert merged == {x.c: x["count"] for x in reference.groupBy("c").count().collect()}


def test_drift_from_stored_profiles_is_near_the_exact_one(spark, tables, tmp_path):
    reference, current = tables
    write_artifact(profiles.profile(reference, ["u"], ["c"]), str(tmp_path), "reference", "1")
    stored = read_artifact(spark, str(tmp_path), "reference", "1")
    found = {r.column: r for r in profiles.profile_drift(stored, profiles.profile(current, ["u"], ["c"])).collect()}
    exact = psi(both_sides(reference, current, ["u"]), ["u"]).first().psi
    assert exact > 0.2 and found["u"].psi == pytest.approx(exact, abs=0.01)
    both = both_sides(reference, current, ["c"])
    categories = divergences(category_counts(both, ["c"])).first()
    assert [found["c"].psi, found["c"].js_divergence] == pytest.approx([categories.psi, categories.js_divergence])


def test_drift_by_group_equals_drift_of_each(tables):
    reference, current = tables
    whole = profiles.profile(reference, ["u"], ["c"])
    days = profiles.profile(current, ["u"], ["c"], by=["day"])
    found = {(r.day, r.column): r.psi for r in profiles.profile_drift(whole, days, ["day"]).collect()}
    assert len(found) == 14
    for day in (0, 6):
        one = profiles.profile_drift(whole, days.where(F.col("day") == day).drop("day"))
        for r in one.collect():
            assert found[day, r.column] == pytest.approx(r.psi, abs=0.01 if r.column == "u" else 1e-9)


def test_small_tables_are_exact(spark):
    rows = [(1.0, "a"), (2.0, "a"), (2.0, None), (None, "b"), (float("nan"), "b"), (10.0, "b")]
    df = spark.createDataFrame(rows, "x double, c string").repartition(3)
    p = profiles.profile(df, ["x"], ["c"])
    assert [r.quantile for r in profiles.profile_quantiles(p, [0, 0.25, 0.5, 0.75, 1]).orderBy("i").collect()] == [1, 1, 2, 2, 10]
    r = profiles.moments(p).first()
    assert (r.n, r.n_null, r["mean"]) == (4, 2, 3.75)
    assert {(x.value, x.n) for x in p.where("kind = 'category'").collect()} == {("a", 2), ("b", 3), (None, 1)}
    same = {x.column: (x.psi, x.js_divergence) for x in profiles.profile_drift(p, p).collect()}
    assert same == {"x": (0, 0), "c": (0, 0)}
    nothing = profiles.profile(df.where("false"), ["x"], ["c"])
    assert nothing.count() == 0 and profiles.profile_drift(p, nothing).count() == 0 and profiles.profile_edges(nothing) == {}
    missing = profiles.profile(df.where("x IS NULL"), ["x"])
    assert profiles.moments(missing).first()["mean"] is None and profiles.profile_drift(p, missing).count() == 0
    with pytest.raises(ValueError):
        profiles.profile(df, [])
