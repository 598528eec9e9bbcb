import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trisect.operators.checks import (
    apply_rules,
    check_not_empty,
    check_predictions,
    check_target_exists,
    duplicate_keys,
    guard_report,
    has_type,
    in_range,
    not_null,
    one_of,
    target_nulls,
)
from trisect.operators.features import (
    correlations,
    date_parts,
    display_names,
    impute_and_scale,
    index_and_onehot,
    keep_important,
    project,
    feature_selection,
    select_features,
)
from trisect.plans.distinct_users import monthly_distinct
from trisect.session import lookup, scratch_path
from trisect.sources.tables import (
    from_arrays,
    ingest,
    ingest_version,
    read_artifact,
    read_csv,
    read_metadata,
    read_table,
    write_artifact,
)


def test_distinct_keys_with_nulls(spark):
    rows = [("2024-01-05", 1, "a"), ("2024-01-06", 1, None), ("2024-01-07", None, None), ("2024-01-08", 1, "a"), (None, 1, "b")]
    df = spark.createDataFrame(rows, "t string, a int, b string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    found = monthly_distinct(df, "t", ["a", "b"]).collect()
    assert [(str(r["month"]), r["distinct_entities"]) for r in found] == [("None", 1), ("2024-01-01 00:00:00", 3)]
    recent = monthly_distinct(df, "t", ["a", "b"], start="2024-01-06")
    assert recent.first()["distinct_entities"] == 3


def test_range_filter_reaches_the_scan(spark):
    orders = read_table(spark, "/root/testdata/sf0.001/orders.parquet")
    plan = monthly_distinct(orders, "o_orderdate", ["o_custkey"], "1997-01-01", "1998-01-01")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text and "ReadSchema: struct<o_custkey:bigint,o_orderdate" in text


@pytest.mark.parametrize("value, single, many", [
    ('{"target": null}', None, []), ("{}", None, []), ('{"target": "y"}', "y", []),
    ('{"target": ["y", "z"], "all": ["a", "b"]}', "y", ["a", "b"]), ('{"target": [], "all": "a"}', None, ["a"]),
])
def test_metadata(spark, value, single, many):
    row = read_metadata(spark.createDataFrame([(value,)], "d string"), "d").first()
    assert (row["target"], row["features"]) == (single, many)


def test_metadata_of_another_kind_fails(spark):
    with pytest.raises(Exception, match="must be a list"):
        read_metadata(spark.createDataFrame([('{"target": 5}',)], "d string"), "d").collect()


def test_artifacts_are_never_overwritten(spark):
    root = scratch_path(spark, "t")
    write_artifact(spark.range(3), root, "n", "1")
    assert read_artifact(spark, root, "n", "1").count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        write_artifact(spark.range(3), root, "n", "1")


def test_arrays(spark):
    df = from_arrays(spark, np.array([[1.0, 2.0], [3.0, 4.0]]), [0, 1])
    assert df.columns == ["f0", "f1", "label"] and df.count() == 2
    assert from_arrays(spark, pd.DataFrame({"a": [1]}), pd.Series(["x"]), "y").first().asDict() == {"a": 1, "y": "x"}
    for x, y in ((np.empty((0, 2)), []), (np.ones((1, 1)), []), (np.ones((2, 1)), [1])):
        with pytest.raises(ValueError):
            from_arrays(spark, x, y)


def test_dated_csv(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("1", "05/01/2024")], "a string, d string").write.option("header", True).csv(path)
    row = read_csv(spark, path, "a int, d timestamp_ntz", "dd/MM/yyyy").first()
    assert row["a"] == 1 and str(row["d"]) == "2024-01-05 00:00:00"


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_ingest_sets_bad_rows_apart(spark, kind):
    path = scratch_path(spark, "raw")
    if kind == "json":
        lines = ['{"k": 1, "x": 2.5, "d": "2024-01-01"}', '{"k": "one", "x": 1}', "{oops", '{"k": 3}', '{"k": 4, "d": "soon"}']
    else:
        lines = ["k,x,d", "1,2.5,2024-01-01", "one,1,", "3,,", "4,,soon"]
    spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("d", T.DateType())])
    found = ingest(spark, path, schema, kind)
    root = scratch_path(spark, "ingested")
    kept = ingest_version(spark, path, schema, root, "rows", "1", kind)
    assert sorted(map(str, kept.valid.collect())) == sorted(map(str, found.valid.collect()))
    assert kept.rejected.count() == found.rejected.count()
    assert read_artifact(spark, root, "rows_rejected", "1").columns == found.rejected.columns
    assert sorted(r["k"] for r in found.valid.collect()) == [1, 3]
    assert found.valid.schema["d"].dataType == T.DateType()
    faults = sorted(r["faults"] for r in found.rejected.collect())
    assert faults == ([["_bad_row"]] if kind == "json" else []) + [["d"], ["k"]]
    assert found.valid.count() == 2 and found.rejected.count() == len(faults)


def test_guards(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "y double")
    with pytest.raises(ValueError):
        check_target_exists({"train": df}, "z")
    with pytest.raises(ValueError):
        check_not_empty(df.where("false"), "train")
    row = target_nulls({"train": df}, "y").first()
    assert (row["n_rows"], row["n_missing"], row["passed"]) == (3, 2, False)


def test_rules(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (9, None)], "n int, c string")
    found = apply_rules(df, [not_null(df, "n"), in_range("n", 0, 5), one_of("c", ["a"]), has_type(df, "n", "int"), has_type(df, "c", "int")])
    assert [r["violations"] for r in found.collect()] == [1, 2, 2, 0, 3]
    row = duplicate_keys(spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (2,)], "k int"), ["k"]).first()
    assert row.asDict() == {"n_rows": 6, "n_keys": 3, "duplicated_keys": 2, "surplus_rows": 3, "passed": False}


def test_prediction_checks(spark):
    scored = spark.createDataFrame([(0.1, "a"), (1.5, "b"), (None, None)], "s double, p string")
    reference = spark.createDataFrame([(i / 10, "a") for i in range(10)], "s double, p string")
    found = {(r["rule"], r["column"]): r["violations"] for r in check_predictions(scored, "s", "p", ["a"], reference).collect()}
    assert found == {("not_null", "s"): 1, ("in_range", "s"): 2, ("not_null", "p"): 1, ("one_of", "p"): 2, ("drift", "s"): 1}


def test_feature_steps(spark):
    df = spark.createDataFrame([(1.0, "x", None), (3.0, "y", 4.0), (None, "y", 8.0)], "a double, t string, b double")
    scaled = impute_and_scale(["a", "b"]).fit(df).transform(df).collect()
    assert [round(r["scaled"][0], 6) for r in scaled] == [-1.0, 1.0, 0.0]
    coded = index_and_onehot(["t"]).fit(df).transform(df).collect()
    assert [r["t_index"] for r in coded] == [1.0, 0.0, 0.0]
    assert display_names(df, "t", {"x": "Ex"}, "n").select("n").collect()[:2] == [("Ex",), ("y",)]
    with pytest.raises(ValueError):
        project(df, ["a", "q"], "t")
    assert project(df, ["a", "a"], "t").columns == ["a", "t"]
    dated = date_parts(spark.sql("SELECT DATE '2024-03-01' AS d"), "d").first()
    assert (dated["d_year"], dated["d_month"], dated["d_weekday"], dated["d_yearday"]) == (2024, 3, 6, 61)


def test_feature_selection(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 400)
    a = y + rng.normal(0, 0.3, 400)
    frame = pd.DataFrame({"a": a, "twin": 2 * a, "noise": rng.normal(size=400), "flat": 1.0, "y": y})
    df = spark.createDataFrame(frame)
    assert select_features(df, ["a", "twin", "noise", "flat"], "y") == ["a", "noise"]
    assert select_features(df, ["noise", "a"], "y", top=1) == ["a"]
    full = feature_selection(df, ["a", "twin", "noise", "flat"], "y").collect()
    assert [r["most_correlated"] for r in full] == [None, "a", None, None]
    # Nulls in every column: no row has all values.
    holes = df.withColumn("i", F.monotonically_increasing_id()).select(
        "y", *[F.when(F.col("i") % 4 != k, F.col(c)).alias(c) for k, c in enumerate(["a", "twin", "noise", "flat"])]
    )
    assert holes.dropna().count() == 0 and select_features(holes, ["a", "twin", "noise", "flat"], "y", top=1) == ["a"]
    assert correlations(df, ["a", "twin"]).first()["correlation"] == pytest.approx(1.0)
    assert keep_important([0.1, 0.5, 0.0, 0.4], 2).getIndices() == [1, 3]


def test_lookup_beyond_the_limit_is_not_broadcast(spark):
    small, large = lookup(spark.range(5), 5), lookup(spark.range(6), 5)
    assert (small.count(), large.count()) == (5, 6)
    hinted = lambda t: "ResolvedHint" in t._jdf.queryExecution().analyzed().toString()
    assert hinted(small) and not hinted(large)


def test_guard_report(spark):
    full = spark.createDataFrame([(1, 2.0), (2, None), (3, float("nan"))], "k long, y double")
    found = {r["table"]: tuple(r)[1:] for r in guard_report(
        {"bad": full, "good": full.where("k = 1"), "empty": full.where("false"), "other": full.drop("y")}, "y"
    ).collect()}
    assert found == {"bad": (True, 3, 2, False), "good": (True, 1, 0, True), "empty": (True, 0, 0, False), "other": (False, 3, None, False)}
