import pytest
from pyspark.sql import functions as F

from trisect.sources import versions as v


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def table(spark, rows):
    return spark.createDataFrame(rows, "k long, part string, x double").repartition(3)


ROWS = [(i, "ab"[i % 2], i / 7) for i in range(200)]


def changes(old, new):
    return {(r.k, r.part, r.change, r.n_old, r.n_new) for r in v.compare(old, new).collect()}


def test_changes_are_found_where_buckets_differ(spark, root):
    old = v.publish(table(spark, ROWS), root, "t", "1", ["k", "part"], buckets=64)
    edited = [r for r in ROWS if r[0] != 5] + [(500, "a", 1.0)]
    edited = [(k, p, -1.0) if k == 9 else (k, p, None) if k == 10 else (k, p, x) for k, p, x in edited]
    new = v.publish(table(spark, edited[::-1]), root, "t", "2", ["k", "part"], parent="1")
    assert new.buckets == 64 and new.parent == "1" and (old.n_rows, new.n_rows) == (200, 200)
    buckets, of = v.changed_buckets(old, new)
    assert of == 64 and 1 <= len(buckets) <= 4
    assert changes(old, new) == {(5, "b", "removed", 1, 0), (500, "a", "added", 0, 1), (9, "b", "changed", 1, 1), (10, "a", "changed", 1, 1)}
    assert sorted(map(tuple, new.rows().collect()), key=str) == sorted(edited, key=str)
    plan = old.rows(buckets, of)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan
    files = {r[0] for r in old.rows(buckets, of).select(F.input_file_name()).distinct().collect()}
    assert 0 < len(files) <= len(buckets)
    found = {r.change: (r["keys"], r.rows_old, r.rows_new) for r in v.summary(old, new).collect()}
    assert found == {"added": (1, 0, 1), "changed": (2, 2, 2), "removed": (1, 1, 0)}


def test_equal_versions_are_not_read(spark, root):
    old = v.publish(table(spark, ROWS), root, "t", "1", ["k"])
    new = v.publish(table(spark, ROWS).repartition(1).select("x", "k", "part"), root, "t", "2", ["k"], buckets=4)
    assert v.changed_buckets(old, new) == ([], 4) and old.buckets == v.LEAST_BUCKETS
    assert v.compare(old, new).count() == 0
    assert {r["keys"] for r in v.summary(old, new).collect()} == {0}


def test_bags_nulls_and_other_columns(spark, root):
    rows = [(1, "a", 1.0), (1, "a", 2.0), (None, "a", 1.0), (2, None, None), (3, "a", 0.0), (3, "a", 0.0)]
    old = v.publish(table(spark, rows), root, "t", "1", ["k", "part"], buckets=2)
    new = v.publish(table(spark, [rows[1], rows[0], (None, "a", 3.0), rows[3], rows[4]]), root, "t", "2", ["k", "part"], buckets=8)
    assert changes(old, new) == {(None, "a", "changed", 1, 1), (3, "a", "changed", 2, 1)}
    assert changes(new, old) == {(None, "a", "changed", 1, 1), (3, "a", "changed", 1, 2)}
    wider = v.publish(table(spark, rows).withColumn("y", F.lit(1)), root, "t", "3", ["k", "part"], buckets=2)
    assert {c[2] for c in changes(old, wider)} == {"changed"} and len(changes(old, wider)) == 4
    empty = v.publish(table(spark, []), root, "t", "4", ["k", "part"], parent="1")
    assert {c[2] for c in changes(old, empty)} == {"removed"} and len(changes(empty, old)) == 4 and empty.rows().count() == 0


def test_a_job_that_dies_leaves_no_version(spark, root, monkeypatch):
    def die(*_):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(v, "_write_new", die)
        with pytest.raises(RuntimeError):
            v.publish(table(spark, ROWS[:50]), root, "t", "1", ["k"])
    assert v.versions(spark, root, "t") == []
    with pytest.raises(ValueError):
        v.open_version(spark, root, "t", "1")
    again = v.publish(table(spark, ROWS), root, "t", "1", ["k"])
    assert v.versions(spark, root, "t") == ["1"] and again.rows().count() == again.n_rows == 200
    with pytest.raises(ValueError):
        v.publish(table(spark, ROWS), root, "t", "1", ["k"])


def test_bad_arguments(spark, root):
    df = table(spark, ROWS[:5])
    for bad in ({"key": []}, {"key": ["nope"]}, {"key": ["k"], "buckets": 3}, {"key": ["k"], "parent": "none"}):
        with pytest.raises(ValueError):
            v.publish(df, root, "t", "1", **bad)
    a = v.publish(df, root, "t", "1", ["k"])
    b = v.publish(df, root, "t", "2", ["part"])
    with pytest.raises(ValueError):
        v.compare(a, b)
    assert v.versions(spark, root, "other") == []
