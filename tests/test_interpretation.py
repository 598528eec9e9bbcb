import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trisect.operators import metrics
from trisect.operators.ranking import Buckets
from trisect.plans import interpretation, search


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def exchanged_plainly(rows, key, columns, repeats, seed, digits):
    """{(feature, repeat): rows}, rows as dicts."""
    buckets = {}
    for r in rows:
        tie = md5("".join("n" if r[k] is None else f"{len(str(r[k]))}:{r[k]}" for k in key) + f"seed:{seed}")
        buckets.setdefault(tie[:digits], []).append((tie, r))
    out = {(interpretation.UNCHANGED, 0): list(rows)}
    for c in columns:
        for repeat in range(repeats):
            mine = []
            for name, members in buckets.items():
                members = [r for _, r in sorted(members, key=lambda m: m[0])]
                n = len(members)
                shift = 1 + int(md5(f"{c}|{repeat}|{name}|{seed}")[:8], 16) % (n - 1) if n > 1 else 0
                mine += [{**r, c: members[(i + shift) % n][c]} for i, r in enumerate(members)]
            out[c, repeat] = mine
    return out


def area(score, positive):
    s, p = np.array(score, float), np.array(positive, bool)
    keep = ~np.isnan(s)
    s, p = s[keep], p[keep]
    d = s[p][:, None] - s[~p][None, :]
    return float(((d > 0) + (d == 0) / 2).mean())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = []
    for i in range(300):
        a, b, c = (float(x) for x in rng.normal(size=3))
        out.append({"k": i, "a": None if i % 29 == 0 else a, "b": b, "t": "uv"[i % 2], "c": c, "y": int(a + 0.3 * b + rng.normal(0, 0.4) > 0)})
    return out


SCHEMA = "k long, a double, b double, t string, c double, y int"
MADE = "coalesce(a, 0) + 0.3 * b + IF(t = 'u', 0.1, 0)"


def predict(df):
    return df.withColumn("s", F.expr(MADE))


def made(r):
    return (r["a"] or 0) + 0.3 * r["b"] + (0.1 if r["t"] == "u" else 0)


@pytest.mark.parametrize("digits", [1, 2])
def test_exchange_equals_plain_version(spark, rows, monkeypatch, digits):
    monkeypatch.setattr(interpretation, "prefix_digits", lambda *_: digits)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {}
    for r in interpretation.exchanged(df, ["k"], ["a", "t"], 2, seed=5).collect():
        found.setdefault((r._feature, r._repeat), []).append({c: r[c] for c in ("k", "a", "b", "t", "c", "y")})
    expected = exchanged_plainly(rows, ["k"], ["a", "t"], 2, 5, digits)
    assert found.keys() == expected.keys()
    for group, mine in found.items():
        assert sorted(mine, key=lambda r: r["k"]) == sorted(expected[group], key=lambda r: r["k"])
        assert sorted(map(str, (r["a"] for r in mine))) == sorted(map(str, (r["a"] for r in rows)))


def test_importance_equals_plain_version(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = interpretation.permutation_importance(
        df, ["k"], ["a", "b", "t", "c"], "y", predict, {0: -F.col("s"), 1: F.col("s")}, repeats=3
    )
    digits = interpretation.prefix_digits(300, 1_000_000)
    groups = exchanged_plainly(rows, ["k"], ["a", "b", "t", "c"], 3, 0, digits)
    areas = {g: area([made(r) for r in m], [r["y"] == 1 for r in m]) for g, m in groups.items()}
    base = areas[interpretation.UNCHANGED, 0]
    table = {r.feature: r for r in found.collect()}
    assert set(table) == {"a", "b", "t", "c"}
    for f, r in table.items():
        mine = [areas[f, k] for k in range(3)]
        assert [r.auc, r.auc_exchanged, r.importance, r["std"]] == pytest.approx([base, np.mean(mine), base - np.mean(mine), np.std(mine, ddof=1)])
    assert table["c"].importance == 0 and table["a"].importance > table["b"].importance > 0.01
    again = interpretation.permutation_importance(
        df.repartition(7), ["k"], ["a", "b", "t", "c"], "y", predict, {0: -F.col("s"), 1: F.col("s")}, repeats=3
    )
    assert sorted(map(str, again.collect())) == sorted(map(str, table.values()))


def test_importance_of_a_fitted_model_of_three_classes(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("z", F.expr("CASE WHEN b < -0.5 THEN 'x' WHEN b < 0.5 THEN 'y' ELSE 'z' END"))
    found = search.search_models(df, df, ["a", "b", "t"], "z", (search.LINEAR,), budget_s=None)
    scores = {c: F.col("scores")[i] for i, c in enumerate(found.labels)}
    table = {r.feature: r for r in interpretation.permutation_importance(df, ["k"], ["a", "b", "t"], "z", found.predict_proba, scores, 2).collect()}
    assert table["b"].importance > 0.2 > 0.05 > abs(table["a"].importance) and table["b"].repeats == 2


def test_partial_dependence_equals_plain_version(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("empty", F.lit(None).cast("double"))
    found = interpretation.partial_dependence(df, ["a", "t", "empty"], predict, F.col("s"), points=5)
    a = np.array([r["a"] for r in rows if r["a"] is not None])
    table = {(r.feature, r.value): r for r in found.collect()}
    assert len(table) == 7 and all(r.n == 300 for r in table.values())
    numbers = sorted((float(v), r.mean_score) for (f, v), r in table.items() if f == "a")
    for (v, mean), q in zip(numbers, np.quantile(a, [0, 0.25, 0.5, 0.75, 1]), strict=True):
        assert v == pytest.approx(q) and mean == pytest.approx(np.mean([made({**r, "a": v}) for r in rows]))
    for t in "uv":
        assert table["t", t].mean_score == pytest.approx(np.mean([made({**r, "t": t}) for r in rows]))


def test_small_and_bad_inputs(spark, rows, monkeypatch):
    scores = {0: -F.col("s"), 1: F.col("s")}
    one = spark.createDataFrame(rows[:1], SCHEMA)
    r = interpretation.permutation_importance(one, ["k"], ["a"], "y", predict, scores, 1).first()
    assert (r.auc, r.importance) == (None, None)
    nothing = one.where("false")
    assert interpretation.permutation_importance(nothing, ["k"], ["a"], "y", predict, scores).count() == 0
    assert interpretation.partial_dependence(nothing, ["a"], predict, F.col("s")).count() == 0
    with pytest.raises(ValueError):
        interpretation.permutation_importance(one, ["k"], [], "y", predict, scores)
    with pytest.raises(ValueError):
        interpretation.partial_dependence(one, ["a"], predict, F.col("s"), points=1)
    monkeypatch.setattr(interpretation, "MOST_VALUES", 1)
    with pytest.raises(ValueError):
        interpretation.partial_dependence(spark.createDataFrame(rows, SCHEMA), ["t"], predict, F.col("s"))


def test_repeated_rows_and_keys(spark, rows):
    df = spark.createDataFrame([*rows[:20], *rows[:20], {**rows[0], "k": None}, {**rows[1], "k": None}], SCHEMA)
    out = interpretation.exchanged(df, ["k"], ["b"], 1)
    assert out.where("_feature = 'b'").count() == 42
    values = lambda t: sorted(r.b for r in t.collect())
    assert values(out.where("_feature = 'b'")) == values(df)


def test_the_exchange_takes_one_shuffle_and_no_join(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    made = interpretation.exchanged(df, ["k"], ["a", "t"], 2)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange") == 1 and "Join" not in final


def test_areas_of_parts_equal_plain_version(spark, monkeypatch):
    """Level scores, zeros of both signs, NaN, infinity and nulls, packed in small pieces over several buckets."""
    monkeypatch.setattr(metrics, "PACKED_ROWS", 50)
    rng = np.random.default_rng(3)
    odd = [0.0, -0.0, float("nan"), float("inf"), float("-inf"), None]
    made = [(int(p), odd[i % 6] if i % 5 == 0 else float(rng.integers(0, 40)) / 7, bool(rng.random() < 0.4)) for i, p in enumerate(rng.integers(0, 3, 900))]
    made += [(7, 1.0, True), (8, None, True)]
    df = spark.createDataFrame(made, "part int, score double, positive boolean").repartition(5)
    for cuts in (Buckets((-np.inf, 0.0, np.inf), {}), Buckets((-np.inf, 0.0, 1.0, 3.0, np.inf), {}, 4)):
        found = {r.part: r for r in metrics.roc_auc_by(df, cuts).collect()}
        assert set(found) == {0, 1, 2, 7} and found[7].auc is None
        for p in range(3):
            pos, neg = ([s for q, s, y in made if q == p and s is not None and y == side] for side in (True, False))
            rank = lambda s: (np.isnan(s), 0.0 if np.isnan(s) else s)
            beaten = sum((rank(a) > rank(b)) + (rank(a) == rank(b)) / 2 for a in pos for b in neg)
            assert (found[p].n_pos, found[p].n_neg) == (len(pos), len(neg))
            assert found[p].auc == pytest.approx(beaten / len(pos) / len(neg), abs=1e-12)
