import itertools
import math

import numpy as np
import pytest

from trisect.plans import halving, search


def cost(rungs, n_rows):
    return sum(r.configs * math.ceil(r.share * n_rows) for r in rungs)


def test_plans_keep_the_budget_and_halve():
    for n_rows, n_configs, eta, factor in itertools.product((1, 5000, 10**9), (1, 2, 9, 10, 50), (2, 3), (0.5, 1, 2, 5, 100)):
        budget = int(factor * n_rows)
        rungs = halving.plan_rungs(n_rows, n_configs, budget, eta)
        assert rungs[-1].share == 1.0 and rungs[0].configs <= n_configs
        assert cost(rungs, n_rows) <= budget or rungs == [halving.Rung(1.0, 1)]
        assert all(b.share == pytest.approx(eta * a.share) and b.configs <= a.configs for a, b in zip(rungs, rungs[1:]))
        assert len(rungs) == 1 or rungs[0].share * n_rows >= 1000
        if budget >= n_configs * n_rows:
            assert rungs == [halving.Rung(1.0, n_configs)]
    # 27 sets for the price of little more than four full fits.
    assert [(round(r.share * 27), r.configs) for r in halving.plan_rungs(270_000, 27, 1_100_000)] == [(1, 27), (3, 9), (9, 3), (27, 1)]


def test_bad_plans():
    for bad in ((10, 1, 10, 1), (0, 1, 10, 2), (10, 0, 10, 2)):
        with pytest.raises(ValueError):
            halving.plan_rungs(*bad)


def test_grids_are_spread_and_repeat():
    space = {"regParam": (1e-4, 1.0, "log"), "maxIter": (3, 6), "elasticNetParam": [0.0, 1.0], "tol": (0.1, 0.2)}
    grid = halving.spread_grid(search.LINEAR, space, 16).grid
    assert grid == halving.spread_grid(search.LINEAR, space, 16).grid and len({str(g) for g in grid}) == 16
    assert {g["maxIter"] for g in grid} == {3, 4, 5, 6} and {g["elasticNetParam"] for g in grid} == {0.0, 1.0}
    logs = sorted(math.log10(g["regParam"]) for g in grid)
    assert -4 < logs[0] < -3.5 and -0.5 < logs[-1] < 0 and np.diff(logs).max() < 0.6
    assert all(0.1 <= g["tol"] < 0.2 for g in grid)
    with pytest.raises(ValueError):
        halving.spread_grid(search.LINEAR, {str(i): [0] for i in range(9)}, 1)


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(6)
    n = 1500
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = (a + 0.5 * b + rng.normal(0, 0.7, n) > 0).astype(int)
    rows = [(i, float(x), float(z), int(k)) for i, (x, z, k) in enumerate(zip(a, b, y, strict=True))]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int").cache()
    return df.where("k < 1000"), df.where("k >= 1000")


def test_samples_are_nested_and_counted(spark, tables):
    train, _ = tables
    rungs = [halving.Rung(s, 1) for s in (1 / 9, 1 / 3, 1.0)]
    found = halving.rung_sizes(train, ["k"], rungs).orderBy("rung").collect()
    kept = [{r.k for r in train.where(halving.in_sample(["k"], x.share)).collect()} for x in rungs]
    assert [r.rows for r in found] == [len(k) for k in kept] and kept[0] < kept[1] < kept[2] and len(kept[2]) == 1000
    again = halving.rung_sizes(train.repartition(5), ["k"], rungs).orderBy("rung").collect()
    assert [r.rows for r in again] == [r.rows for r in found]


def broken(*_):
    raise RuntimeError("no such family")


def run(tables, budget, parallelism=1, repartition=None):
    train, valid = tables
    if repartition:
        train, valid = train.repartition(repartition), valid.repartition(repartition)
    linear = halving.spread_grid(search.LINEAR, {"regParam": (1e-3, 10.0, "log"), "elasticNetParam": [0.0, 1.0]}, 7)
    families = (linear, search.Candidate("Broken", broken), search.Candidate("Other", search.LOGISTIC_L1.make, ({"regParam": 0.3},)))
    return halving.search_halving(
        train, valid, ["a", "b"], "y", ["k"], families, budget, least_rows=50, parallelism=parallelism
    )


def shown(result, log):
    ranking = [(r.estimator_name, round(r.metric_test, 9), dict(r.hiperparameters)) for r in result.ranking.collect()]
    rows = [(r.rung, r.rows, r.estimator_name, str(dict(r.hiperparameters)), r.metric and round(r.metric, 9), r.kept) for r in log.collect()]
    return ranking, rows


def test_search_by_halving(tables):
    result, log = run(tables, 3300)
    ranking, rows = shown(result, log)
    by_rung = {n: [r for r in rows if r[0] == n] for n in {r[0] for r in rows}}
    assert len(by_rung) > 1 and len(by_rung[0]) == 9 and result.skipped == []
    assert "Broken" in result.failures and not any(r[5] for r in rows if r[2] == "Broken")
    for n in range(len(by_rung) - 1):
        kept = [r for r in by_rung[n] if r[5]]
        assert {r[2:4] for r in kept} == {r[2:4] for r in by_rung[n + 1]}
        assert min(r[4] for r in kept) >= max(r[4] for r in by_rung[n] if not r[5] and r[4] is not None)
    assert sum(r[1] for r in rows) <= 3300 * 1.2  # sample sizes are those of a hash
    # The last round is a search over all rows.
    last = by_rung[max(by_rung)]
    assert {r[1] for r in last} == {1000}
    train, valid = tables
    for name, value, params in ranking:
        numbers = {k: float(v) for k, v in params.items()}
        candidate = search.Candidate(name, search.LINEAR.make, (numbers,))
        full = search.search_models(train, valid, ["a", "b"], "y", (candidate,), budget_s=None)
        assert full.ranking.first().metric_test == pytest.approx(value, abs=1e-9)
    assert result.best_name == ranking[0][0] and result.predict_proba(valid).count() == 500


def test_search_repeats_on_any_machine(tables):
    first = shown(*run(tables, 2500))
    assert shown(*run(tables, 2500, parallelism=3, repartition=4)) == first


def test_a_budget_too_small_leaves_sets_out(tables):
    result, log = run(tables, 1)
    assert log.count() == 1 and len(result.skipped) == 8 and result.ranking.count() == 1


def test_nothing_to_try(tables):
    with pytest.raises(ValueError):
        halving.search_halving(*tables, ["a"], "y", ["k"], (), 10)
    with pytest.raises(ValueError):
        halving.search_halving(*tables, ["a"], "y", ["k"], (search.LINEAR,), 10, metric="x")
    with pytest.raises(ValueError):
        halving.search_halving(tables[0].where("false"), tables[1], ["a"], "y", ["k"], (search.LINEAR,), 10)
