import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from trisect.catalog.queries import QUERIES
from trisect.operators.drift import histogram_by_edges, psi, reference_edges
from trisect.plans import search, selection
from trisect.plans.monitoring import compare_models, validate_model
from trisect.plans.selection import MODEL_NAME, PARAMS_NAME, RANKING_NAME, run_selection
from trisect.session import scratch_path
from trisect.sources.tables import artifact_path, read_artifact, write_artifact
from trisect.streaming.monitor import window_divergences, windowed_bin_counts

QUICK = (
    search.Candidate("Logistic Regression (L1)", search.LOGISTIC_L1.make, search.LOGISTIC_L1.grid[:1]),
    search.Candidate("Random Forest", search.FOREST.make, ({"numTrees": 5, "maxDepth": 3},)),
)


def broken(*_):
    raise RuntimeError("no such family")


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    n = 600
    frame = pd.DataFrame({"k": range(n), "a": rng.normal(size=n), "b": rng.normal(size=n), "t": rng.choice(["u", "v"], n)})
    frame["y"] = np.where(frame["a"] + (frame["t"] == "u") + rng.normal(0, 0.3, n) > 0.5, "yes", "no")
    frame["z"] = np.select([frame["a"] < -0.5, frame["a"] > 0.5], ["low", "high"], "mid")
    frame.loc[frame["k"] % 10 == 0, "b"] = np.nan
    df = spark.createDataFrame(frame)
    return df.where("k < 400"), df.where("k >= 400")


def test_search_ranks_families_and_reports_failures(spark, tables):
    train, valid = tables
    found = search.search_models(train, valid, ["a", "b", "t"], "y", (*QUICK, search.Candidate("Broken", broken)))
    ranking = found.ranking.collect()
    assert found.metric == "roc_auc" and found.labels == ["no", "yes"]
    assert {r["estimator_name"] for r in ranking} == {c.name for c in QUICK} and "Broken" in found.failures
    assert ranking[0]["metric_test"] >= ranking[1]["metric_test"] and ranking[0]["metric_test"] > 0.9
    assert found.best_name == ranking[0]["estimator_name"]
    assert dict(ranking[0]["hiperparameters"]) == {k: str(v) for k, v in found.best_params.items()}
    scored = found.predict_proba(valid.drop("y"))
    assert scored.columns == [*valid.drop("y").columns, "scores", "predicted"]
    report = {r["metric"]: r["value"] for r in found.evaluate(valid, "y").collect()}
    assert report["ROC AUC"] == pytest.approx(ranking[0]["metric_test"], abs=1e-9)
    assert report["Accuracy"] > 0.8 and set(found.predict(valid).columns) == {*valid.columns, "predicted"}


def test_search_of_three_labels(tables):
    train, valid = tables
    found = search.search_models(train, valid, ["a", "b"], "z", (QUICK[1], search.BOOSTED_SHALLOW), budget_s=0)
    assert found.metric == "roc_auc_ovr" and found.labels == ["high", "low", "mid"]
    # The budget is spent after the first fit.
    assert [r["estimator_name"] for r in found.ranking.collect()] == ["Random Forest"]
    assert [name for name, _ in found.skipped] == [c.name for c in (search.BOOSTED_SHALLOW,)]


def test_no_candidate_gives_an_empty_ranking(tables):
    found = search.search_models(*tables, ["a"], "y", (search.Candidate("Broken", broken),))
    assert found.ranking.collect() == [] and found.best_model is None
    assert found.ranking.columns == ["estimator_name", "metric_train", "metric_test", "hiperparameters"]


def test_logistic_fit_equals_newtons_method(spark, tables):
    train, _ = tables
    rows = [(r.a, float(np.nan if r.b is None else r.b), r.y) for r in train.collect()]
    a, b, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] == "yes" for r in rows], float)
    b = np.where(np.isnan(b), np.nanmean(b), b)
    x, w = np.stack([np.ones_like(a), a, b], axis=1), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (y - p))
    model, labels = search.fit_final(train, ["a", "b"], "y", LogisticRegression(regParam=0.0, maxIter=200, tol=1e-12))
    fitted = model.stages[-1]
    assert labels == ["no", "yes"]
    assert [fitted.intercept, *fitted.coefficients] == pytest.approx(w, abs=1e-5)


def test_fits_at_once_give_the_same_ranking(spark, tables):
    train, valid = tables
    families = (*QUICK, search.Candidate("Broken", broken), search.LINEAR)
    runs = [search.search_models(train, valid, ["a", "b"], "y", families, budget_s=None, partitions=2, parallelism=p) for p in (1, 3)]
    shown = [sorted((r.estimator_name, round(r.metric_test, 9), str(r.hiperparameters)) for r in x.ranking.collect()) for x in runs]
    assert shown[0] == shown[1] and len(shown[0]) == 3 and set(runs[1].failures) == {"Broken"}
    assert runs[0].best_params == runs[1].best_params


SMALL = {"Random Forest": {"numTrees": 3}, "Extra Trees": {"numTrees": 3, "maxDepth": 3}, "Neural Network": {"maxIter": 5, "hidden": [4]}}


@pytest.mark.parametrize("label", ["y", "z"])
def test_every_family_fits(tables, label):
    families = {c.name: c for c in (*search.SEARCH_FAMILIES, *search.HOLDOUT_FAMILIES)}
    small = [
        search.Candidate(c.name, c.make, ({**c.grid[0], **SMALL.get(c.name, {"maxIter": 3})},)) for c in families.values()
    ]
    found = search.search_models(*tables, ["a", "b"], label, small, budget_s=None, partitions=2)
    assert {r["estimator_name"] for r in found.ranking.collect()} == set(families) and not found.failures and not found.skipped
    assert all(r["metric_test"] > 0.6 for r in found.ranking.collect())


def test_booleans_and_hashed_text(spark, tables):
    train, valid = (df.withColumns({"up": F.when(F.col("k") % 7 > 0, F.col("a") > 0), "many": F.concat(F.lit("v"), "k")}) for df in tables)
    features = ["up", "t", "many"]
    model, labels = search.fit_final(
        train, features, "y", search.RandomForestClassifier(numTrees=3, maxDepth=3, seed=1), encode={"many": "hash"}
    )
    named = {r["feature"] for r in search.importances(spark, model).collect()}
    assert {"_up_filled", "_hashed_0", f"_hashed_{search.HASHED_SIZE - 1}"} <= named
    assert search.score(model, labels, valid).count() == valid.count()
    for wrong in ({"many": "x"}, {"other": "hash"}):
        with pytest.raises(ValueError):
            search.feature_stages(train, features, wrong)


def test_the_data_do_not_choose_the_encoding(spark, monkeypatch):
    for n in (999, 1001):
        df = spark.range(n).select(F.concat(F.lit("v"), "id").alias("c"))
        assert [type(s).__name__ for s in search.feature_stages(df, ["c"])] == ["StringIndexer", "OneHotEncoder", "VectorAssembler"]
    monkeypatch.setattr(search, "MOST_CATEGORIES", 1000)
    with pytest.raises(ValueError, match="hash"):
        search.feature_stages(df, ["c"])


def test_bad_search_arguments(tables):
    train, valid = tables
    with pytest.raises(ValueError):
        search.search_models(train, valid, ["a"], "y", metric="x")
    with pytest.raises(ValueError):
        search.search_models(train, valid, ["a"], "q")
    with pytest.raises(ValueError):
        search.search_models(train.where("k < 0"), valid, ["a"], "y")
    with pytest.raises(ValueError):
        search.search_models(train, valid.where("k < 0"), ["a"], "y")


def test_holdout_search_and_hyperparams(tables):
    train, _ = tables
    found = search.search_with_holdout(train, ["a", "b"], "z", ["k"], QUICK)
    assert found.metric == "f1" and found.ranking.count() >= 1
    table, model = search.search_hyperparams(
        train, ["a", "t"], "y", ["k"], LogisticRegression(), {"regParam": [0.001, 10.0], "elasticNetParam": [1.0]}, folds=2
    )
    rows = table.collect()
    assert len(rows) == 2 and dict(rows[0]["hiperparameters"])["regParam"] == "0.001"
    assert "prediction" in model.transform(train).columns


def test_hyperparams_are_those_of_the_cross_validator(tables, monkeypatch):
    """Scores as MLlib's; each fold and parameter set is scored once, by the exact area."""
    train, _ = tables
    grid, areas = {"regParam": [0.001, 0.5]}, []
    area = search.roc_auc_binary
    monkeypatch.setattr(search, "roc_auc_binary", lambda *args: areas.append(1) or area(*args))
    table, _ = search.search_hyperparams(train, ["a", "t"], "y", ["k"], LogisticRegression(), grid, folds=2)
    ours = {r["hiperparameters"]["regParam"]: r["metric"] for r in table.collect()}
    assert len(areas) == 4
    prepared = Pipeline(stages=[*search.feature_stages(train, ["a", "t"]), search.label_stage("y")]).fit(train)
    folded = train.withColumn("_fold", (search.hash_number(search.row_hash(["k"])) % 2).cast("int"))
    lr = LogisticRegression(labelCol=search.LABEL, featuresCol=search.FEATURES)
    maps = ParamGridBuilder().addGrid(lr.regParam, grid["regParam"]).build()
    theirs = CrossValidator(
        estimator=lr, estimatorParamMaps=maps, numFolds=2, foldCol="_fold",
        evaluator=BinaryClassificationEvaluator(labelCol=search.LABEL, numBins=0),
    ).fit(prepared.transform(folded))
    for m, value in zip(maps, theirs.avgMetrics, strict=True):
        assert ours[str(m[lr.regParam])] == pytest.approx(value, abs=1e-9)


def test_network_and_importances(spark, tables):
    train, valid = tables
    found = search.search_models(train, valid, ["a", "b"], "y", (search.NETWORK,))
    assert found.ranking.first()["metric_test"] > 0.5
    forest, _ = search.fit_final(train, ["a", "t"], "y", search.RandomForestClassifier(numTrees=5, seed=1))
    named = {r["feature"]: r["importance"] for r in search.importances(spark, forest).collect()}
    assert sum(named.values()) == pytest.approx(1.0) and "_a_filled" in named


def test_model_validation(spark):
    new = spark.createDataFrame([("ROC AUC", 0.8), ("Accuracy", 0.6)], "metric string, value double")
    old = spark.createDataFrame([("ROC AUC", 0.7), ("Accuracy", 0.7)], "metric string, value double")
    same = spark.range(400).select((F.col("id") % 2 == 0).alias("is_ref"), (F.col("id") / 2).cast("long").cast("double").alias("x"))
    rows = validate_model(new, old, same, ["x"]).collect()
    assert {(r["check"], r["name"]): r["passed"] for r in rows} == {
        ("metric", "ROC AUC"): True, ("metric", "Accuracy"): False, ("drift", "x"): True
    } and all(r["accept"] for r in rows)
    moved = same.withColumn("x", F.when(F.col("is_ref"), F.col("x")).otherwise(F.col("x") + 500))
    assert not any(r["accept"] for r in validate_model(new, old, moved, ["x"]).collect())
    assert not any(r["accept"] for r in validate_model(old, new, same, ["x"]).collect())


def test_selection_job(spark, tables):
    train, valid = tables
    root = scratch_path(spark, "job")
    write_artifact(train, root, "train", "7")
    write_artifact(valid, root, "test", "7")
    write_artifact(spark.createDataFrame([('{"target": "y", "all": ["a", "t"]}',)], "document string"), root, "meta", "7")
    found = run_selection(spark, root, ("train", "7"), ("test", "7"), ("meta", "7"), "7", QUICK[:1])
    assert read_artifact(spark, root, RANKING_NAME, "7").count() == 1
    params = read_artifact(spark, root, PARAMS_NAME, "7").first()
    assert params["estimator_name"] == found.best_name and params["labels"] == ["no", "yes"]
    model = PipelineModel.load(artifact_path(root, MODEL_NAME, "7"))
    again = search.evaluate(model, params["labels"], valid, "y")
    comparison = compare_models(found.evaluate(valid, "y"), again).collect()
    assert {r["delta"] for r in comparison} == {0.0} and all(r["accept"] for r in comparison)
    with pytest.raises(ValueError):
        run_selection(spark, root, (), ("test", "7"), ("meta", "7"), "8")
    bad = valid.withColumn("y", F.when(F.col("k") > 500, F.col("y")))
    write_artifact(bad, root, "test", "bad")
    with pytest.raises(ValueError, match="missing values in: test"):
        run_selection(spark, root, ("train", "7"), ("test", "bad"), ("meta", "7"), "8")


def test_stream_counts_equal_the_batch(spark):
    source = scratch_path(spark, "stream")
    rows = spark.range(2000).select(
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, id)").alias("t"), (F.col("id") % 97).cast("double").alias("x")
    )
    rows.repartition(4).write.parquet(source)
    reference = rows.where("x < 50").select("x", F.lit(True).alias("is_ref"))
    edges = reference_edges(reference, ["x"])
    stream = spark.readStream.schema(rows.schema).parquet(source)
    counts = windowed_bin_counts(stream, "t", "12 hours", "1 minute", edges)
    running = (
        counts.writeStream.format("memory").queryName("bins").outputMode("complete")
        .option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    written = spark.table("bins")
    assert written.agg(F.sum("n_cur")).first()[0] == 2000
    reference_bins = histogram_by_edges(reference, edges)
    found = window_divergences(written, reference_bins).orderBy("window_start").collect()
    first = rows.where("t < timestamp'2024-01-01 12:00:00'").select("x", F.lit(False).alias("is_ref"))
    direct = psi(reference.unionByName(first), ["x"]).first()["psi"]
    assert found[0]["psi"] == pytest.approx(direct) and len(found) == 3


@pytest.mark.parametrize("name", ["batch_score", "feature_reduction"])
def test_scores_cover_the_whole_table(spark, name):
    folder = "/root/testdata/sf0.001"
    assert QUERIES[name](spark, folder).count() == spark.read.parquet(f"{folder}/lineitem.parquet").count()


def test_partitions_of_a_fit_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(search, "PARTITION_ROWS", 100)
    table = spark.range(1000)
    assert search.spread(table, 4).rdd.getNumPartitions() == 10
    assert search.spread(table, 16).rdd.getNumPartitions() == 16
    assert search.spread(table.limit(0), 4).rdd.getNumPartitions() == 4


def test_holdout_fits_at_once_change_nothing(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(a), float(a + rng.normal()), "pqr"[int(a > 0) + int(a > 1)]) for i, a in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "k long, a double, b double, z string")
    one, two = (
        search.search_with_holdout(df, ["a", "b"], "z", ["k"], (search.LINEAR, search.LOGISTIC_L1), None, partitions=2, parallelism=p)
        for p in (1, 2)
    )
    assert one.ranking.collect() == two.ranking.collect() and not two.failures


@pytest.fixture
def line_folder(spark, tmp_path):
    """A folder with a small lineitem table of its own, on both sides of the dates that cut it."""
    rng = np.random.default_rng(9)
    n = 240
    frame = pd.DataFrame({
        "l_orderkey": np.arange(n), "l_partkey": rng.integers(0, 20, n), "l_suppkey": rng.integers(0, 5, n), "l_linenumber": 1,
        "l_quantity": rng.integers(1, 51, n).astype(float), "l_extendedprice": rng.uniform(900, 90000, n),
        "l_discount": rng.integers(0, 11, n) / 100, "l_tax": rng.integers(0, 9, n) / 100,
        "l_returnflag": rng.choice(["A", "N", "R"], n), "l_linestatus": rng.choice(["F", "O"], n),
        "l_shipdate": pd.Timestamp("1998-01-01") + pd.to_timedelta(np.arange(n) * 5, unit="D"),
    })
    spark.createDataFrame(frame).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def searched(monkeypatch) -> dict:
    """What a query hands to the search, which then tries a quick family only."""
    seen, search_models = {}, search.search_models

    def recorded(train, valid, features, label, candidates, *args, **kwargs):
        seen["families"] = {c.name: c.grid for c in candidates}
        seen["budget_s"] = kwargs["budget_s"] if "budget_s" in kwargs else args[1]
        return search_models(train, valid, features, label, QUICK[:1], *args, **kwargs)

    monkeypatch.setattr(search, "search_models", recorded)
    monkeypatch.setattr(selection, "search_models", recorded)
    return seen


@pytest.mark.parametrize("name, families", [
    ("model_search", search.SEARCH_FAMILIES),
    ("model_search_f1", search.HOLDOUT_FAMILIES),
    ("selection_job", search.SEARCH_FAMILIES),
])
def test_searches_of_the_catalog_try_every_family(spark, line_folder, monkeypatch, name, families):
    seen = searched(monkeypatch)
    assert QUERIES[name](spark, line_folder).count() == 1
    assert seen == {"families": {c.name: c.grid for c in families}, "budget_s": None}
