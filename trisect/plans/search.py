"""Model search over MLlib families: candidates, time budget, ranking, hyper-parameters.

Fits are distributed; they run one after another, or a few at once where a single one leaves cores idle. The budget is tested
before each.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    FeatureHasher,
    Imputer,
    IndexToString,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from trisect.functions.keys import SEED, hash_number, row_hash
from trisect.operators.checks import check_not_empty, check_target_exists, target_nulls
from trisect.operators.metrics import (
    accuracy,
    classification_report,
    confusion_matrix,
    f1_weighted,
    roc_auc_binary,
    roc_auc_ovr_weighted,
    roc_auc_per_class,
)
from trisect.operators.split import SplitSpec, fit_split
from trisect.plans.calibration import CalibratedOneVsRest
from trisect.plans.counted import COUNT, CountedTrees
from trisect.plans.extra_trees import ExtraTreesClassifier
from trisect.session import lookup

# Fixed values
SEARCH_BUDGET_S = 360
HOLDOUT_BUDGET_S = 10
METRICS = ("roc_auc", "roc_auc_ovr", "roc_auc_ovr_weighted", "accuracy", "f1")

RANKING_SCHEMA = T.StructType([
    T.StructField("estimator_name", T.StringType()),
    T.StructField("metric_train", T.DoubleType()),
    T.StructField("metric_test", T.DoubleType()),
    T.StructField("hiperparameters", T.MapType(T.StringType(), T.StringType())),
])

# One-hot encoding passes the list of a column's values through the driver; longer lists are refused.
MOST_CATEGORIES = 100_000
HASHED_SIZE = 4096
# Most rows, on average, of a partition that a fit passes over.
PARTITION_ROWS = 200_000
LABEL = "_label"
FEATURES = "_features"


@dataclass(frozen=True)
class Candidate:
    """A model family: a function of (classes, features, params) and the parameter sets to try."""

    name: str
    make: Callable[[int, int, dict], Estimator]
    grid: tuple[dict, ...] = ({},)


def _boosted(n_classes: int, _: int, params: dict) -> Estimator:
    trees = GBTClassifier(labelCol=LABEL, featuresCol=FEATURES, seed=SEED, **params)
    if n_classes == 2 and trees.getSubsamplingRate() == 1.0:
        return CountedTrees(classifier=trees.setWeightCol(COUNT), trees=trees, labelCol=LABEL, featuresCol=FEATURES)
    if n_classes == 2:
        return trees
    return CalibratedOneVsRest(classifier=trees, n_classes=n_classes, labelCol=LABEL, featuresCol=FEATURES)


def _forest(_: int, __: int, params: dict) -> Estimator:
    return RandomForestClassifier(labelCol=LABEL, featuresCol=FEATURES, seed=SEED, **params)


def _logistic(_: int, __: int, params: dict) -> Estimator:
    return LogisticRegression(labelCol=LABEL, featuresCol=FEATURES, **params)


def _extra_trees(_: int, __: int, params: dict) -> Estimator:
    return ExtraTreesClassifier(labelCol=LABEL, featuresCol=FEATURES, seed=SEED, **params)


def _network(n_classes: int, n_features: int, params: dict) -> Estimator:
    layers = [n_features, *params.get("hidden", [16]), n_classes]
    rest = {k: v for k, v in params.items() if k != "hidden"}
    return MultilayerPerceptronClassifier(
        labelCol=LABEL, featuresCol=FEATURES, seed=SEED, layers=layers, **rest
    )


BOOSTED = Candidate("Gradient Boosted Trees", _boosted, ({"maxIter": 20}, {"maxIter": 50, "stepSize": 0.05}))
BOOSTED_SHALLOW = Candidate("Gradient Boosted Trees (Limit Depth)", _boosted, ({"maxIter": 20, "maxDepth": 3},))
FOREST = Candidate("Random Forest", _forest, ({"numTrees": 20}, {"numTrees": 50, "maxDepth": 8}))
EXTRA_TREES = Candidate("Extra Trees", _extra_trees, ({"numTrees": 20}, {"numTrees": 50, "maxDepth": 10}))
LOGISTIC_L1 = Candidate(
    "Logistic Regression (L1)", _logistic, ({"elasticNetParam": 1.0, "regParam": 0.001}, {"elasticNetParam": 1.0, "regParam": 0.01})
)
LINEAR = Candidate("Logistic Regression (L2)", _logistic, ({"elasticNetParam": 0.0, "regParam": 0.001},))
NETWORK = Candidate("Neural Network", _network, ({"maxIter": 50, "hidden": [16]},))

SEARCH_FAMILIES = (LINEAR, LOGISTIC_L1, FOREST, EXTRA_TREES, BOOSTED_SHALLOW, BOOSTED)
HOLDOUT_FAMILIES = (BOOSTED, FOREST, EXTRA_TREES, NETWORK)


def feature_stages(df: DataFrame, columns: Sequence[str], encode: dict[str, str] | None = None) -> list:
    """Stages from raw columns to one vector: numbers and booleans imputed, text encoded.

    Text is one-hot encoded, or hashed to HASHED_SIZE indicators where the caller says so:
    ``encode={"column": "hash"}``. The data never decide which; a column with more than MOST_CATEGORIES values is
    refused for one-hot encoding.
    """
    encode = encode or {}
    unknown = set(encode.values()) - {"hash", "onehot"} or set(encode) - set(columns)
    if unknown:
        raise ValueError(f"encode takes feature columns and 'hash' or 'onehot', not {', '.join(sorted(unknown))}")
    text = [c for c in dict.fromkeys(columns) if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in dict.fromkeys(columns) if c not in text]
    other = [c for c in numbers if not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]
    if other:
        raise ValueError(f"features must be numbers or text: {', '.join(other)}")
    stages, inputs = [], []
    flags = [c for c in numbers if isinstance(df.schema[c].dataType, T.BooleanType)]
    if flags:
        casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `_{c}_number`" for c in flags)
        stages.append(SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"))
    if numbers:
        filled = [f"_{c}_filled" for c in numbers]
        stages.append(Imputer(inputCols=[f"_{c}_number" if c in flags else c for c in numbers], outputCols=filled))
        inputs += filled
    hashed = [c for c in text if encode.get(c) == "hash"]
    text = [c for c in text if c not in hashed]
    if hashed:
        # Needs no list of the values, which would have to pass through the driver.
        stages.append(FeatureHasher(inputCols=hashed, outputCol="_hashed", numFeatures=HASHED_SIZE))
        inputs.append("_hashed")
    for c in text:
        if df.select(c).distinct().limit(MOST_CATEGORIES + 1).count() > MOST_CATEGORIES:
            raise ValueError(f"column {c!r} has more than {MOST_CATEGORIES} values; ask for encode={{{c!r}: 'hash'}}")
    if text:
        indices = [f"_{c}_index" for c in text]
        encoded = [f"_{c}_onehot" for c in text]
        stages.append(StringIndexer(inputCols=text, outputCols=indices, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indices, outputCols=encoded))
        inputs += encoded
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return stages


def label_stage(label: str) -> StringIndexer:
    """Labels to 0..k-1 in text order."""
    return StringIndexer(inputCol=label, outputCol=LABEL, stringOrderType="alphabetAsc")


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows over the caller's number of partitions, or as they come.

    Every iteration of a fit passes over the table, so a small one in few files leaves most cores idle. Tree models
    sample by partition, so the number is the caller's and never that of the cores. A table of more than PARTITION_ROWS
    rows for each gets as many more as keep to that, so that what a task reads and holds does not grow with the table.
    """
    return df.repartition(max(partitions, math.ceil(df.count() / PARTITION_ROWS))) if partitions else df


def class_scores(scored: DataFrame, n_classes: int) -> dict[object, Column]:
    """One score column per class: probabilities, or raw scores where a model has none."""
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return {float(i): vector_to_array(F.col(source))[i] for i in range(n_classes)}


def metric_value(scored: DataFrame, metric: str, n_classes: int) -> float | None:
    """One metric of a scored table, computed exactly."""
    scores = class_scores(scored, n_classes)
    if metric == "roc_auc":
        table = roc_auc_binary(scored, LABEL, scores[1.0], 1.0).select("auc")
    elif metric == "roc_auc_ovr":
        table = roc_auc_per_class(scored, LABEL, scores).agg(F.avg("auc"))
    elif metric == "roc_auc_ovr_weighted":
        table = roc_auc_ovr_weighted(scored, LABEL, scores)
    elif metric == "accuracy":
        table = accuracy(confusion_matrix(scored, LABEL, "prediction"))
    elif metric == "f1":
        table = f1_weighted(confusion_matrix(scored, LABEL, "prediction"))
    else:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}")
    row = table.first()
    return row[0] if row else None


@dataclass
class SearchResult:
    """What a search found. ``best_model`` turns raw columns into predictions."""

    labels: list[str]
    metric: str
    ranking: DataFrame
    best_name: str | None = None
    best_model: PipelineModel | None = None
    best_params: dict = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    # Families and parameter sets that the budget left untried.
    skipped: list[tuple[str, dict]] = field(default_factory=list)

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Adds ``scores`` (one per class, in label order) and ``predicted`` to the rows."""
        return score(self.best_model, self.labels, df)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``predicted`` to the rows."""
        return self.predict_proba(df).drop("scores")

    def evaluate(self, df: DataFrame, label: str) -> DataFrame:
        """Metric bundle on labelled rows: ``metric``, ``value``."""
        return evaluate(self.best_model, self.labels, df, label)


def score(model: PipelineModel, labels: Sequence[str], df: DataFrame) -> DataFrame:
    """Apply a saved or searched pipeline to new rows: adds ``scores`` and ``predicted``."""
    scored = model.transform(df)
    named = IndexToString(inputCol="prediction", outputCol="predicted", labels=list(labels)).transform(scored)
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return named.select(*df.columns, vector_to_array(source).alias("scores"), "predicted")


def evaluate(model: PipelineModel, labels: Sequence[str], df: DataFrame, label: str) -> DataFrame:
    """ROC AUC, accuracy and weighted F1 of a pipeline on labelled rows."""
    scored = score(model, labels, df).select(F.col(label).cast("string").alias("label"), "predicted", "scores")
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    scores = {name: F.col("scores")[i] for i, name in enumerate(labels)}
    report = lookup(classification_report(scored, "label", "predicted", scores))
    scored.unpersist()
    return report


def search_models(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str],
    label: str,
    candidates: Sequence[Candidate] = SEARCH_FAMILIES,
    metric: str | None = None,
    budget_s: float | None = SEARCH_BUDGET_S,
    encode: dict[str, str] | None = None,
    partitions: int | None = None,
    parallelism: int = 1,
) -> SearchResult:
    """Fit candidate families on ``train``, score them on ``valid``, rank them.

    Every family gets its first parameter set before any gets its second. The first fits, ``parallelism`` of them, always
    run; later ones only while the budget lasts (None: always), and what it left untried is in ``skipped``.
    ``metric`` defaults to ROC AUC, one-vs-rest for more than two labels. Fits that run at once do not see each other.
    """
    if metric is not None and metric not in METRICS:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}")
    check_target_exists({"train": train, "valid": valid}, label)
    spark = train.sparkSession
    prepare = Pipeline(stages=[*feature_stages(train, features, encode), label_stage(label)])
    check_not_empty(train, "train")
    check_not_empty(valid, "valid")
    prepared = prepare.fit(train)
    labels = list(prepared.stages[-1].labels)
    n_classes = len(labels)
    metric = metric or ("roc_auc" if n_classes == 2 else "roc_auc_ovr")
    # Both tables are read once per iteration of every fit.
    sets = [
        spread(prepared.transform(df).select(FEATURES, LABEL), partitions).persist(StorageLevel.MEMORY_AND_DISK)
        for df in (train, valid)
    ]
    try:
        n_features = len(sets[0].first()[FEATURES])
        best: dict[str, tuple[float, dict, object]] = {}
        failures: dict[str, str] = {}
        skipped: list[tuple[str, dict]] = []
        turns = range(max((len(c.grid) for c in candidates), default=0))
        tries = [(i, c, c.grid[t]) for i, (t, c) in enumerate((t, c) for t in turns for c in candidates if t < len(c.grid))]
        started, fits = time.monotonic(), []

        def fit(place: int, candidate: Candidate, params: dict):
            if fits and place >= parallelism and budget_s is not None and time.monotonic() - started > budget_s:
                return candidate, params, None, None, None
            try:
                model = candidate.make(n_classes, n_features, params).fit(sets[0])
                value = metric_value(model.transform(sets[1]), metric, n_classes)
            except Exception as error:  # a family that fails is reported, the search goes on
                return candidate, params, None, None, str(error)
            fits.append(place)
            return candidate, params, model, value, None

        with ThreadPoolExecutor(parallelism) as pool:
            for candidate, params, model, value, error in pool.map(lambda t: inheritable_thread_target(spark)(fit)(*t), tries):
                if error is not None:
                    failures[candidate.name] = error
                elif model is None:
                    skipped.append((candidate.name, params))
                else:
                    known = best.get(candidate.name)
                    if known is None or (value is not None and (known[0] is None or value > known[0])):
                        best[candidate.name] = (value, params, model)
        records = [
            (name, metric_value(model.transform(sets[0]), metric, n_classes), value, {k: str(v) for k, v in params.items()})
            for name, (value, params, model) in best.items()
        ]
    finally:
        for df in sets:
            df.unpersist()
    result = SearchResult(labels, metric, rank_models(spark, records), failures=failures, skipped=skipped)
    top = best_model(result.ranking).first()
    if top:
        result.best_name = top["estimator_name"]
        _, result.best_params, fitted = best[result.best_name]
        # Scoring new rows must not need their label, so the label stage stays out.
        result.best_model = PipelineModel([*prepared.stages[:-1], fitted])
    return result


def rank_models(spark: SparkSession, records: Sequence[tuple]) -> DataFrame:
    """The ranking table, best test metric first; one row per family."""
    return spark.createDataFrame(list(records), RANKING_SCHEMA).orderBy(
        F.desc_nulls_last("metric_test"), "estimator_name"
    )


def best_model(ranking: DataFrame) -> DataFrame:
    """First row of the ranking."""
    return ranking.orderBy(F.desc_nulls_last("metric_test"), "estimator_name").limit(1)


def search_with_holdout(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    candidates: Sequence[Candidate] = HOLDOUT_FAMILIES,
    budget_s: float | None = HOLDOUT_BUDGET_S,
    holdout: float = 0.25,
    encode: dict[str, str] | None = None,
    partitions: int | None = None,
    parallelism: int = 1,
) -> SearchResult:
    """Search on one table: a stratified hold-out serves as validation.

    The metric is ROC AUC for two labels and weighted F1 for more.
    """
    spec = SplitSpec("random", target=label, key=tuple(key), train=1.0 - holdout, test=holdout, backtest=0.0)
    parts = fit_split(df, spec).parts(df)
    binary = df.select(label).distinct().limit(3).count() == 2
    return search_models(
        parts.train, parts.test, features, label, candidates, "roc_auc" if binary else "f1", budget_s, encode, partitions, parallelism
    )


def search_hyperparams(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    estimator: Estimator,
    grid: dict[str, Sequence],
    folds: int = 3,
    parallelism: int = 2,
    encode: dict[str, str] | None = None,
    partitions: int | None = None,
) -> tuple[DataFrame, PipelineModel]:
    """Cross-validated grid over one family: the table of parameters and scores, and the best model.

    Folds come from the row hash, so they do not depend on how the table is partitioned. ``parallelism`` fits run at once, over all
    folds. Model choice uses the exact area under the ROC curve for two labels, MLlib's weighted F1 for more.
    """
    prepare = Pipeline(stages=[*feature_stages(train, features, encode), label_stage(label)]).fit(train)
    labels = prepare.stages[-1].labels
    folded = train.withColumn("_fold", (hash_number(row_hash(key)) % folds).cast("int"))
    rows = spread(prepare.transform(folded).select(FEATURES, LABEL, "_fold"), partitions).persist(StorageLevel.MEMORY_AND_DISK)
    estimator = estimator.copy({estimator.labelCol: LABEL, estimator.featuresCol: FEATURES})
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    binary = len(labels) == 2
    judge = BinaryClassificationEvaluator(labelCol=LABEL, numBins=0) if binary else MulticlassClassificationEvaluator(
        labelCol=LABEL, metricName="f1"
    )

    def tried(at: tuple[int, int]) -> float:
        fold, turn = at
        # Folds are read from the rows kept above; copies of their own would take as much memory again.
        model = estimator.fit(rows.where(F.col("_fold") != fold), maps[turn])
        scored = model.transform(rows.where(F.col("_fold") == fold))
        if not binary:
            return judge.evaluate(scored)
        area = roc_auc_binary(scored, LABEL, vector_to_array(F.col("rawPrediction"))[1], 1.0).first()["auc"]
        # A fold of one class has no area; the evaluator says what stands for it.
        return judge.evaluate(scored) if area is None else area

    try:
        held = {r["_fold"] for r in rows.select("_fold").distinct().collect()}
        if len(held) < max(folds, 2):
            raise ValueError(f"there are rows in {len(held)} of {folds} folds only")
        with ThreadPoolExecutor(parallelism) as pool:
            found = list(pool.map(inheritable_thread_target(train.sparkSession)(tried), [(f, m) for f in range(folds) for m in range(len(maps))]))
        # One row per fold, one column per parameter set.
        averages = np.array(found).reshape(folds, len(maps)).mean(axis=0)
        best = estimator.fit(rows, maps[int(np.argmax(averages))])
    finally:
        rows.unpersist()
    table = train.sparkSession.createDataFrame(
        [({p.name: str(v) for p, v in m.items()}, float(s)) for m, s in zip(maps, averages)],
        "hiperparameters map<string,string>, metric double",
    ).orderBy(F.desc("metric"))
    return table, PipelineModel([*prepare.stages[:-1], best])


def fit_final(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    estimator: Estimator,
    encode: dict[str, str] | None = None,
    partitions: int | None = None,
) -> tuple[PipelineModel, list[str]]:
    """Refit features and model on the whole training table: the pipeline and its labels."""
    estimator = estimator.copy({estimator.labelCol: LABEL, estimator.featuresCol: FEATURES})
    prepared = Pipeline(stages=[*feature_stages(train, features, encode), label_stage(label)]).fit(train)
    # Read once per iteration of the fit.
    rows = spread(prepared.transform(train).select(FEATURES, LABEL), partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = estimator.fit(rows)
    finally:
        rows.unpersist()
    return PipelineModel([*prepared.stages[:-1], fitted]), list(prepared.stages[-1].labels)


def guard_targets(tables: dict[str, DataFrame], target: str) -> None:
    """Raise if the target is missing as a column or has missing values."""
    bad = [r["table"] for r in target_nulls(tables, target).collect() if not r["passed"]]
    if bad:
        raise ValueError(f"target column {target!r} has missing values in: {', '.join(sorted(bad))}")


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance of every input of a tree model: ``feature``, ``importance``. One row per input."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    values = list(model.stages[-1].featureImportances)
    names: list[str] = []
    sizes = {
        name: size
        for s in model.stages if isinstance(s, OneHotEncoderModel)
        for name, size in zip(s.getOutputCols(), s.categorySizes)
    }
    slots = {s.getOutputCol(): s.getNumFeatures() for s in model.stages if isinstance(s, FeatureHasher)}
    for name in assembler.getInputCols():
        # The encoder leaves out the last of its categories; a hashed column has one name per slot.
        width = sizes[name] - 1 if name in sizes else slots.get(name)
        names += [name] if width is None else [f"{name}_{i}" for i in range(width)]
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))
