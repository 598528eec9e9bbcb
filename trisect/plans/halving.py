"""Model search under a budget of rows: successive halving over nested hash samples.

All parameter sets are fitted on a small sample, the best of them on one ``eta`` times as large, and so on, until the last are fitted on
all rows. The budget is the number of rows that all fits read together, so the same search gives the same result on any machine. A hash of the
row key decides which rows are in a sample; a smaller sample is part of every larger one.

Rows with the same key are in the same samples. Equal metrics keep the earlier parameter set; the first of every family comes
before the second of any. A parameter set that fails is reported and leaves its place to the next.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from trisect.functions.keys import hash_number, row_hash
from trisect.operators.checks import check_not_empty, check_target_exists
from trisect.plans.search import (
    FEATURES,
    LABEL,
    METRICS,
    Candidate,
    SearchResult,
    best_model,
    feature_stages,
    label_stage,
    metric_value,
    rank_models,
    spread,
)

HASHES = 1 << 32
RUNGS = (
    "rung int, share double, rows long, estimator_name string, hiperparameters map<string,string>, metric double, kept boolean"
)


@dataclass(frozen=True)
class Rung:
    """A round of the search: ``configs`` parameter sets are fitted on ``share`` of the rows."""

    share: float
    configs: int


def plan_rungs(n_rows: int, n_configs: int, budget_rows: int, eta: int = 3, least_rows: int = 1000) -> list[Rung]:
    """The fewest rungs that keep within the budget; parameter sets are left out from the end if no number of rungs does.

    No sample is planned smaller than ``least_rows``. One parameter set is always fitted on all rows.
    """
    if eta < 2 or n_rows < 1 or n_configs < 1:
        raise ValueError("eta must be 2 or more, and there must be rows and parameter sets")
    while True:
        for last in range(math.ceil(math.log(n_configs, eta) - 1e-9) + 1):
            if last and n_rows / eta**last < least_rows:
                break
            rungs = [Rung(float(eta) ** (r - last), math.ceil(n_configs / eta**r)) for r in range(last + 1)]
            if sum(r.configs * math.ceil(r.share * n_rows) for r in rungs) <= budget_rows:
                return rungs
        if n_configs == 1:
            return [Rung(1.0, 1)]
        n_configs -= 1


def in_sample(key: Sequence[str], share: float) -> Column:
    """Whether a row is in the sample of a share of the rows."""
    return hash_number(row_hash(key)) < math.ceil(share * HASHES)


def rung_sizes(df: DataFrame, key: Sequence[str], rungs: Sequence[Rung]) -> DataFrame:
    """Rows in each rung's sample, counted in one pass: ``rung, share, configs, rows``."""
    counts = df.select(hash_number(row_hash(key)).alias("at")).agg(*[
        F.count_if(F.col("at") < math.ceil(r.share * HASHES)).alias(f"n{i}") for i, r in enumerate(rungs)
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("rung"), F.lit(r.share).alias("share"), F.lit(r.configs).alias("configs"), F.col(f"n{i}").alias("rows")
        )
        for i, r in enumerate(rungs)
    ])))


def _halton(i: int, base: int) -> float:
    value, scale = 0.0, 1.0
    while i:
        scale /= base
        i, digit = divmod(i, base)
        value += digit * scale
    return value


# One prime base per parameter of a space.
BASES = (2, 3, 5, 7, 11, 13, 17, 19)


def spread_grid(candidate: Candidate, space: dict[str, tuple | list], count: int) -> Candidate:
    """The candidate with ``count`` parameter sets spread evenly over a space, the same ones every time.

    A list is a choice, (low, high) a range of whole numbers if both are whole, else of doubles, and (low, high, "log") a range
    in equal ratios. The parameters of the candidate's first set that the space does not name stay.
    """
    if len(space) > len(BASES):
        raise ValueError(f"a space has at most {len(BASES)} parameters")

    def value(kind, at: float):
        if isinstance(kind, list):
            return kind[int(at * len(kind))]
        low, high = kind[:2]
        if len(kind) == 3:
            return low * (high / low) ** at
        return low + int(at * (high - low + 1)) if isinstance(low, int) and isinstance(high, int) else low + at * (high - low)

    fixed = candidate.grid[0] if candidate.grid else {}
    grid = tuple(
        {**fixed, **{name: value(kind, _halton(i + 1, BASES[b])) for b, (name, kind) in enumerate(space.items())}}
        for i in range(count)
    )
    return replace(candidate, grid=grid)


def _better_first(tried: list[tuple]) -> list[tuple]:
    """Parameter sets by falling metric; no metric comes last, equal ones stay in their order."""
    return sorted(tried, key=lambda t: (t[1] is None, -(t[1] or 0.0), t[0]))


def search_halving(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    candidates: Sequence[Candidate],
    budget_rows: int,
    eta: int = 3,
    least_rows: int = 1000,
    metric: str | None = None,
    encode: dict[str, str] | None = None,
    partitions: int | None = None,
    parallelism: int = 1,
) -> tuple[SearchResult, DataFrame]:
    """Search by successive halving: the result, and a table of every fit (``RUNGS``).

    Features are prepared on all of ``train`` and every fit is scored on all of ``valid``, so the ranking, which holds the families
    among the last parameter sets, is that of ``search_models`` for these. ``parallelism`` fits of a rung run at once; they do not
    see each other. What the budget left out is in ``skipped``.
    """
    if metric is not None and metric not in METRICS:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}")
    check_target_exists({"train": train, "valid": valid}, label)
    check_not_empty(train, "train")
    check_not_empty(valid, "valid")
    spark = train.sparkSession
    turns = range(max((len(c.grid) for c in candidates), default=0))
    configs = [(c, c.grid[t]) for t in turns for c in candidates if t < len(c.grid)]
    if not configs:
        raise ValueError("there is no parameter set to try")
    prepared = Pipeline(stages=[*feature_stages(train, features, encode), label_stage(label)]).fit(train)
    labels = list(prepared.stages[-1].labels)
    n_classes = len(labels)
    metric = metric or ("roc_auc" if n_classes == 2 else "roc_auc_ovr")

    def ready(rows: DataFrame) -> DataFrame:
        return spread(prepared.transform(rows).select(FEATURES, LABEL), partitions).persist(StorageLevel.MEMORY_AND_DISK)

    rungs = plan_rungs(train.count(), len(configs), budget_rows, eta, least_rows)
    skipped = [(c.name, p) for c, p in configs[rungs[0].configs :]]
    alive = list(range(rungs[0].configs))
    judge, failures, log, final = ready(valid), {}, [], {}
    n_features = len(judge.first()[FEATURES])
    try:
        for number, rung in enumerate(rungs):
            sample = ready(train if rung.share == 1.0 else train.where(in_sample(key, rung.share)))
            n_rows = sample.count()

            def fit(i: int, sample=sample):
                candidate, params = configs[i]
                try:
                    model = candidate.make(n_classes, n_features, params).fit(sample)
                    return i, metric_value(model.transform(judge), metric, n_classes), model
                except Exception as error:  # reported, and the search goes on
                    failures[candidate.name] = str(error)
                    return i, None, None

            with ThreadPoolExecutor(parallelism) as pool:
                tried = list(pool.map(inheritable_thread_target(spark)(fit), alive))
            worked = _better_first([t for t in tried if t[2] is not None])
            room = rungs[number + 1].configs if number + 1 < len(rungs) else len(worked)
            alive = sorted(t[0] for t in worked[:room])
            for i, value, _ in tried:
                candidate, params = configs[i]
                shown = {k: str(v) for k, v in params.items()}
                log.append((number, rung.share, n_rows, candidate.name, shown, value, i in alive))
            if number + 1 == len(rungs):
                for i, value, model in worked:
                    name, params = configs[i][0].name, configs[i][1]
                    if name not in final:
                        train_value = metric_value(model.transform(sample), metric, n_classes)
                        final[name] = (train_value, value, params, model)
            sample.unpersist()
    finally:
        judge.unpersist()
    records = [(n, on_train, value, {k: str(v) for k, v in p.items()}) for n, (on_train, value, p, _) in final.items()]
    result = SearchResult(labels, metric, rank_models(spark, records), failures=failures, skipped=skipped)
    top = best_model(result.ranking).first()
    if top:
        result.best_name = top["estimator_name"]
        _, _, result.best_params, fitted = final[result.best_name]
        result.best_model = PipelineModel([*prepared.stages[:-1], fitted])
    return result, spark.createDataFrame(log, RUNGS)
