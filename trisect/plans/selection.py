"""The selection job: stored tables in, ranking, model and parameters out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trisect.operators.features import project
from trisect.plans.search import SEARCH_BUDGET_S, SEARCH_FAMILIES, Candidate, SearchResult, guard_targets, search_models
from trisect.sources.tables import read_artifact, read_metadata, write_artifact, write_model

RANKING_NAME = "model_ranking"
MODEL_NAME = "selected_model"
PARAMS_NAME = "selected_model_params"


def run_selection(
    spark: SparkSession,
    root: str,
    train: tuple[str, str],
    test: tuple[str, str],
    metadata: tuple[str, str],
    version: str,
    candidates: Sequence[Candidate] = SEARCH_FAMILIES,
    budget_s: float | None = SEARCH_BUDGET_S,
    encode: dict[str, str] | None = None,
    partitions: int | None = None,
    parallelism: int = 1,
) -> SearchResult:
    """Load, check, search, store.

    ``train``, ``test`` and ``metadata`` are (name, version) of artifacts below ``root``; the
    metadata table has one row with a JSON text column ``document`` (keys ``target``, ``all``).
    Writes the ranking, the model and its parameters under ``version``. The other arguments are those of ``search_models``;
    what the budget left out is in the result's ``skipped``.
    """
    for name, value in {"root": root, "train": train, "test": test, "metadata": metadata, "version": version}.items():
        if not value:
            raise ValueError(f"missing parameter {name!r}")
    described = read_metadata(read_artifact(spark, root, *metadata), "document").first()
    if described is None or described["target"] is None:
        raise ValueError("the metadata names no target")
    target, features = described["target"], described["features"]
    tables = {"train": read_artifact(spark, root, *train), "test": read_artifact(spark, root, *test)}
    guard_targets(tables, target)
    chosen = {name: project(df, features, target) for name, df in tables.items()}
    result = search_models(
        chosen["train"], chosen["test"], features, target, candidates,
        budget_s=budget_s, encode=encode, partitions=partitions, parallelism=parallelism,
    )
    write_artifact(result.ranking, root, RANKING_NAME, version)
    if result.best_model is not None:
        write_model(result.best_model, root, MODEL_NAME, version)
        write_artifact(_params_table(spark, result), root, PARAMS_NAME, version)
    return result


def _params_table(spark: SparkSession, result: SearchResult) -> DataFrame:
    row = (result.best_name, {k: str(v) for k, v in result.best_params.items()}, result.labels)
    return spark.createDataFrame([row], "estimator_name string, hiperparameters map<string,string>, labels array<string>")
