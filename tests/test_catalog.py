import pytest
from compare import differences, oracle_connection
from conftest import SF

import __spark_entry__ as entry
from trisect.catalog.oracle import ORACLE
from trisect.catalog.queries import QUERIES

# Searches and fits are covered by test_search.
FITTED = {
    "model_search", "model_search_f1", "model_ranking", "best_model", "selection_job", "hyperparam_search",
    "halving_search", "feature_reduction", "final_model", "batch_score", "compare_models", "feature_importance", "model_interpretation", "extra_trees",
}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_query_but_the_fitted_ones_has_a_twin():
    assert set(QUERIES) - set(ORACLE) == FITTED and not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in FITTED])
def test_query_equals_its_twin(spark, oracle, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), oracle.sql(ORACLE[name]).df()) is None


def test_entry_offers_the_catalog():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
