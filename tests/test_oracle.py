"""Every query with a SQL twin gives the same rows, values and types as DuckDB."""

import pytest

import check
from tabflow.plans.catalogue import CATALOGUE


@pytest.fixture(scope="module")
def twin(smoke):
    return check.oracle(smoke)


# A hundred boosted trees, or all points of a search space: `check.py` compares these.
SLOW = {
    "fit_gbt", "compare_models", "score_batch_saved", "tune_grid_trials", "tune_random", "tune_cv_grid_forest",
    "tune_cv_grid_boosting",
}


@pytest.mark.parametrize("name", [n for n, q in CATALOGUE.items() if q.sql and n not in SLOW])
def test_query_matches_sql(spark, smoke, twin, name):
    verdict, _ = check.compare(spark, twin, name, smoke)
    assert verdict.startswith("ok"), verdict


@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(SLOW))
def test_slow_query_matches_sql(spark, smoke, twin, name):
    verdict, _ = check.compare(spark, twin, name, smoke)
    assert verdict.startswith("ok"), verdict


def test_entry_runs(spark):
    import __spark_entry__

    frame = __spark_entry__.entry(spark)
    columns = ["split", "c_custkey", "churned", "tenure_code", "segment_index", "charges", "total_spend"]
    assert frame.columns == columns
    assert frame.count() > 0
