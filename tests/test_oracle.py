"""Every registered query with an oracle agrees with DuckDB on the smallest data set."""

import pytest

import __spark_entry__ as E
from storemart.plans.compare import compare, duckdb_connection

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    return duckdb_connection(SF_SMALL)


# Minutes each: every model family's whole grid, and the load of all months.  Their parts have tests of their own
# (test_histogram_trees, test_ml, test_drift_counts, test_warehouse); scripts/check_oracle.py runs them.
SLOW = {"scored_drift", "monthly_load_replay"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    res = compare(QUERIES[name](spark, SF_SMALL).toPandas(), duck.execute(ORACLES[name]).fetchdf())
    assert res["ok"], res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "next_period_net_sales" in df.columns


def test_every_query_has_oracle_or_is_listed_rows_only():
    rows_only = {q for q in set(QUERIES) - set(ORACLES) if not q.startswith("op") and q != "pipeline"}
    assert rows_only <= {"linear_forecast", "ridge_forecast", "forest_forecast", "boosting_forecast", "tree_attribution", "forest_attribution",
                         "reduced_boosting_forecast", "reduced_forest_forecast", "model_comparison", "runs_table", "best_run",
                         "ab_scored_log", "scored_log_summary"}
