"""Driver contract: entry(), queries() and oracle_sql() against DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from pricelens.plans.registry import all_queries  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

QUERIES = all_queries()  # the optional training-data queries have their own tests
SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns[:5] == ["price_date", "product", "product_name", "product_category", "price_per_gallon"]
    assert df.count() > 0


def test_every_query_has_an_oracle_except_the_models():
    assert set(QUERIES) - set(SQL) == {"forecast_additive", "forecast_aggregated", "forecast_simulated"}
    assert set(SQL) <= set(QUERIES) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    odf = con.execute(SQL[name]).df()
    assert compare(name, sdf, odf) is None


@pytest.mark.parametrize("name", ["forecast_additive", "forecast_aggregated", "forecast_simulated"])
def test_model_query_rows(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    base = QUERIES["forecast_linear_seasonal"](spark, SF_SMALL)
    assert df.count() == base.count() > 0
    assert isinstance(duckdb.__version__, str)
