"""Every registered query against its DuckDB oracle on the smallest driver tables, plus entry()."""

import pytest

import __spark_entry__ as E
from playgrid.oracle.check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from playgrid.plans import catalog  # noqa: F401
    from playgrid.plans.registry import QUERIES
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(E.queries()[name](spark, SF), ORACLE[name], con)
    assert r["match"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "dau" in df.columns


def test_trend_pandas_equals_builtin(spark):
    from pyspark.sql import functions as F

    from playgrid.plans import cohorts, forecast
    from playgrid.plans.registry import Ctx
    fi = cohorts.forecast_input(Ctx(spark, "/root/testdata/sf0.01").campaign_grid())
    a = forecast.trend_forecast(fi)
    b = forecast.trend_forecast_pandas(fi)
    r = lambda df: sorted((x[0], x[1], x[2], x[3], round(x[4], 6), round(x[5], 6)) for x in df.collect())
    assert r(a) == r(b)
    assert a.filter(F.col("prophet_cum_arpu") < 0).count() == 0
