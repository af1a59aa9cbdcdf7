"""Relational operators: last version, last known value, dense grid, as-of lookup (N-3, N-9, J-08)."""

import datetime as dt

from pyspark.sql import functions as F

from playgrid.operators import rel


def test_latest_version_both_methods_agree(spark):
    df = spark.createDataFrame([("k1", 1, "a"), ("k1", 3, "c"), ("k1", 2, "b"), ("k2", 1, "z")],
                               "k string, v int, x string")
    for m in ("agg", "window"):
        got = {r.k: r.x for r in rel.latest_version(df, ["k"], ["v"], method=m).collect()}
        assert got == {"k1": "c", "k2": "z"}


def test_last_known_skips_null_values(spark):
    # N-3: the last event often carries no country; the last *known* one wins
    df = spark.createDataFrame([("p", 1, "US"), ("p", 2, "PH"), ("p", 3, None)], "p string, t int, c string")
    r = df.groupBy("p").agg(rel.last_known("c", "t").alias("last"), rel.first_known("c", "t").alias("first")).first()
    assert (r.last, r.first) == ("PH", "US")


def test_dense_days_bounded_and_no_grid_for_future(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 29),), (dt.date(2024, 3, 1),)], "d date")
    g = rel.dense_days(df, "d", "2024-01-31")
    counts = {r.d: r["count"] for r in g.groupBy("d").count().collect()}
    assert counts == {dt.date(2024, 1, 1): 31, dt.date(2024, 1, 29): 3}   # N-9: no wrap for future starts


def test_asof_lookup_fallbacks(spark):
    rates = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "PHP", 0.02), (dt.date(2024, 1, 8), "PHP", 0.03)],
        "business_date date, currency string, usd_per_unit double")
    ev = spark.createDataFrame(
        [("before", "PHP", dt.date(2024, 1, 1)), ("between", "PHP", dt.date(2024, 1, 7)),
         ("on", "PHP", dt.date(2024, 1, 8)), ("after", "PHP", dt.date(2024, 2, 1)),
         ("norate", "EUR", dt.date(2024, 1, 7)), ("nullcur", None, dt.date(2024, 1, 7))],
        "id string, currency string, d date")
    got = {r.id: (r.rate_le, r.rate0) for r in rel.asof_lookup(ev, rates, "currency", "d").collect()}
    assert got["before"] == (None, 0.02)
    assert got["between"] == (0.02, 0.02)
    assert got["on"] == (0.03, 0.02)
    assert got["after"] == (0.03, 0.02)
    assert got["norate"] == (None, None) and got["nullcur"] == (None, None)
