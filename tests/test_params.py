"""Parameters: defaults, types, and what they change."""

import datetime as dt

import pytest

from playgrid.params import DEFAULTS, param
from playgrid.plans import catalog  # noqa: F401
from playgrid.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def put(spark):
    names = []

    def put(name, value):
        names.append(f"spark.playgrid.{name}")
        spark.conf.set(names[-1], value)
    yield put
    for n in names:
        spark.conf.unset(n)


def test_types(spark, put):
    assert {n: param(spark, n) for n in DEFAULTS} == DEFAULTS
    put("backfill_from", "2024-01-05")
    put("alert_dry_run", "true")
    put("alert_threshold_scale", "0.5")
    put("reread_days", "7")
    assert param(spark, "backfill_from") == dt.date(2024, 1, 5) and param(spark, "alert_dry_run") is True
    assert param(spark, "alert_threshold_scale") == 0.5 and param(spark, "reread_days") == 7
    put("alert_dry_run", "yes")
    with pytest.raises(ValueError):
        param(spark, "alert_dry_run")


def test_dry_run_returns_what_would_be_reported(spark, put):
    put("alert_threshold_scale", "0.2")
    sent = {r.alert_key for r in QUERIES["big_wins_stream"](spark, SF).collect()}
    put("alert_dry_run", "true")
    assert sent and {r.alert_key for r in QUERIES["big_wins_stream"](spark, SF).collect()} == sent


def test_backfill_range(spark, put):
    put("backfill_from", "2024-01-05")
    put("backfill_to", "2024-01-06")
    days = {r.event_date for r in QUERIES["balance_backfill"](spark, SF).collect()}
    assert days == {dt.date(2024, 1, 5), dt.date(2024, 1, 6)}


def test_clan_start_date(spark, put):
    before = QUERIES["clan_members"](spark, SF).count()
    put("clan_start_date", "2024-01-20")
    got = QUERIES["clan_members"](spark, SF)
    assert 0 < got.count() < before and got.agg({"joined_date": "min"}).first()[0] >= dt.date(2024, 1, 20)
