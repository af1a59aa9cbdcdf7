"""Query registrations: loads into an existing target (K-04 .. K-07, K-09, K-12).

Each query first brings a target into an older state, from the inputs as they were some days before (a part of
the later rows already there, another part late), then runs the load on all inputs and returns the target.
"""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from playgrid.operators import loads
from playgrid.params import param
from playgrid.plans import bi, finance, staging
from playgrid.plans.registry import Ctx, query
from playgrid.session import checkpoint_dir
from playgrid.sources import ingest

STATE_DAYS = 3


def _target(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/targets/{name}-{uuid.uuid4().hex[:12]}"


def _last_day(events):
    return events.agg(F.max("event_date")).first()[0]


def earlier_log(events, last):
    """The raw log as it was three days before its end; some rows of its last two days had not come yet."""
    day = F.col("event_date")
    end = last - dt.timedelta(days=STATE_DAYS)
    late = (day >= F.lit(end - dt.timedelta(days=1))) & (F.col("seq") % 7 == 0)
    return events.filter((day <= F.lit(end)) & ~late)


def _since(events, since):
    """The log from a day on: the day is in the log's key, so no version of a key is cut off."""
    return events if since is None else events.filter(F.col("event_date") >= F.lit(since))


def economy_rows(c: Ctx, events):
    return lambda since: finance.fct_economy(staging.stg_events(staging.events_final(_since(events, since))), c.campaign())


def balance_rows(events):
    return lambda since: finance.currency_balance_daily(finance.balance_snapshots(staging.events_final(_since(events, since))))


@query("economy_incremental")
def q_economy_incremental(spark, sf):
    c, path = Ctx(spark, sf), _target(spark, "economy")
    events = c.inp("events")
    for log in (earlier_log(events, _last_day(events)), events):
        loads.load_trailing(spark, path, economy_rows(c, log), ["event_id", "currency"],
                            days=param(spark, "trailing_days"), sort_by=["currency"])
    return loads.existing(spark, path)


@query("balance_incremental")
def q_balance_incremental(spark, sf):
    """An empty target gets the last two days only; history is the backfill's."""
    c, path = Ctx(spark, sf), _target(spark, "balance")
    events = c.inp("events")
    last = _last_day(events)
    if last is None:
        return balance_rows(events)(None)
    first = last - dt.timedelta(days=STATE_DAYS - 1 + 2)  # two days before the day of the first load
    for log in (earlier_log(events, last), events):
        loads.load_trailing(spark, path, balance_rows(log), ["currency"],
                            days=param(spark, "trailing_days"), first_day=first)
    return loads.existing(spark, path)


@query("balance_backfill")
def q_balance_backfill(spark, sf):
    """One calendar month recomputed in a target that holds an older state of it."""
    path, events = _target(spark, "balance-history"), Ctx(spark, sf).inp("events")
    month = param(spark, "backfill_from"), param(spark, "backfill_to")
    last = _last_day(events)
    if last is not None:
        loads.put(balance_rows(earlier_log(events, last))(None), path, ["event_date"])
    rows = finance.balance_backfill(staging.events_final(events), *map(str, month))
    loads.replace_range(path, rows, *month)
    got = loads.existing(spark, path)
    return rows if got is None else got.filter(F.col("event_date").between(*map(F.lit, month)))


@query("conversions_upsert")
def q_conversions_upsert(spark, sf):
    """Half of the records first, then the re-read of the trailing days, twice."""
    path, pages = _target(spark, "conversions"), ingest.api_conversions(spark, sf)
    updated = F.try_to_timestamp(F.get_json_object("body", "$.updated_at"), F.lit("yyyy-MM-dd HH:mm:ss"))
    pages = pages.withColumn("at", updated)
    since = pages.agg(F.max("at")).scalar() - F.make_interval(days=F.lit(param(spark, "reread_days")))
    again = pages.filter(F.col("at") >= since)
    for fetch in (pages.filter("pos % 2 = 0"), again, again):
        loads.upsert(path, ingest.conversions(fetch.drop("at")), ["conversion_id"])
    return loads.upserted(spark, path)


@query("rates_upsert")
def q_rates_upsert(spark, sf):
    """Rate documents in the order of their fetches, and an old one once more."""
    path, docs = _target(spark, "rates"), ingest.api_rate_docs(spark, sf)
    first = F.hour("fetched_at") == 0
    for fetch in (docs.filter(first), docs.filter(~first), docs.filter(first)):
        loads.upsert(path, ingest.currency_rates_etl(fetch), ["business_date", "base_currency", "target_currency"],
                     version=["update_at"], buckets=8)
    return loads.upserted(spark, path)


@query("level_events_by_month")
def q_level_events_by_month(spark, sf):
    c, path = Ctx(spark, sf, single=True), _target(spark, "levels")
    rows = bi.fct_level_events(c.final(), c.campaign())
    loads.put(loads.by_month(rows), path, ["yyyymm"], ["event_date", "chapter_key", "player_id", "event_at"], mode="static")
    return rows if (got := loads.existing(spark, path)) is None else got
