"""Query registrations: big wins, player lookup, file ledger, quality report (M-43 .. M-47)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgrid.params import param
from playgrid.plans import alerts, bi, finance, quality
from playgrid.plans.q_clans import ClanCtx
from playgrid.plans.registry import Ctx, query
from playgrid.plans.staging import EVENT_KEY


def _big_wins(spark, sf, mode):
    wins = alerts.win_events(spark, sf)
    # look-back window of the check: the last days of arrivals in the data
    since = wins.agg(F.max("created_at")).scalar() - F.make_interval(days=F.lit(param(spark, "alert_lookback_days")))
    if told := param(spark, "alert_since"):
        since = F.lit(told).cast("timestamp_ntz")
    return alerts.big_wins(wins, alerts.providers(spark, sf), alerts.games(spark, sf), alerts.players(spark, sf),
                           alerts.fx_history(spark, sf), alerts.alert_ledger(wins, mode), mode, since,
                           scale=param(spark, "alert_threshold_scale"), fx_customer=param(spark, "fx_customer"),
                           fx_days=param(spark, "fx_lookback_days"))


@query("big_wins_round")
def q_big_wins_round(spark, sf):
    return _big_wins(spark, sf, "round")


@query("big_wins_session")
def q_big_wins_session(spark, sf):
    return _big_wins(spark, sf, "session")


@query("player_lookup")
def q_player_lookup(spark, sf):
    return alerts.player_lookup(alerts.chat_messages(spark, sf), alerts.players(spark, sf))


@query("new_files")
def q_new_files(spark, sf):
    return alerts.new_files(alerts.file_listing(spark, sf), alerts.known_files(spark, sf))


@query("dq_report")
def q_dq_report(spark, sf):
    c = Ctx(spark, sf, single=True)
    return quality.dq_report(c.inp("events"), c.stg(), EVENT_KEY, c.as_of(), c.log_rows())


@query("mart_tests")
def q_mart_tests(spark, sf):
    """The declared column tests of every mart, over marts that share their intermediate tables."""
    c = ClanCtx(spark, sf)
    marts = {
        "dim_players": c.dim, "daily_active_users": c.dau, "fct_revenue": c.rev, "dim_clans": c.build_clans,
        "revenue_daily": lambda: finance.revenue_daily(c.rev(), c.iap(), c.dau()),
        "clan_daily": c.daily, "clan_members": c.members, "clan_raid_fights": c.fights, "clan_raid_tiers": c.tiers,
        "fct_level_events": lambda: bi.fct_level_events(c.final(), c.campaign())}
    return reduce(DataFrame.unionByName, [
        quality.mart_tests(name, marts[name](), *declared) for name, declared in quality.MART_TESTS.items()])
