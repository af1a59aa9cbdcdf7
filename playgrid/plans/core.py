"""Core marts: player dimension (M-08) and daily active users (M-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playgrid.functions.cols import (country_name, field, field_raw, float_or_null_comma, int_or_null, json_fields,
                                     money_part, money_sum, money_total, safe_div)
from playgrid.operators.rel import first_known, first_part, last_known, last_part
from playgrid.sources.tables import deal


def dim_players(final_events: DataFrame, campaign: DataFrame, rows: int = 0) -> DataFrame:
    """M-08: one row per player - activity span, last/first known attributes, LTV.

    Reads only the JSON paths it needs from the deduplicated log (one parse a row), aggregates
    per player, day and session and then per player (the active days are a set, at most one entry
    for each calendar day), then joins the campaign bridge on player_id. Aggregates of strings sort
    their rows; with ``rows`` (how many the log has, at most) both steps sort a bounded number in
    each task, and a player's many events are spread over the days by the first.
    """
    keys = ["country", "version", "abVersion", "chapter", "revenue", "type"]
    p = F.col("_p")
    is_rev = F.col("name") == "revenue"
    is_purchase, is_reward = (is_rev & (field(p, "type") == x) for x in ("purchase", "ad_reward"))
    ev = deal(final_events.select("*", json_fields(keys).alias("_p")).select(
        "player_id", "event_at", F.to_date("event_at").alias("event_date"), "session_id", "id",
        field(p, "country").alias("country"),
        field(p, "version").alias("app_version"),
        field(p, "abVersion").alias("ab_version"),
        int_or_null(field_raw(p, "chapter")).alias("chapter"),
        F.when(is_rev, float_or_null_comma(field_raw(p, "revenue"))).alias("revenue"),
        is_purchase.alias("is_purchase"), is_reward.alias("is_reward")), rows, "player_id", "event_date")
    order = F.struct("event_at", "id")
    last = {c: last_part(c, order).alias(f"last_{c}") for c in ("country", "app_version", "ab_version", "chapter")}
    first = {c: first_part(c, order).alias(f"first_{c}") for c in ("app_version", "country")}
    parts = ev.groupBy("player_id", "event_date", "session_id").agg(
        F.min("event_at").alias("first_at"), F.max("event_at").alias("last_at"), *last.values(), *first.values(),
        F.count(F.lit(1)).alias("events"), money_part("revenue").alias("revenue"),
        F.count_if("is_purchase").alias("purchases"), F.count_if("is_reward").alias("rewards"),
        F.bool_or("is_purchase").alias("is_payer"))
    known_last = lambda c: last_known(F.col(f"last_{c}.value"), F.col(f"last_{c}.at"))
    known_first = lambda c: first_known(F.col(f"first_{c}.value"), F.col(f"first_{c}.at"))
    agg = deal(parts, rows, "player_id").groupBy("player_id").agg(
        F.min("first_at").alias("first_seen_at"),
        F.max("last_at").alias("last_seen_at"),
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.size(F.collect_set("event_date")).alias("active_days"),
        known_last("country").alias("country"),
        known_last("app_version").alias("app_version"),
        known_last("ab_version").alias("ab_version"),
        known_last("chapter").alias("current_chapter"),
        known_first("app_version").alias("first_app_version"),
        known_first("country").alias("first_country"),
        F.sum("events").alias("total_events"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.round(money_total("revenue"), 4).alias("ltv"),
        F.sum("purchases").alias("purchases_count"),
        F.sum("rewards").alias("ad_rewards_count"),
        F.bool_or("is_payer").alias("is_payer"))
    c = campaign.select("player_id", "campaign_name", "install_country",
                        F.col("platform").alias("install_platform"),
                        F.col("first_version").alias("install_version"), "install_date", "is_test_profile")
    return agg.join(c, "player_id", "left").select(
        "player_id", "first_seen_at", "last_seen_at", "first_seen_date", "last_seen_date",
        F.datediff("last_seen_date", "first_seen_date").alias("lifespan_days"), "active_days",
        "country", country_name("country").alias("country_name"),
        "app_version", "ab_version", "current_chapter", "first_app_version", "first_country",
        "total_events", "total_sessions", "ltv", "purchases_count", "ad_rewards_count", "is_payer",
        F.coalesce("campaign_name", F.lit("(unknown)")).alias("marketing_campaign"),
        "install_country", "install_platform", "install_version", "install_date",
        F.coalesce("is_test_profile", F.lit(False)).alias("is_test_profile"))


def daily_active_users(stg: DataFrame, dim: DataFrame) -> DataFrame:
    """M-09: DAU, new / returning users, sessions, raw-unit revenue and ARPDAU per day.

    Events are first reduced to (day, player, session) rows; players are then
    counted from (day, player) rows and sessions from (day, session) rows, so no
    distinct aggregate copies the rows.
    """
    pds = stg.groupBy("event_date", "player_id", "session_id").agg(
        money_sum(F.when(F.col("event_name") == "revenue", F.col("revenue_amount"))).alias("rev"))
    sessions = pds.filter(F.col("session_id").isNotNull()).join(dim.select("player_id"), "player_id", "left_semi").select("event_date", "session_id").distinct().groupBy("event_date").agg(F.count(F.lit(1)).alias("sessions"))
    players = pds.groupBy("event_date", "player_id").agg(money_sum("rev").alias("rev")).join(
        dim.select("player_id", "first_seen_date"), "player_id")
    daily = players.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("dau"),
        F.count_if(F.col("event_date") == F.col("first_seen_date")).alias("new_users"),
        F.count_if(F.col("event_date") > F.col("first_seen_date")).alias("returning_users"),
        money_sum("rev").alias("rev"))
    return daily.join(sessions, "event_date", "left").select(
        "event_date", "dau", "new_users", "returning_users", F.coalesce("sessions", F.lit(0)).alias("sessions"),
        F.round("rev", 4).alias("revenue"), F.round(safe_div("rev", "dau"), 4).alias("arpdau"))


def activity_windows(activity: DataFrame, days: int = 30, week: int = 7) -> DataFrame:
    """T-09: DAU / WAU / MAU per active day from player-day activity.

    A player counts in the windows that end from an active day until before the next one, or until the window's
    length is over: one step up and one down for each player-day. The steps are summed by day and then run up over
    the days, one row for each calendar day that has any.
    """
    following = F.lead("event_date").over(Window.partitionBy("player_id").orderBy("event_date"))
    pd = activity.select("player_id", "event_date").distinct().withColumn("_next", following)
    ends = [F.least(F.date_add("event_date", n), F.col("_next")) for n in (days, week)]
    one, none = F.lit(1), F.lit(0)
    steps = F.array(F.struct(F.col("event_date").alias("day"), one.alias("dau"), one.alias("wau"), one.alias("mau")),
                    F.struct(ends[1].alias("day"), none.alias("dau"), (-one).alias("wau"), none.alias("mau")),
                    F.struct(ends[0].alias("day"), none.alias("dau"), none.alias("wau"), (-one).alias("mau")))
    daily = pd.select(F.inline(steps)).groupBy("day").agg(*(F.sum(c).alias(c) for c in ("dau", "wau", "mau")))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (daily.withColumns({c: F.sum(c).over(upto) for c in ("wau", "mau")}).filter("dau > 0")
            .select(F.col("day").alias("event_date"), "dau", "wau", "mau"))


SKETCH_BITS = 14  # a standard error of 1.04 / 2^(14 / 2), about 0.8 %
SKETCH_ERROR = 0.05  # six standard errors


def day_sketches(activity: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """A-08: one mergeable sketch of the players of each day (at most 2^bits bytes a day, whatever the players)."""
    return activity.groupBy("event_date").agg(F.hll_sketch_agg("player_id", F.lit(bits)).alias("players"))


def approx_windows(sketches: DataFrame, days: int = 30, week: int = 7) -> DataFrame:
    """Approximate DAU / WAU / MAU as unions of the days' sketches, never of their players."""
    fan = sketches.select("players", "event_date", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("lag"))
    fan = fan.withColumn("to", F.date_add("event_date", "lag"))
    estimate = lambda n: F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("lag") < n, F.col("players"))))
    return (fan.groupBy(F.col("to").alias("event_date")).agg(
        estimate(1).alias("dau"), estimate(week).alias("wau"), estimate(days).alias("mau"),
        F.count_if(F.col("lag") == 0).alias("_active")).filter("_active > 0").drop("_active"))
