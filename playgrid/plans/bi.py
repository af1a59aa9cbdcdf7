"""BI marts: ad placements and segments, activity, ads, gem flows, IAP, revenue by source,
level events and the level funnel (M-24 .. M-33)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgrid.functions.cols import (field, field_raw, float_or_null, float_or_null_comma, int_or_null,
                                     json_fields, lifetime_bucket,
                                     lifetime_order, prop, prop_raw, safe_div, spend_category, version_gte)
from playgrid.operators.rel import last_known

MIN_VERSION = "1.0.22"
FAIL_TRACKING_VERSION = "1.0.28"


def _ads_src(fct_rev: DataFrame, min_version: str) -> DataFrame:
    return fct_rev.filter((F.col("revenue_type") == "ad_reward") & F.col("app_version").isNotNull()
                          & version_gte("app_version", min_version)) \
        .withColumn("placement", F.coalesce("revenue_source", F.lit("(unknown)")))


def ad_placement(fct_rev: DataFrame, by_country: Sequence[str] | None = None,
                 min_version: str = MIN_VERSION) -> DataFrame:
    """M-24 (by version) / M-25 (by version x country): impressions, viewers, revenue, eCPM, shares."""
    src = _ads_src(fct_rev, min_version)
    vkeys = ["app_version"]
    share = "rev_share_in_version"
    if by_country is not None:
        src = (src.withColumn("country", F.coalesce("country", F.lit("(unknown)")))
               .filter(F.col("country").isin(list(by_country))))
        vkeys = ["app_version", "country"]
        share = "rev_share_in_version_country"
    agg = src.groupBy(*vkeys, "placement").agg(
        F.count(F.lit(1)).cast("int").alias("ad_impressions"),
        F.count_distinct("player_id").cast("int").alias("unique_viewers"),
        F.sum("revenue_amount").alias("ad_revenue"))
    ver = agg.groupBy(*vkeys).agg(F.sum("ad_revenue").alias("_v"))
    return agg.join(ver, vkeys).select(
        *vkeys, "placement", "ad_impressions", "unique_viewers", "ad_revenue",
        (safe_div("ad_revenue", "ad_impressions") * 1000).alias("ecpm"),
        safe_div("ad_revenue", "unique_viewers").alias("rev_per_viewer"),
        safe_div("ad_revenue", "_v").alias(share))


def ad_segment(dim: DataFrame, user_props: DataFrame, min_version: str = MIN_VERSION) -> DataFrame:
    """M-26: players / ad viewers / rewards per version x country x device brand.

    The device is the last known non-empty ``device_type`` of the user-props
    history (one row per player after a grouped ``max_by``).
    """
    dt = prop("device_type", "props")
    device = user_props.groupBy(F.col("user_id").alias("player_id")).agg(
        last_known(dt, F.struct("updated_at", dt)).alias("device_type"))
    p = dim.filter(F.col("app_version").isNotNull() & version_gte("app_version", min_version))
    j = p.join(device, "player_id", "left")
    brand = F.when(F.col("device_type").isNull(), F.lit("(unknown)")).otherwise(
        F.split_part("device_type", F.lit(" "), F.lit(1)))
    return j.groupBy("app_version", F.coalesce("country", F.lit("(unknown)")).alias("country"),
                     brand.alias("device_brand")).agg(
        F.count(F.lit(1)).alias("players"),
        F.count_if(F.col("ad_rewards_count") > 0).alias("ad_viewers"),
        F.sum("ad_rewards_count").alias("total_ad_rewards"))


def bi_activity(final_events: DataFrame, dim: DataFrame) -> DataFrame:
    """M-27: one row per active player-day with the day's attributes and lifetime bucket."""
    e = final_events.select(
        F.to_date("event_at").alias("event_date"), "player_id", "event_at", "id",
        int_or_null(prop_raw("daysSinceRegistration")).alias("dsr"),
        prop("version").alias("v"), prop("country").alias("c"))
    order = F.struct("event_at", "id")
    pd = e.groupBy("event_date", "player_id").agg(
        F.max("dsr").alias("dsr"), last_known("v", order).alias("app_version"),
        last_known("c", order).alias("country"))
    dp = dim.select("player_id", "marketing_campaign", F.col("country").alias("dp_country"),
                    F.col("app_version").alias("dp_version"), "install_platform", "install_date",
                    "first_seen_date")
    return pd.join(dp, "player_id", "left").select(
        "event_date", "player_id",
        F.coalesce("marketing_campaign", F.lit("(unknown)")).alias("marketing_campaign"),
        F.coalesce("country", "dp_country", F.lit("(unknown)")).alias("country"),
        F.coalesce("app_version", "dp_version", F.lit("(unknown)")).alias("app_version"),
        F.coalesce("install_platform", F.lit("(unknown)")).alias("install_platform"),
        "install_date",
        lifetime_bucket("dsr").alias("lifetime_bucket"), lifetime_order("dsr").alias("lifetime_order"),
        (F.col("event_date") == F.col("first_seen_date")).alias("is_new_install"))


def _with_campaign(df: DataFrame, campaign: DataFrame) -> DataFrame:
    return df.join(campaign.select("player_id", "campaign_name", "platform", "install_date"), "player_id", "left")


def bi_ads(final_events: DataFrame, campaign: DataFrame) -> DataFrame:
    """M-28: one row per rewarded ad view."""
    e = final_events.filter((F.col("name") == "revenue") & (prop_raw("type") == "ad_reward")).select(
        "player_id", F.to_date("event_at").alias("event_date"),
        float_or_null_comma(prop_raw("revenue")).alias("ad_revenue"),
        int_or_null(prop_raw("daysSinceRegistration")).alias("dsr"),
        prop("version").alias("app_version"), prop("country").alias("country"),
        prop("source").alias("placement"))
    return _with_campaign(e, campaign).select(
        "event_date", "player_id",
        F.coalesce("campaign_name", F.lit("(unknown)")).alias("marketing_campaign"),
        F.coalesce("country", F.lit("(unknown)")).alias("country"),
        F.coalesce("app_version", F.lit("(unknown)")).alias("app_version"),
        F.coalesce("platform", F.lit("(unknown)")).alias("install_platform"), "install_date",
        lifetime_bucket("dsr").alias("lifetime_bucket"), lifetime_order("dsr").alias("lifetime_order"),
        F.coalesce("placement", F.lit("(unknown)")).alias("placement"),
        F.lit(1).alias("ad_view"),
        F.coalesce("ad_revenue", F.lit(0.0)).alias("ad_revenue"))


def bi_gem_flows(final_events: DataFrame, campaign: DataFrame, currency_key: str = "Currency_Gems") -> DataFrame:
    """M-29: one row per economy event that moved Gems (zero deltas dropped)."""
    e = final_events.filter(
        F.col("name").isin("resource_top_up", "resource_consume") & (prop_raw(currency_key) != "")).select(
        "player_id", F.to_date("event_at").alias("event_date"),
        int_or_null(prop_raw(currency_key), "bigint").alias("gem_delta"),
        int_or_null(prop_raw("daysSinceRegistration")).alias("dsr"),
        prop("version").alias("app_version"), prop("country").alias("country"),
        prop("source").alias("raw_source"))
    e = e.filter(F.col("gem_delta").isNotNull() & (F.col("gem_delta") != 0))
    src = F.coalesce("raw_source", F.lit("(unknown)"))
    return _with_campaign(e, campaign).select(
        "event_date", "player_id",
        F.coalesce("campaign_name", F.lit("(unknown)")).alias("marketing_campaign"),
        F.coalesce("country", F.lit("(unknown)")).alias("country"),
        F.coalesce("app_version", F.lit("(unknown)")).alias("app_version"),
        F.coalesce("platform", F.lit("(unknown)")).alias("install_platform"), "install_date",
        lifetime_bucket("dsr").alias("lifetime_bucket"), lifetime_order("dsr").alias("lifetime_order"),
        F.when(F.col("gem_delta") >= 0, "in").otherwise("out").alias("direction"),
        src.alias("gem_source"), spend_category(src).alias("category"),
        F.abs("gem_delta").alias("gems"))


def sku_section(product) -> F.Column:
    """Shop section from the SKU (ordered prefix rules)."""
    p = F.col(product) if isinstance(product, str) else product
    return (F.when(p.like("chapter%"), "ChapterPacks")
            .when(p.like("shoppacks.renewal%"), "RoulettePackShop")
            .when(p.like("shoppacks.%"), "ShopPacks")
            .when(p.like("dailybenefits.%"), "DailyBenefits")
            .when(p == "adfree", "AdFree")
            .when(p == "(unknown)", "(unknown)")
            .otherwise("Other"))


def bi_iap(iap: DataFrame, dim: DataFrame) -> DataFrame:
    """M-30: one row per purchase with lifetime at purchase, shop section and first-purchase flag."""
    i = iap.filter(F.col("usd_amount").isNotNull() & F.col("purchase_date").isNotNull())
    first = i.groupBy("player_id").agg(F.min("purchase_date").alias("first_purchase_date"))
    pl = dim.select("player_id", "marketing_campaign",
                    F.coalesce("country", F.lit("(unknown)")).alias("country"),
                    F.coalesce("app_version", F.lit("(unknown)")).alias("app_version"),
                    F.coalesce("install_platform", F.lit("(unknown)")).alias("install_platform"),
                    "install_date",
                    F.coalesce("install_date", "first_seen_date").alias("install_day"))
    j = i.join(pl, "player_id", "left").join(first, "player_id", "left")
    days = F.datediff("purchase_date", "install_day")
    life = F.when(days.isNotNull(), F.greatest(F.lit(0), days))
    return j.select(
        F.col("purchase_date").alias("event_date"), "player_id",
        F.coalesce("marketing_campaign", F.lit("(unknown)")).alias("marketing_campaign"),
        "country", "app_version", "install_platform", "install_date",
        lifetime_bucket(life).alias("lifetime_bucket"), lifetime_order(life).alias("lifetime_order"),
        "product", sku_section("product").alias("placement"), "usd_amount",
        F.lit(1).alias("purchase_cnt"),
        (F.col("purchase_date") == F.col("first_purchase_date")).alias("is_first_purchase"))


def bi_revenue(ads: DataFrame, iap_rows: DataFrame) -> DataFrame:
    """M-31: USD revenue per day and BI dimensions, Ads vs IAP."""
    dims = ["event_date", "marketing_campaign", "country", "app_version", "install_platform",
            "install_date", "lifetime_bucket"]
    a = ads.groupBy(*dims).agg(F.sum("ad_revenue").alias("revenue_usd")).withColumn("revenue_source", F.lit("Ads"))
    b = iap_rows.groupBy(*dims).agg(F.sum("usd_amount").alias("revenue_usd")).withColumn("revenue_source", F.lit("IAP"))
    return a.unionByName(b).select("event_date", "revenue_source", *dims[1:], "revenue_usd")


# ------------------------------------------------------------ progression
# payload keys read by fct_level_events (one parse per row; the isStarMode /
# IsStarMode case variants are read by path, a struct cannot hold both)
LEVEL_PAYLOAD_KEYS = [
    "isTest", "chapter", "version", "abVersion", "country", "locale", "daysSinceRegistration",
    "allChapterTries", "IsWin", "runId", "chapterRunNumber", "BattlesCount", "AvgRounds",
    "AvgHpPercent", "energy_spend", "playerPower"
]


def fct_level_events(final_events: DataFrame, campaign: DataFrame, min_version: str = MIN_VERSION,
                     fail_version: str = FAIL_TRACKING_VERSION) -> DataFrame:
    """M-32: chapter play events mapped to level_start / level_complete / level_fail."""
    e = (final_events.filter(F.col("name").isin("story_start", "chapter_fight_summary", "chapter_finish"))
         .select("*", json_fields(LEVEL_PAYLOAD_KEYS).alias("_p")))
    p = F.col("_p")
    e = e.filter(field_raw(p, "isTest") != "true")
    ev = e.select(
        F.col("id").alias("event_id"), "event_at", F.to_date("event_at").alias("event_date"),
        F.col("name").alias("source_event"), "player_id",
        int_or_null(field_raw(p, "chapter")).alias("chapter"),
        field(p, "version").alias("app_version"), field(p, "abVersion").alias("ab_version"),
        field(p, "country").alias("country"), field(p, "locale").alias("locale"),
        int_or_null(field_raw(p, "daysSinceRegistration")).alias("days_since_registration"),
        int_or_null(field_raw(p, "allChapterTries")).alias("all_chapter_tries"),
        (F.lower(F.coalesce(prop("isStarMode"), prop("IsStarMode"))) == "true").alias("is_star_mode"),
        F.lower(field_raw(p, "IsWin")).alias("is_win_raw"),
        field(p, "runId").alias("run_id"),
        int_or_null(field_raw(p, "chapterRunNumber")).alias("chapter_run_number"),
        int_or_null(field_raw(p, "BattlesCount")).alias("battles_count"),
        float_or_null(field_raw(p, "AvgRounds")).alias("avg_rounds"),
        float_or_null(field_raw(p, "AvgHpPercent")).alias("avg_hp_percent"),
        int_or_null(field_raw(p, "energy_spend")).alias("energy_spend"),
        float_or_null(field_raw(p, "playerPower")).alias("player_power"))
    ver = F.coalesce("app_version", F.lit(""))
    ev = ev.filter(version_gte(ver, min_version)).withColumn("has_fail_tracking", version_gte(ver, fail_version))
    src, win = F.col("source_event"), F.col("is_win_raw")
    et = (F.when(src == "story_start", "level_start")
          .when((src == "chapter_fight_summary") & (win == "true"), "level_complete")
          .when((src == "chapter_fight_summary") & (win == "false"), "level_fail")
          .when((src == "chapter_finish") & ~F.col("has_fail_tracking"), "level_complete"))
    t = ev.withColumn("event_type", et).filter(F.col("event_type").isNotNull())
    pc = campaign.select("player_id", "install_country", "platform", "device_brand", "device_model",
                         "os_name", "os_version", "os_api_level", "is_test_profile")
    d = F.col("days_since_registration")
    return t.join(pc, "player_id", "left").select(
        "event_id", "event_at", "event_date", "event_type", "source_event", "player_id", "chapter",
        F.coalesce("chapter", F.lit(-1)).alias("chapter_key"), "is_star_mode", "run_id",
        "chapter_run_number", "all_chapter_tries", "battles_count", "avg_rounds", "avg_hp_percent",
        "energy_spend", "player_power", "has_fail_tracking", "days_since_registration",
        lifetime_bucket(d).alias("lifetime_bucket"), lifetime_order(d).alias("lifetime_order"),
        F.coalesce("app_version", F.lit("(unknown)")).alias("app_version"), "ab_version",
        F.coalesce("country", "install_country", F.lit("(unknown)")).alias("country"), "locale",
        F.coalesce("platform", F.lit("(unknown)")).alias("platform"),
        F.coalesce("device_brand", F.lit("(unknown)")).alias("device_brand"),
        F.coalesce("device_model", F.lit("(unknown)")).alias("device_model"),
        F.coalesce("os_name", F.lit("(unknown)")).alias("os_name"),
        "os_version", "os_api_level",
        F.coalesce("is_test_profile", F.lit(False)).alias("is_test_profile"))


FUNNEL_KEYS = ["event_date", "chapter", "chapter_key", "is_star_mode", "app_version", "has_fail_tracking",
               "country", "platform", "os_name", "device_brand", "lifetime_bucket"]


def level_funnel_daily(levels: DataFrame) -> DataFrame:
    """M-33: daily funnel per chapter and segment.

    Player-distinct counts are computed from a per-(segment, player) partial
    aggregate (flags), which replaces Spark's multi-distinct Expand with one
    extra, much smaller, aggregation level.
    """
    t = F.col("event_type")
    is_s, is_c, is_f = t == "level_start", t == "level_complete", t == "level_fail"
    outcome = is_c | is_f
    per = levels.filter(~F.col("is_test_profile")).groupBy(*FUNNEL_KEYS, "player_id").agg(
        F.max("lifetime_order").alias("lo"),
        F.count_if(is_s).alias("s"), F.count_if(is_c).alias("c"), F.count_if(is_f).alias("f"),
        F.sum(F.when(outcome, F.col("battles_count"))).alias("bs"),
        F.count(F.when(outcome, F.col("battles_count"))).alias("bn"),
        F.sum(F.when(is_f, F.col("avg_hp_percent"))).alias("hs"),
        F.count(F.when(is_f, F.col("avg_hp_percent"))).alias("hn"))
    g = per.groupBy(*FUNNEL_KEYS).agg(
        F.max("lo").alias("lifetime_order"),
        F.sum("s").alias("starts"), F.sum("c").alias("completes"), F.sum("f").alias("fails"),
        F.count_if(F.col("s") > 0).alias("start_players"),
        F.count_if(F.col("c") > 0).alias("complete_players"),
        F.count_if(F.col("f") > 0).alias("fail_players"),
        F.sum("bs").alias("bs"), F.sum("bn").alias("bn"), F.sum("hs").alias("hs"), F.sum("hn").alias("hn"))
    hft = F.col("has_fail_tracking")
    s, c, f = F.col("starts"), F.col("completes"), F.col("fails")
    return g.select(
        *FUNNEL_KEYS, "lifetime_order", "starts", "completes", "fails",
        F.when(hft, F.greatest(s - c - f, F.lit(0))).alias("abandons"),
        "start_players", "complete_players", "fail_players",
        F.when(s > 0, F.round(c / s, 4)).alias("complete_rate"),
        F.when(hft & (c + f > 0), F.round(f / (c + f), 4)).alias("fail_rate"),
        safe_div(F.col("bs").cast("double"), "bn").alias("avg_battles"),
        safe_div("hs", "hn").alias("avg_hp_percent_on_fail"))
