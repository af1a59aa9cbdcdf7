"""Cohort marts (M-16 .. M-21): dense install-day grids with running totals.

Scale notes: every event-side input is first reduced to (player, day) rows
(``_player_day``) before it meets the cohort table, so a player with a huge
event count contributes at most 31 rows per cohort join; the grid itself is
bounded by cohorts x 31 days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.functions.cols import monday, money_sum, version_gte
from playgrid.operators.rel import dense_days, running_sum

MIN_VERSION = "1.0.22"
HORIZON = 30


def cohort_players(dim: DataFrame, min_version: str = MIN_VERSION) -> DataFrame:
    """Install cohort per player: install version and first-seen day (scope >= min_version)."""
    return dim.filter(F.col("first_app_version").isNotNull() & version_gte("first_app_version", min_version)) \
        .select("player_id", F.col("first_app_version").alias("cohort_version"),
                F.col("first_seen_date").alias("cohort_date"), "first_country", "marketing_campaign")


def _in_window(day: str) -> Column:
    d = F.datediff(F.col(day), F.col("cohort_date"))
    return (d >= 0) & (d <= HORIZON)


def _activity(stg: DataFrame, coh: DataFrame, keys: Sequence[str]) -> DataFrame:
    pd = stg.groupBy("player_id", "event_date").agg(F.count(F.lit(1)).alias("_n"))
    j = pd.join(coh, "player_id").filter(_in_window("event_date"))
    return (j.groupBy(*keys, F.datediff("event_date", "cohort_date").alias("d"))
            .agg(F.count(F.lit(1)).alias("retained_users")))


def _ad_rev(fct_rev: DataFrame, coh: DataFrame, keys: Sequence[str]) -> DataFrame:
    is_ad = F.col("revenue_type") == "ad_reward"
    pd = fct_rev.groupBy("player_id", "event_date").agg(
        F.sum(F.when(is_ad, F.col("revenue_amount"))).alias("_ad"), F.count_if(is_ad).alias("_imp"))
    j = pd.join(coh, "player_id").filter(_in_window("event_date"))
    return (j.groupBy(*keys, F.datediff("event_date", "cohort_date").alias("d"))
            .agg(F.sum("_ad").alias("ad_revenue"), F.sum("_imp").alias("ad_impressions")))


def _iap_rev(iap: DataFrame, coh: DataFrame, keys: Sequence[str]) -> DataFrame:
    pd = iap.groupBy("player_id", "purchase_date").agg(F.sum("usd_amount").alias("_usd"))
    j = pd.join(coh, "player_id").filter(_in_window("purchase_date"))
    return (j.groupBy(*keys, F.datediff("purchase_date", "cohort_date").alias("d"))
            .agg(F.sum("_usd").alias("iap_revenue")))


def _grid(coh: DataFrame, keys: Sequence[str], as_of) -> DataFrame:
    sizes = coh.groupBy(*keys).agg(F.count(F.lit(1)).alias("cohort_size"))
    return dense_days(sizes, "cohort_date", as_of, HORIZON)


def _age(as_of) -> Column:
    a = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return F.datediff(a, F.col("cohort_date"))


def cohort_daily(dim: DataFrame, stg: DataFrame, fct_rev: DataFrame, iap: DataFrame, as_of,
                 countries: Sequence[str] | None = None) -> DataFrame:
    """M-16 (all players) / M-17 (``countries`` given: by install country).

    Grid: cohort (version[, country], install day) x day 0..min(30, age);
    retention, ad and IAP revenue per day, running sums and per-install ARPU.
    """
    coh = cohort_players(dim)
    keys = ["cohort_version", "cohort_date"]
    vkeys = ["cohort_version"]
    vname = "version_installs"
    if countries is not None:
        coh = coh.filter(F.col("first_country").isin(list(countries))).withColumn("country", F.col("first_country"))
        keys = ["cohort_version", "country", "cohort_date"]
        vkeys = ["cohort_version", "country"]
        vname = "version_country_installs"
    coh = coh.select("player_id", *keys)
    sk = _grid(coh, keys, as_of).withColumnRenamed("day_since_install", "d")
    vsize = coh.groupBy(*vkeys).agg(F.count(F.lit(1)).alias(vname))
    on = keys + ["d"]
    b = (sk.join(_activity(stg, coh, keys), on, "left")
         .join(_ad_rev(fct_rev, coh, keys), on, "left")
         .join(_iap_rev(iap, coh, keys), on, "left")
         .join(vsize, vkeys))
    b = b.select(*keys, F.col("d").cast("int").alias("day_since_install"), "cohort_size", vname,
                 F.coalesce("retained_users", F.lit(0)).alias("retained_users"),
                 F.coalesce("ad_revenue", F.lit(0.0)).alias("ad_revenue"),
                 F.coalesce("ad_impressions", F.lit(0)).alias("ad_impressions"),
                 F.coalesce("iap_revenue", F.lit(0.0)).alias("iap_revenue"))
    b = b.withColumn("total_revenue", F.col("ad_revenue") + F.col("iap_revenue"))
    cum = lambda c: running_sum(c, keys, "day_since_install")
    return b.select(
        *keys[:-1], "cohort_date", monday("cohort_date").alias("cohort_week"), "day_since_install",
        "cohort_size", vname, _age(as_of).alias("cohort_age_days"), "retained_users",
        (F.col("retained_users") / F.col("cohort_size")).alias("retention_rate"),
        "ad_revenue", "ad_impressions", "iap_revenue", "total_revenue",
        cum("ad_revenue").alias("cum_ad_revenue"), cum("iap_revenue").alias("cum_iap_revenue"),
        cum("total_revenue").alias("cum_total_revenue"),
        (cum("ad_revenue") / F.col("cohort_size")).alias("ad_arpu_cum"),
        (cum("total_revenue") / F.col("cohort_size")).alias("arpu_cum"))


def cohort_daily_campaign(dim: DataFrame, fct_rev: DataFrame, iap: DataFrame, as_of,
                          countries: Sequence[str] = ("US", "PH")) -> DataFrame:
    """M-18: revenue grid by (version, country segment, campaign segment, install day).

    Each player is expanded into ALL/own-country x ALL/own-campaign (at most
    4 rows, a constant fan-out); revenue is pre-aggregated per (player, day
    of life) before meeting the segments.
    """
    coh = cohort_players(dim)
    seg = (coh.withColumn("country", F.explode(
                F.when(F.col("first_country").isin(list(countries)),
                       F.array(F.lit("ALL"), F.col("first_country"))).otherwise(F.array(F.lit("ALL")))))
              .withColumn("campaign", F.explode(F.array(F.lit("ALL"), F.col("marketing_campaign"))))
              .select("player_id", "cohort_version", "country", "campaign", "cohort_date"))
    c1 = coh.select("player_id", "cohort_date")
    ad = (fct_rev.filter(F.col("revenue_type") == "ad_reward").join(c1, "player_id")
          .filter(_in_window("event_date"))
          .select("player_id", F.datediff("event_date", "cohort_date").alias("d"),
                  F.col("revenue_amount").alias("ad"), F.lit(0.0).alias("iap"), F.lit(1).alias("imp")))
    ip = (iap.join(c1, "player_id").filter(_in_window("purchase_date"))
          .select("player_id", F.datediff("purchase_date", "cohort_date").alias("d"),
                  F.lit(0.0).alias("ad"), F.col("usd_amount").alias("iap"), F.lit(0).alias("imp")))
    player_day = ad.unionByName(ip).groupBy("player_id", "d").agg(
        F.sum("ad").alias("ad_revenue"), F.sum("iap").alias("iap_revenue"), F.sum("imp").alias("ad_impressions"))
    keys = ["cohort_version", "country", "campaign", "cohort_date"]
    rev = seg.join(player_day, "player_id").groupBy(*keys, "d").agg(
        F.sum("ad_revenue").alias("ad_revenue"), F.sum("iap_revenue").alias("iap_revenue"),
        F.sum("ad_impressions").alias("ad_impressions"))
    sk = _grid(seg, keys, as_of).withColumnRenamed("day_since_install", "d")
    b = sk.join(rev, keys + ["d"], "left").select(
        *keys, F.col("d").cast("int").alias("day_since_install"), "cohort_size",
        F.coalesce("ad_revenue", F.lit(0.0)).alias("ad_revenue"),
        F.coalesce("ad_impressions", F.lit(0)).alias("ad_impressions"),
        F.coalesce("iap_revenue", F.lit(0.0)).alias("iap_revenue"))
    b = b.withColumn("total_revenue", F.col("ad_revenue") + F.col("iap_revenue"))
    cum = lambda c: running_sum(c, keys, "day_since_install")
    return b.select(
        *keys, "day_since_install", "cohort_size", _age(as_of).alias("cohort_age_days"),
        "ad_revenue", "ad_impressions", "iap_revenue", "total_revenue",
        cum("ad_revenue").alias("cum_ad_revenue"), cum("iap_revenue").alias("cum_iap_revenue"),
        cum("total_revenue").alias("cum_total_revenue"),
        (cum("total_revenue") / F.col("cohort_size")).alias("arpu_cum"))


def _pu_players(dim: DataFrame) -> DataFrame:
    return cohort_players(dim).select(
        "player_id", F.coalesce("first_country", F.lit("(unknown)")).alias("country"),
        "cohort_version", "cohort_date")


def cohort_pu(dim: DataFrame, store: DataFrame, as_of, horizons: Sequence[int] = (0, 1, 3, 7)) -> DataFrame:
    """M-19: paying users and IAP USD within days 0..k of install, per cohort.

    Computed per player first (first purchase day and windowed sums: one row
    per player, co-partitioned with the join on player_id), then summed per
    cohort - no multi-distinct Expand.
    """
    p = _pu_players(dim)
    pur = store.groupBy("player_id", "purchase_date").agg(money_sum("usd_amount").alias("usd"))
    j = p.join(pur, "player_id", "left").withColumn("d", F.datediff("purchase_date", "cohort_date"))
    per = j.groupBy("player_id", "country", "cohort_version", "cohort_date").agg(
        F.min(F.when(F.col("d") >= 0, F.col("d"))).alias("fpd"),
        *[money_sum(F.when(F.col("d").between(0, k), F.col("usd"))).alias(f"u{k}") for k in horizons])
    keys = ["cohort_version", "country", "cohort_date"]
    age = _age(as_of)
    return per.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("installs"),
        *[F.count_if(F.col("fpd") <= k).alias(f"pu_d{k}") for k in horizons],
        *[F.round(F.coalesce(money_sum(f"u{k}"), F.lit(0.0)), 2).alias(f"iap_usd_d{k}") for k in horizons],
    ).select(*keys, age.alias("cohort_age_days"), "installs",
             *[f"pu_d{k}" for k in horizons], *[f"iap_usd_d{k}" for k in horizons],
             (age >= 4).cast("int").alias("d3_closed"), (age >= 8).cast("int").alias("d7_closed"))


def cohort_pu_daily(dim: DataFrame, store: DataFrame, as_of) -> DataFrame:
    """M-20: paying-user triangle - new payers by first purchase day, cumulative PU and USD."""
    p = _pu_players(dim)
    keys = ["cohort_version", "country", "cohort_date"]
    pur = (store.groupBy("player_id", "purchase_date").agg(F.sum("usd_amount").alias("usd"))
           .join(p, "player_id").withColumn("d", F.datediff("purchase_date", "cohort_date"))
           .filter(F.col("d").between(0, HORIZON)))
    first_pay = pur.groupBy(*keys, "player_id").agg(F.min("d").alias("d"))
    new_by_day = first_pay.groupBy(*keys, "d").agg(F.count(F.lit(1)).alias("new_payers"))
    rev_by_day = pur.groupBy(*keys, "d").agg(F.sum("usd").alias("iap_usd"))
    sk = _grid(p, keys, as_of).withColumnRenamed("day_since_install", "d")
    b = (sk.join(new_by_day, keys + ["d"], "left").join(rev_by_day, keys + ["d"], "left")
         .select(*keys, F.col("d").cast("int").alias("day_since_install"), "cohort_size",
                 F.coalesce("new_payers", F.lit(0)).alias("new_payers"),
                 F.coalesce("iap_usd", F.lit(0.0)).alias("iap_usd")))
    cum = lambda c: running_sum(c, keys, "day_since_install")
    return b.select(
        *keys, "day_since_install", "cohort_size", _age(as_of).alias("cohort_age_days"), "new_payers",
        cum("new_payers").alias("pu_cum"), (cum("new_payers") / F.col("cohort_size")).alias("pu_rate_cum"),
        "iap_usd", cum("iap_usd").alias("iap_usd_cum"),
        (cum("iap_usd") / F.col("cohort_size")).alias("iap_arpu_cum"))


def forecast_input(campaign_grid: DataFrame, min_installs: int = 20, origin: str = "2024-01-01") -> DataFrame:
    """M-21: maturity-adjusted cumulative ARPU per segment and day of life, min sample applied."""
    seg = campaign_grid.groupBy("cohort_version", "country", "campaign", "day_since_install").agg(
        F.sum("cohort_size").alias("installs"),
        (F.sum("cum_ad_revenue") / F.sum("cohort_size")).alias("cum_ad_arpu"),
        (F.sum("cum_total_revenue") / F.sum("cohort_size")).alias("cum_arpu"))
    return seg.filter(F.col("installs") >= min_installs).select(
        "cohort_version", "country", "campaign", "day_since_install",
        F.date_add(F.lit(origin).cast("date"), F.col("day_since_install")).alias("ds"),
        "installs", "cum_ad_arpu", "cum_arpu")
