"""Finance marts: revenue and economy facts, balances, revenue by day (M-10 .. M-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playgrid.functions.cols import int_or_null, money_sum, safe_div
from playgrid.operators.rel import asof_lookup, first_rate, grouped_median
from playgrid.plans.staging import int_economy, int_revenue
from playgrid.session import materialize


def fct_revenue(stg: DataFrame, rates_usd: DataFrame, campaign: DataFrame,
                backfill: DataFrame, dim: DataFrame) -> DataFrame:
    """M-10: one row per payment with a USD amount, plus the manual IAP backfill.

    Ad rewards are already USD. Purchases convert with the as-of rate (latest
    rate date <= event date), falling back to the currency's earliest rate and
    to 1.0 for USD / unknown currency.
    """
    ev = int_revenue(stg)
    ev = asof_lookup(ev, rates_usd, "revenue_currency", "event_date", first_out=None)
    cur = F.coalesce(F.col("revenue_currency"), F.lit("USD"))
    fr = first_rate(rates_usd).withColumnRenamed("currency", "_fc")
    ev = ev.join(fr, cur == F.col("_fc"), "left")
    pc = campaign.select("player_id", "campaign_name")
    is_ad = F.col("revenue_type") == "ad_reward"
    usd = F.when(is_ad, F.col("revenue_amount")).otherwise(
        F.col("revenue_amount") * F.coalesce(F.nullif(F.col("rate_le"), F.lit(0.0)), F.col("rate0"),
                                             F.when(cur == "USD", F.lit(1.0))))
    facts = ev.join(pc, "player_id", "left").select(
        "event_id", "player_id", "session_id", "event_at", "event_date", "country", "app_version",
        "ab_version", "revenue_type", "revenue_source",
        F.when(is_ad, F.lit("USD")).otherwise(cur).alias("currency"),
        F.round("revenue_amount", 6).alias("revenue_amount"),
        F.round(usd, 6).alias("revenue_amount_usd"),
        F.coalesce("campaign_name", F.lit("(unknown)")).alias("marketing_campaign"))
    p = dim.select("player_id", "country", "app_version", "ab_version", "marketing_campaign")
    bf = backfill.join(p, "player_id", "left").select(
        F.concat(F.lit("backfill_"), F.col("player_id"), F.lit("_"), F.col("event_date").cast("string")).alias("event_id"),
        "player_id", F.lit("").alias("session_id"),
        F.col("event_date").cast("timestamp").alias("event_at"), "event_date",
        "country", "app_version", "ab_version",
        F.lit("purchase").alias("revenue_type"), F.lit("manual_backfill").alias("revenue_source"),
        F.lit("USD").alias("currency"),
        F.round("revenue_amount", 6).alias("revenue_amount"),
        F.round("revenue_amount", 6).alias("revenue_amount_usd"),
        F.coalesce("marketing_campaign", F.lit("(unknown)")).alias("marketing_campaign"))
    return facts.unionByName(bf)


def fct_economy(stg: DataFrame, campaign: DataFrame) -> DataFrame:
    """M-11: economy flows per (event, currency) with the install campaign.

    ``loads.load_trailing`` re-loads the last days of it from the events of those days.
    """
    e = int_economy(stg)
    return e.join(campaign.select("player_id", "campaign_name"), "player_id", "left").select(
        "event_id", "player_id", "session_id", "event_at", "event_date", "event_name", "country",
        "ab_version", "flow_source", "currency", "direction", "delta", "amount",
        F.coalesce("campaign_name", F.lit("(unknown)")).alias("marketing_campaign"))


def currency_flows_daily(fct_econ: DataFrame) -> DataFrame:
    """M-12: per day and currency - sources, sinks, net flow, events, players."""
    is_in, is_out = F.col("direction") == "in", F.col("direction") == "out"
    return fct_econ.groupBy("event_date", "currency").agg(
        F.coalesce(F.sum(F.when(is_in, F.col("amount"))), F.lit(0)).alias("total_in"),
        F.coalesce(F.sum(F.when(is_out, F.col("amount"))), F.lit(0)).alias("total_out"),
        F.sum("delta").alias("net_flow"),
        F.count_if(is_in).alias("in_events"),
        F.count_if(is_out).alias("out_events"),
        F.count_distinct("player_id").alias("players"))


def balance_snapshots(final_events: DataFrame) -> DataFrame:
    """(event_date, player_id, currency, balance) from ``properties.balanceSnapshot``."""
    e = final_events.select(
        "event_date", "player_id",
        F.get_json_object("properties", "$.balanceSnapshot").alias("snap"))
    e = e.filter(F.col("snap").isNotNull() & (F.col("snap") != ""))
    kv = e.select("event_date", "player_id",
                  F.explode(F.from_json("snap", "map<string,string>")).alias("currency", "v"))
    return (kv.withColumn("balance", int_or_null("v", "bigint")).filter(F.col("balance").isNotNull())
            .drop("v"))


def currency_balance_daily(snapshots: DataFrame) -> DataFrame:
    """M-13: players, average / median / min / max balance per day and currency.

    Snapshots are counted by player and balance first; all measures come of that written table. The median is
    exact and found by rank selection (``grouped_median``), without a buffer of a group's values.
    """
    key = ["event_date", "currency"]
    seen = materialize(snapshots.groupBy(*key, "player_id", "balance").agg(F.count(F.lit(1)).alias("n")), "balances")
    exact = F.col("balance").cast("decimal(38,0)")
    per = seen.groupBy(*key, "player_id").agg(
        F.sum("n").alias("n"), F.sum(exact * F.col("n")).alias("total"),
        F.min("balance").alias("lo"), F.max("balance").alias("hi"))
    out = per.groupBy(*key).agg(
        F.count("player_id").alias("players"),
        F.round(F.sum("total").cast("double") / F.sum("n"), 2).alias("avg_balance"),
        F.min("lo").alias("min_balance"), F.max("hi").alias("max_balance"))
    counts = seen.groupBy(*key, "balance").agg(F.sum("n").alias("n"))
    med = grouped_median(counts, key, "balance", "n", "median_balance")
    med = med.withColumnsRenamed({k: f"_{k}" for k in key})
    same = [out[k].eqNullSafe(F.col(f"_{k}")) for k in key]
    return out.join(med, same[0] & same[1]).select(
        *key, "players", "avg_balance", "median_balance", "min_balance", "max_balance")


def balance_backfill(final_events: DataFrame, d_from: str, d_to: str) -> DataFrame:
    """M-14: the balance mart recomputed for one closed date range (idempotent re-load).

    The range predicate sits on ``event_date`` itself (the partition column),
    so partition pruning applies; ``loads.replace_range`` writes it.
    """
    ev = final_events.filter(F.col("event_date").between(F.lit(d_from).cast("date"), F.lit(d_to).cast("date")))
    return currency_balance_daily(balance_snapshots(ev))


def revenue_daily(fct_rev: DataFrame, iap: DataFrame, dau: DataFrame) -> DataFrame:
    """M-15: USD revenue per day and type: ad rewards from events, purchases from the IAP hybrid."""
    ad = (fct_rev.filter(F.col("revenue_type") == "ad_reward").groupBy("event_date")
          .agg(F.count(F.lit(1)).alias("transactions"), F.count_distinct("player_id").alias("paying_users"),
               money_sum("revenue_amount_usd").alias("revenue"))
          .withColumn("revenue_type", F.lit("ad_reward")))
    ip = (iap.filter(F.col("purchase_date").isNotNull())
          .groupBy(F.col("purchase_date").alias("event_date"))
          .agg(F.count(F.lit(1)).alias("transactions"), F.count_distinct("player_id").alias("paying_users"),
               money_sum("usd_amount").alias("revenue"))
          .withColumn("revenue_type", F.lit("purchase")))
    u = ad.unionByName(ip).join(dau.select("event_date", "dau"), "event_date", "left")
    return u.select(
        "event_date", "revenue_type", "transactions", "paying_users",
        F.round("revenue", 4).alias("revenue"),
        F.round(safe_div("revenue", "transactions"), 6).alias("avg_transaction"),
        "dau",
        F.round(safe_div("revenue", "dau"), 4).alias("arpu"),
        F.round(safe_div("revenue", "paying_users"), 4).alias("arppu"))
