"""Staging and intermediate layer (M-01 .. M-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playgrid.functions.cols import (field, field_raw, float_or_null, float_or_null_comma, int_or_null,
                                     json_fields, prop, prop_raw, ts_or_null)
from playgrid.operators.rel import asof_lookup, latest_version
from playgrid.sources import adapters as A
from playgrid.sources.tables import ROWS_PER_SORT, deal

EVENT_KEY = ["event_date", "name", "player_id", "id"]


def events_final(raw: DataFrame, rows: int = 0) -> DataFrame:
    """FINAL read of the event log: last ``received_at`` per (event_date, name, player_id, id).

    The key contains ``event_date`` (the physical partition column), so the
    dedup is partition-local when the log is laid out by day. With ``rows`` (how
    many the raw log has) each task sorts a bounded number of the wide rows. A
    player's rows of a day lie in one task and file (only a day beyond that bound
    makes a larger task): what they repeat of each other is compressed in the
    shuffle, and readers that count by player, day or session reduce them before
    their own. Rows without a player, day or id are dealt by the whole key.
    """
    if rows <= ROWS_PER_SORT:
        return latest_version(raw, EVENT_KEY, ["received_at", "seq"], method="window")
    odd = (F.coalesce("player_id", F.lit("")) == "") | F.col("event_date").isNull() | F.col("id").isNull()
    raw = raw.withColumns({f"_{c}": F.when(odd, F.col(c)) for c in ("name", "id")})
    dealt = deal(raw, rows, "event_date", "_name", "player_id", "_id")
    return latest_version(dealt, [*EVENT_KEY, "_name", "_id"], ["received_at", "seq"], method="window").drop("_name", "_id")


def stg_events(final_events: DataFrame) -> DataFrame:
    """M-01: deduplicated events (``events_final``) with the common payload fields typed.

    The payload is parsed once per row (``json_fields``) and every typed
    column reads the parsed struct.
    """
    keys = ["country", "version", "abVersion", "chapter", "daysSinceRegistration", "allChapterTries",
            "revenue", "type", "currency", "source"]
    e = final_events.select("*", json_fields(keys).alias("_p"))
    p = F.col("_p")
    return e.select(
        "id", F.col("name").alias("event_name"), "player_id", "session_id", "client_session_id",
        "event_at", F.to_date("event_at").alias("event_date"), F.col("source").alias("event_source"),
        field(p, "country").alias("country"),
        field(p, "version").alias("app_version"),
        field(p, "abVersion").alias("ab_version"),
        field(p, "chapter").alias("chapter_raw"),
        int_or_null(field_raw(p, "daysSinceRegistration")).alias("days_since_registration"),
        int_or_null(field_raw(p, "allChapterTries")).alias("all_chapter_tries"),
        float_or_null_comma(field_raw(p, "revenue")).alias("revenue_amount"),
        field(p, "type").alias("revenue_type"),
        field(p, "currency").alias("revenue_currency"),
        field(p, "source").alias("action_source"),
        "properties", "context", "received_at", "ingested_at")


def int_revenue(stg: DataFrame) -> DataFrame:
    """M-02: one row per payment event (ad_reward or purchase) with a parsed amount."""
    return (stg.filter((F.col("event_name") == "revenue") & F.col("revenue_amount").isNotNull())
            .select(F.col("id").alias("event_id"), "player_id", "session_id", "event_at", "event_date",
                    "country", "app_version", "ab_version", "revenue_type",
                    F.col("action_source").alias("revenue_source"), "revenue_currency", "revenue_amount"))


def int_economy(stg: DataFrame) -> DataFrame:
    """M-03: economy events unpivoted to one row per touched currency.

    Top-level ``Currency_*`` / ``Chests_*`` keys are balance deltas; values that
    are not integers are skipped (the nested ``balanceSnapshot`` is not a delta).
    """
    e = stg.filter(F.col("event_name").isin("resource_top_up", "resource_consume"))
    kv = e.select("*", F.explode(F.from_json("properties", "map<string,string>")).alias("k", "v"))
    kv = kv.filter(F.expr("k LIKE 'Currency@_%' ESCAPE '@' OR k LIKE 'Chests@_%' ESCAPE '@'"))
    kv = kv.withColumn("delta", int_or_null("v", "bigint")).filter(F.col("delta").isNotNull())
    return kv.select(
        F.col("id").alias("event_id"), "player_id", "session_id", "event_at", "event_date",
        "event_name", "country", "ab_version", F.col("action_source").alias("flow_source"),
        F.col("k").alias("currency"), "delta",
        F.when(F.col("delta") >= 0, "in").otherwise("out").alias("direction"),
        F.abs("delta").alias("amount"))


def rates_usd(rates: DataFrame) -> DataFrame:
    """M-04: USD per unit of each currency by date (latest rate version wins)."""
    dedup = rates.groupBy("business_date", "target_currency").agg(
        F.max_by("rate", "update_at").alias("rate"))
    usd = dedup.filter(F.col("target_currency") == "USD").select(
        "business_date", F.col("rate").alias("eur_to_usd"))
    return (dedup.join(usd, "business_date").filter(F.col("rate") > 0)
            .select("business_date", F.col("target_currency").alias("currency"),
                    (F.col("eur_to_usd") / F.col("rate")).alias("usd_per_unit")))


def player_campaign(profiles: DataFrame, accounts: DataFrame) -> DataFrame:
    """M-05: player -> account bridge with campaign, install and device attributes."""
    d = F.col("data")
    pp = profiles.select(
        prop_raw("id", d).alias("player_id"),
        prop_raw("userId", d).alias("user_id"),
        (F.lower(prop_raw("isTest", d)) == "true").alias("is_test_profile"),
        prop("serverId", d).alias("server_id")).filter(F.col("player_id") != "")
    dev = prop_raw("deviceInfo", d)
    usr = accounts.select(
        prop_raw("id", d).alias("user_id"),
        prop("campaignName", d).alias("campaign_name"),
        prop("externalId", d).alias("external_id"),
        prop("appsFlyerId", d).alias("appsflyer_id"),
        prop("country", d).alias("install_country"),
        prop("platform", d).alias("platform"),
        prop("firstVersion", d).alias("first_version"),
        ts_or_null(prop_raw("createdAt", d)).alias("user_created_at"),
        prop("model", dev).alias("device_model"),
        prop("os", dev).alias("device_os"))
    os_ = F.coalesce(F.col("device_os"), F.lit(""))
    return pp.join(usr, "user_id", "left").select(
        "player_id", "user_id", "is_test_profile", "server_id", "campaign_name", "external_id",
        "appsflyer_id", "install_country", "platform", "first_version",
        F.to_date("user_created_at").alias("install_date"),
        "device_model",
        F.nullif(F.split_part(F.coalesce(F.col("device_model"), F.lit("")), F.lit(" "), F.lit(1)),
                 F.lit("")).alias("device_brand"),
        "device_os",
        F.nullif(F.regexp_extract(os_, r"^([A-Za-z]+)", 1), F.lit("")).alias("os_name"),
        F.nullif(F.regexp_extract(os_, r"([0-9]+(?:[.][0-9]+)*)", 1), F.lit("")).alias("os_version"),
        int_or_null(F.regexp_extract(os_, r"API-([0-9]+)", 1)).alias("os_api_level"))


def store_transactions(tx: DataFrame) -> DataFrame:
    """Recorded IAP store transactions (authoritative USD amounts)."""
    d = F.col("_d")
    keys = ["type", "status", "profileId", "occurredAt", "usdAmount", "productId"]
    return (tx.select(json_fields(keys, "data").alias("_d"))
            .filter((field_raw(d, "type") == "IAP") & (field_raw(d, "status") == "RECORDED"))
            .select(field_raw(d, "profileId").alias("player_id"),
                    F.to_date(ts_or_null(field_raw(d, "occurredAt"))).alias("purchase_date"),
                    F.coalesce(float_or_null(field_raw(d, "usdAmount")), F.lit(0.0)).alias("usd_amount"),
                    field_raw(d, "productId").alias("product_id")))


def iap_usd(final_events: DataFrame, tx: DataFrame, rates_usd_df: DataFrame,
            sku_prefix_re: str = A.SKU_PREFIX_RE) -> DataFrame:
    """M-06: purchases in USD, hybrid by coverage date.

    From the first store-transaction date on, the store is authoritative;
    before it, purchase events are converted with the as-of rate (latest rate
    date <= purchase date, else the earliest rate, else 1.0 for USD).
    """
    mt = store_transactions(tx)
    ev = final_events.filter(
        (F.col("name") == "revenue") & (prop_raw("type") == "purchase"))
    p = F.col("_p")
    ev = ev.select("*", json_fields(["revenue", "currency", "purchase_id"]).alias("_p")).select(
        "id", "player_id", F.col("event_date").alias("purchase_date"),
        float_or_null_comma(field_raw(p, "revenue")).alias("amount"),
        field(p, "currency").alias("currency"),
        field_raw(p, "purchase_id").alias("product_id"))
    # scalar subquery: the store's first covered day
    ev = ev.filter(F.col("purchase_date") < mt.agg(F.min("purchase_date")).scalar())
    ev = asof_lookup(ev, rates_usd_df, "currency", "purchase_date")
    ev_usd = ev.filter(F.col("amount").isNotNull()).select(
        "player_id", "purchase_date", "product_id",
        (F.col("amount") * F.coalesce(F.nullif(F.col("rate_le"), F.lit(0.0)), F.col("rate0"),
                                      F.when(F.col("currency") == "USD", F.lit(1.0)))).alias("usd_amount"))
    u = (mt.filter(F.col("usd_amount").isNotNull()).select("player_id", "purchase_date", "usd_amount", "product_id")
         .unionByName(ev_usd.filter(F.col("usd_amount").isNotNull())
                      .select("player_id", "purchase_date", "usd_amount", "product_id")))
    return u.select("player_id", "purchase_date", "usd_amount",
                    F.when(F.col("product_id") == "", F.lit("(unknown)"))
                    .otherwise(F.regexp_replace("product_id", sku_prefix_re, "")).alias("product"))


# ------------------------------------------------------------ entry points
def load(spark: SparkSession, sf_dir: str) -> dict:
    """Reference-shaped inputs for one scale-factor directory."""
    return {
        "events": A.game_events(spark, sf_dir),
        "profiles": A.raw_profiles(spark, sf_dir),
        "accounts": A.raw_accounts(spark, sf_dir),
        "transactions": A.raw_transactions(spark, sf_dir),
        "rates": A.currency_rates(spark, sf_dir),
        "backfill": A.iap_backfill(spark, sf_dir),
        "user_props": A.user_props(spark, sf_dir),
    }
