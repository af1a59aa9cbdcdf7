"""Driver tables -> reference-shaped inputs.

The marts are defined over a game event log with a JSON payload, raw JSON
dumps of profiles / accounts / store transactions, a versioned rate table, a
seed of manual purchases and a user-properties table. The driver ships
TPC-H-like tables plus an ``events`` table, so each reference input is derived
here from them with deterministic expressions (the DuckDB oracle repeats the
same derivation in SQL, see ``playgrid.oracle.base``). Work grows with the
driver tables: every derived view is a projection / aggregation over them.

Derivation of the game event log (``game_events``): each driver event feeds
three event families through one scan (``explode`` of a 3-element literal
array, no self-union, no re-scan):

  family a: purchase/click -> 'revenue' (purchase / ad_reward), view ->
            'resource_top_up', error -> 'resource_consume', signup -> 'session_end'
            (k even) / 'pause' (k odd)
  family b: level play: view/signup -> 'story_start', click/purchase ->
            'chapter_fight_summary', error -> 'chapter_finish'
  family c: clans: signup -> 'clan_join' ('clan_creation' for k % 10 = 0),
            purchase -> 'clan_raid_fight', click -> 'clan_role_change',
            error -> 'clan_kick', view -> 'clan_lvl_up'

with ``k = props.k``, ``player_id = 'p' || user_id``, one session per player-day
and the dedup key ``id = family || user || type || day`` so that the raw log
really carries duplicate versions (the latest ``received_at`` wins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playgrid.sources.tables import read, spread

# Store SKUs carry a package prefix that the marts strip; the driver data uses
# this neutral prefix (the pattern is a parameter of the IAP pipeline).
SKU_PREFIX = "com.example.game."
SKU_PREFIX_RE = r"^com[.]example[.]game[.]"
CLAN_START_DATE = "2024-01-03"
REPORT_COUNTRIES = ("US", "PH")


# ----------------------------------------------------------- JSON text build
def _q(key: str, v: Column) -> Column:
    """"key":"v" (NULL when v is NULL, so the key is left out)."""
    return F.concat(F.lit(f'"{key}":"'), v, F.lit('"'))


def _n(key: str, v: Column) -> Column:
    """"key":v (raw JSON number / object)."""
    return F.concat(F.lit(f'"{key}":'), v.cast("string"))


def _obj(*entries: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *entries), F.lit("}"))


def _case(x: Column, mapping: dict, default=None) -> Column:
    out = None
    for key, val in mapping.items():
        out = F.when(x == key, F.lit(val)) if out is None else out.when(x == key, F.lit(val))
    return out.otherwise(F.lit(default)) if default is not None else out


def _s(x) -> Column:
    return (F.lit(x) if not isinstance(x, Column) else x).cast("string")


# ------------------------------------------------------------- event log
FAMILIES = ("a", "b", "c")


def game_event_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of ``game_events``, from the footers of the files."""
    return read(spark, sf_dir, "events").count() * len(FAMILIES)


def game_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw game event log (duplicates included), reference ``events`` shape."""
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    ev = spread(ev, "event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    b = ev.select(
        "event_id", "ts", "value", F.col("event_type").alias("t"), F.col("user_id").alias("u"),
        k.alias("k"), F.date_format("ts", "yyyyMMdd").alias("ymd"),
        F.explode(F.array(*map(F.lit, FAMILIES))).alias("fam"))
    t, u, kk, fam = F.col("t"), F.col("u"), F.col("k"), F.col("fam")
    pid = F.concat(F.lit("p"), _s(u))

    country = _case(u % 5, {0: "US", 1: "PH", 2: "GB", 3: "DE"}, "")
    version = F.when(kk % 10 == 0, F.lit("1.0.9")).otherwise(F.concat(F.lit("1.0."), _s(kk % 10 + 20)))
    ab = F.when(kk % 2 == 0, F.lit("A")).otherwise(F.lit("B"))
    dsr = F.when(kk % 40 == 39, F.lit("n/a")).otherwise(_s(kk % 40))
    is_test = F.when(kk % 50 == 49, F.lit('"isTest":"true"'))
    common = [_q("country", country), _q("version", version), _q("abVersion", ab),
              _q("daysSinceRegistration", dsr), is_test]

    value_s = _s(F.col("value"))
    spend_src = _case(kk % 8, {0: "Revive", 1: "Pets", 2: "ShopPacks", 3: "Roulette",
                               4: "DailyBenefits", 5: "ChapterRewards", 6: "Cheats"}, "Mystery")
    placement = _case(kk % 5, {0: "revive", 1: "double_reward", 2: "free_chest", 3: "energy"},
                      "shop_refresh")
    sku = _case(kk % 5, {0: "gems_small", 1: "gems_big", 2: "battle_pass", 3: "chapter_pack"})
    # family a: monetization and economy
    a_props = (
        F.when(t == "purchase", _obj(
            *common, _n("chapter", kk % 12), _n("allChapterTries", kk % 20),
            _q("revenue", F.when(kk % 10 == 3, F.replace(value_s, F.lit("."), F.lit(",")))
               .otherwise(value_s)),
            _q("type", F.lit("purchase")),
            _q("currency", _case(kk % 4, {0: "USD", 1: "PHP", 2: "EUR"})),
            _q("source", F.lit("shop")),
            _q("purchase_id", F.concat(F.lit(SKU_PREFIX), sku))))
        .when(t == "click", _obj(
            *common, _n("chapter", kk % 12),
            _q("revenue", value_s), _q("type", F.lit("ad_reward")), _q("currency", F.lit("USD")),
            _q("source", placement)))
        .when(t == "view", _obj(
            *common, _n("chapter", kk % 12),
            _n("Currency_Gems", kk), _n("Chests_Common", kk % 3), _n("CurrencyX", F.lit(1)),
            F.when(kk % 7 == 0, F.lit('"Currency_Dust":1.5')),
            F.concat(F.lit('"balanceSnapshot":{"Gems":'), _s(kk), F.lit(',"Gold":'), _s(kk * 10),
                     F.lit("}")),
            _q("source", spend_src)))
        .when(t == "error", _obj(
            *common, _n("chapter", kk % 12),
            _n("Currency_Gems", -(kk % 30)), _n("Currency_Gold", -kk), _q("source", spend_src)))
        .otherwise(_obj(*common)))
    a_name = (F.when(t.isin("purchase", "click"), F.lit("revenue"))
              .when(t == "view", F.lit("resource_top_up"))
              .when(t == "error", F.lit("resource_consume"))
              .when(kk % 2 == 0, F.lit("session_end")).otherwise(F.lit("pause")))

    # family b: level play
    star = _case(kk % 4, {0: '"isStarMode":"true"', 1: '"IsStarMode":"True"', 2: '"isStarMode":"false"'})
    b_props = _obj(
        *common, F.when(kk % 25 != 24, _n("chapter", kk % 12)), _q("locale", F.lit("en")),
        _n("allChapterTries", kk % 20), star,
        _q("IsWin", _case(kk % 3, {0: "True", 1: "False"}, "maybe")),
        _q("runId", F.concat(F.lit("r"), _s(F.col("event_id")))),
        _n("chapterRunNumber", kk % 5), _n("BattlesCount", kk % 7),
        _q("AvgRounds", F.concat(_s(kk % 9), F.lit(".5"))), _n("AvgHpPercent", kk),
        _n("energy_spend", F.lit(5)), _n("playerPower", kk * 100))
    b_name = (F.when(t.isin("view", "signup"), F.lit("story_start"))
              .when(t == "error", F.lit("chapter_finish")).otherwise(F.lit("chapter_fight_summary")))

    # family c: clans
    roles = {0: "member", 1: "officer", 2: "leader"}
    stats = F.when(kk % 9 != 0, F.concat(
        F.lit('"Stats":"{\\"CURRENT_HP\\":'), _s(kk * 10),
        F.lit(',\\"MAX_HP\\":'), _s(F.when(kk % 11 == 0, F.lit(0)).otherwise(F.lit(1000))),
        F.lit('}"')))
    c_props = _obj(
        *common,
        _q("clanId", F.when(kk % 33 == 32, F.lit("")).otherwise(F.concat(F.lit("c"), _s(kk % 6)))),
        _q("clanName", F.concat(F.lit("Clan "), _s(kk % 6))),
        F.when(t == "signup", _q("joinMethod", F.when(kk % 2 == 0, F.lit("invite")).otherwise(F.lit("search")))),
        F.when(t == "signup", _n("memberCountAfterJoin", kk % 30)),
        F.when(t == "error", _q("kickUserId", F.concat(F.lit("p"), _s(u + kk % 3)))),
        F.when(t == "click", _q("changeUserId", F.concat(F.lit("p"), _s(u + kk % 2)))),
        F.when(t == "click", _q("oldRole", _case(kk % 3, roles))),
        F.when(t == "click", _q("newRole", _case((kk + 1) % 3, roles))),
        F.when(t == "view", _n("newLevel", kk % 10 + 1)),
        F.when(t == "purchase", _n("bossTier", kk % 5 + 1)),
        F.when(t == "purchase", _q("IsWin", F.when(kk % 2 == 0, F.lit("True")).otherwise(F.lit("False")))),
        F.when(t == "purchase", _n("HpPercent", kk + 1)),
        F.when(t == "purchase", _n("Rounds", kk % 8)),
        F.when(t == "purchase", stats))
    c_name = (F.when((t == "signup") & (kk % 10 == 0), F.lit("clan_creation"))
              .when(t == "signup", F.lit("clan_join"))
              .when(t == "purchase", F.lit("clan_raid_fight"))
              .when(t == "click", F.lit("clan_role_change"))
              .when(t == "error", F.lit("clan_kick")).otherwise(F.lit("clan_lvl_up")))

    return b.select(
        F.concat(fam, _s(u), F.lit("_"), t, F.lit("_"), F.col("ymd")).alias("id"),
        F.when(fam == "a", a_name).when(fam == "b", b_name).otherwise(c_name).alias("name"),
        pid.alias("player_id"),
        F.concat(pid, F.lit("_"), F.col("ymd")).alias("session_id"),
        F.concat(F.lit("c"), _s(u), F.lit("_"), F.col("ymd")).alias("client_session_id"),
        F.col("ts").alias("event_at"),
        F.to_date("ts").alias("event_date"),
        F.when(t == "signup", F.lit("server")).otherwise(F.lit("client")).alias("source"),
        F.when(fam == "a", a_props).when(fam == "b", b_props).otherwise(c_props).alias("properties"),
        F.lit("{}").alias("context"),
        # arrivals lag by up to four days, so the last version of a key need not be the latest event
        (F.col("ts") + F.make_interval(hours=(F.col("event_id") * 7 % 96).cast("int"))).alias("received_at"),
        (F.col("ts") + F.make_interval(hours=(F.col("event_id") * 7 % 96).cast("int"), mins=F.lit(1))).alias("ingested_at"),
        F.col("event_id").alias("seq"),
    )


# --------------------------------------------------------- raw JSON dumps
def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player profile dump: one JSON document per row in ``data``."""
    cu = read(spark, sf_dir, "customer").select("c_custkey")
    ck = F.col("c_custkey")
    data = _obj(
        _q("id", F.when(ck % 50 == 7, F.lit("")).otherwise(F.concat(F.lit("p"), _s(ck)))),
        _q("userId", F.concat(F.lit("u"), _s(ck))),
        F.concat(F.lit('"isTest":'), F.when(ck % 40 == 3, F.lit("true")).otherwise(F.lit("false"))),
        _q("serverId", F.concat(F.lit("s"), _s(ck % 3))))
    return cu.select(data.alias("data"))


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account dump (campaign, install profile, device JSON nested as text)."""
    cu = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    na = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ck = F.col("c_custkey")
    brand = _case(ck % 4, {0: "samsung", 1: "Xiaomi", 2: "Google"}, "Apple")
    os_ = F.when(ck % 2 == 0, F.concat(F.lit("iOS 17."), _s(ck % 5))).otherwise(
        F.concat(F.lit("Android OS 1"), _s(ck % 5), F.lit(" / API-3"), _s(ck % 5), F.lit(" (build)")))
    device = F.concat(F.lit('"deviceInfo":"{\\"model\\":\\"'), brand, F.lit(" M"), _s(ck % 100),
                      F.lit('\\",\\"os\\":\\"'), os_, F.lit('\\"}"'))
    data = _obj(
        _q("id", F.concat(F.lit("u"), _s(ck))),
        _q("campaignName", F.when(ck % 11 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))),
        _q("externalId", F.concat(F.lit("x"), _s(ck))),
        _q("appsFlyerId", F.concat(F.lit("af"), _s(ck))),
        _q("country", F.col("n_name")),
        _q("platform", F.when(ck % 2 == 0, F.lit("ios")).otherwise(F.lit("android"))),
        _q("firstVersion", F.concat(F.lit("1.0."), _s(ck % 10 + 20))),
        _q("createdAt", F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (ck % 30).cast("int")),
                                               "yyyy-MM-dd"), F.lit("T08:00:00Z"))),
        F.when(ck % 13 != 0, device))
    # accounts for every 9th customer are missing (profile without account)
    return (cu.filter(ck % 9 != 0).join(na, cu.c_nationkey == na.n_nationkey, "left")
            .select(data.alias("data")))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store transaction dump derived from ``orders`` (purchases start 2024-01-12)."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderdate", "o_orderpriority")
    o = spread(o, "o_orderkey")
    ok = F.col("o_orderkey")
    day = F.date_add(F.lit("2024-01-12").cast("date"),
                     (F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")) % 30).cast("int"))
    occurred = F.when(ok % 23 == 0, F.lit("not a time")).otherwise(
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), F.lpad(_s(ok % 24), 2, "0"), F.lit(":15:00Z")))
    product = F.concat(F.lit(SKU_PREFIX),
                       F.lower(F.replace(F.substring("o_orderpriority", 3, 20), F.lit(" "), F.lit("_"))))
    data = _obj(
        _q("id", F.concat(F.lit("t"), _s(ok))),
        _q("profileId", F.concat(F.lit("p"), _s(F.col("o_custkey")))),
        _q("occurredAt", occurred),
        F.when(ok % 17 != 0, _n("usdAmount", F.floor(F.col("o_totalprice") / 100) / 100.0)),
        _q("productId", product),
        _q("type", F.when(ok % 10 == 1, F.lit("SUBSCRIPTION")).otherwise(F.lit("IAP"))),
        _q("status", F.when(F.col("o_orderstatus") == "P", F.lit("PENDING")).otherwise(F.lit("RECORDED"))))
    return o.select(data.alias("data"))


# ---------------------------------------------------------------- rates
def currency_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned EUR-based rate table (business_date, target) x update_at.

    Days 2024-01-05 .. 2024-01-30, currencies USD/PHP/EUR/GBP, three versions
    per key (update_at hour 0/1/2). No USD row on 2024-01-20, GBP rate 0 on 2024-01-10.
    """
    o = read(spark, sf_dir, "orders").select("o_orderkey")
    ok = F.col("o_orderkey")
    di = (ok % 26).cast("int")
    cur = _case((ok / 26).cast("bigint") % 4, {0: "USD", 1: "PHP", 2: "EUR"}, "GBP")
    version = (ok % 3).cast("int")
    g = o.select(di.alias("di"), cur.alias("target_currency"), version.alias("ver"))
    g = g.groupBy("di", "target_currency", "ver").agg(F.count(F.lit(1)).alias("n"))
    d = F.date_add(F.lit("2024-01-05").cast("date"), F.col("di"))
    base = (F.when(F.col("target_currency") == "USD", F.lit(1.08) + F.col("di") * 0.001)
            .when(F.col("target_currency") == "PHP", F.lit(60.0) + F.col("di") * 0.1)
            .when(F.col("target_currency") == "EUR", F.lit(1.0))
            .otherwise(F.lit(0.85) + F.col("di") * 0.001))
    rate = F.when((F.col("target_currency") == "GBP") & (F.col("di") == 5), F.lit(0.0)).otherwise(
        base * (F.lit(1.0) + F.col("ver") / 100.0))
    out = g.select(
        d.alias("business_date"), F.lit("EUR").alias("base_currency"), "target_currency",
        rate.alias("rate"),
        (F.to_timestamp(d) + F.make_interval(hours=F.col("ver"))).alias("update_at"))
    return out.filter(~((F.col("target_currency") == "USD") & (F.col("business_date") == F.lit("2024-01-20").cast("date"))))


def iap_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual purchase backfill seed (player_id, event_date, revenue_amount)."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                            "o_orderstatus", "o_orderpriority")
    o = o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    rows = o.select(
        F.concat(F.lit("p"), _s(F.col("o_custkey"))).alias("player_id"),
        F.date_add(F.lit("2024-01-02").cast("date"), (F.col("o_orderkey") % 10).cast("int")).alias("event_date"),
        (F.floor(F.col("o_totalprice") / 1000) / 100.0).alias("revenue_amount"))
    # the seed is a CSV file with declared column types: lay it down, read it back typed
    import uuid

    from playgrid.session import checkpoint_dir
    from playgrid.sources.files import SEED_SCHEMAS, read_seed_csv, write_seed_csv
    path = f"{checkpoint_dir(spark).rstrip('/')}/seeds/iap_backfill-{uuid.uuid4().hex[:12]}"
    return read_seed_csv(spark, write_seed_csv(rows, path), SEED_SCHEMAS["iap_backfill"])


def user_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User properties history (user_id, props JSON with device_type, updated_at)."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ok = F.col("o_orderkey")
    dev = _case(ok % 4, {0: "phone", 1: "tablet", 2: "desktop"}, "")
    return o.select(
        F.concat(F.lit("p"), _s(F.col("o_custkey"))).alias("user_id"),
        _obj(_q("device_type", dev), _q("os", F.lit("x"))).alias("props"),
        (F.col("o_orderdate") + F.make_interval(secs=(ok % 86400).cast("decimal(18,6)"))).alias("updated_at"))
