"""Oracle SQL: BI marts and progression (M-24 .. M-33).

Facts about a player's play are one shape, ``<facts>`` with day, player, lifetime, country and version; what the
player was installed as is looked up beside them (``_with_install``).
"""

from playgrid.functions.cols import SPEND_CATEGORIES
from playgrid.oracle.base import cte
from playgrid.oracle.q_core import known
from playgrid.oracle.sqlfn import FLT, FLTC, INT, LIFETIME_BUCKET, LIFETIME_ORDER, P, PR, RND, VGTE

UNKNOWN = "'(unknown)'"
_DSR = INT(PR("daysSinceRegistration"))


# ------------------------------------------------------------ ad placements
cte("q_ad_shown", f"""
SELECT app_version, coalesce(country, {UNKNOWN}) AS country, coalesce(revenue_source, {UNKNOWN}) AS placement,
       player_id, revenue_amount AS paid
FROM q_fct_revenue WHERE revenue_type = 'ad_reward' AND app_version IS NOT NULL AND {VGTE('app_version', '1.0.22')}
""")


def _placements(keys: str, share: str, only: str = "true") -> str:
    """Placements of each ``keys`` group; the share is of the group's whole."""
    return f"""
SELECT {keys}, placement, CAST(len(who) AS INTEGER) AS ad_impressions, CAST(len(list_distinct(who)) AS INTEGER) AS unique_viewers,
       paid AS ad_revenue, 1000 * paid / len(who) AS ecpm, paid / len(list_distinct(who)) AS rev_per_viewer,
       paid / nullif(sum(paid) OVER (PARTITION BY {keys}), 0) AS {share}
FROM (SELECT {keys}, placement, list(player_id) AS who, sum(paid) AS paid FROM q_ad_shown WHERE {only} GROUP BY {keys}, placement)
"""


cte("q_ad_placement_version", _placements("app_version", "rev_share_in_version"))
cte("q_ad_placement_country", _placements("app_version, country", "rev_share_in_version_country", "country IN ('US', 'PH')"))

cte("q_device", f"""
SELECT player_id, split_part(max(told).device, ' ', 1) AS brand
FROM (SELECT user_id AS player_id, {{'at': updated_at, 'device': {P('device_type', 'props')}}} AS told FROM user_props)
WHERE told.device IS NOT NULL GROUP BY player_id
""")

cte("q_ad_segment", f"""
SELECT app_version, country, device_brand, count(*) AS players, sum(CAST(rewards > 0 AS BIGINT))::BIGINT AS ad_viewers,
       sum(rewards)::BIGINT AS total_ad_rewards
FROM (SELECT app_version, coalesce(country, {UNKNOWN}) AS country, ad_rewards_count AS rewards,
             coalesce((SELECT brand FROM q_device d WHERE d.player_id = p.player_id), {UNKNOWN}) AS device_brand
      FROM q_player p WHERE {VGTE('app_version', '1.0.22')})
GROUP BY app_version, country, device_brand
""")

# ------------------------------------------------- facts beside the install
cte("q_install", """
SELECT player_id, min(campaign_name) AS campaign_name, min(platform) AS platform, min(install_date) AS install_date
FROM q_campaign GROUP BY player_id
""")


def _with_install(facts: str, *more: str) -> str:
    """Rows of ``facts`` (event_date, player_id, dsr, app_version, country) with the player's install and ``more``."""
    return f"""
SELECT f.event_date, f.player_id, coalesce(i.campaign_name, {UNKNOWN}) AS marketing_campaign,
       coalesce(f.country, {UNKNOWN}) AS country, coalesce(f.app_version, {UNKNOWN}) AS app_version,
       coalesce(i.platform, {UNKNOWN}) AS install_platform, i.install_date,
       {LIFETIME_BUCKET('f.dsr')} AS lifetime_bucket, {LIFETIME_ORDER('f.dsr')} AS lifetime_order, {', '.join(more)}
FROM ({facts}) f LEFT JOIN q_install i ON i.player_id = f.player_id
"""


def _facts(names: str, value: str, where: str) -> str:
    return (f"SELECT CAST(event_at AS DATE) AS event_date, player_id, {_DSR} AS dsr, {P('version')} AS app_version, "
            f"{P('country')} AS country, coalesce({P('source')}, {UNKNOWN}) AS source, {value} AS value "
            f"FROM q_final WHERE name IN ({names}) AND {where}")


_THAT_DAY = "a.player_id = p.player_id AND a.event_date = p.event_date"
_ON_DAY = f"""
SELECT p.event_date, p.player_id,
       (SELECT max({INT('a.v')}) FROM q_attr a WHERE {_THAT_DAY} AND a.attr = 'daysSinceRegistration') AS dsr,
       coalesce({known('version', _THAT_DAY)}, w.app_version) AS app_version,
       coalesce({known('country', _THAT_DAY)}, w.country) AS country, p.event_date = w.first_seen_date AS fresh
FROM (SELECT DISTINCT player_id, CAST(event_at AS DATE) AS event_date FROM q_final) p
LEFT JOIN q_player w ON w.player_id = p.player_id
"""

cte("q_bi_activity", _with_install(_ON_DAY, "f.fresh AS is_new_install"))

cte("q_bi_ads", _with_install(_facts("'revenue'", FLTC(PR("revenue")), f"{PR('type')} = 'ad_reward'"),
                              "f.source AS placement", "1 AS ad_view", "coalesce(f.value, 0.0) AS ad_revenue"))

cte("q_spend_names", "SELECT * FROM (VALUES " + ", ".join(
    f"('{source}', '{name}')" for name, sources in SPEND_CATEGORIES for source in sources) + ") n(source, category)")

cte("q_bi_gem_flows", _with_install(
    _facts("'resource_top_up', 'resource_consume'", INT(PR("Currency_Gems"), "BIGINT"),
           f"coalesce({INT(PR('Currency_Gems'), 'BIGINT')}, 0) <> 0"),
    "CASE sign(f.value) WHEN 1 THEN 'in' ELSE 'out' END AS direction", "f.source AS gem_source",
    "coalesce((SELECT min(category) FROM q_spend_names n WHERE n.source = f.source), 'Other') AS category",
    "f.value * sign(f.value) AS gems"))

# Product prefixes of the shop's sections; the longest that fits counts.
SECTIONS = [("chapter", "ChapterPacks"), ("shoppacks.renewal", "RoulettePackShop"), ("shoppacks.", "ShopPacks"),
            ("dailybenefits.", "DailyBenefits")]
_SECTIONS = ", ".join(f"('{p}', '{s}')" for p, s in SECTIONS)
_LIFE = "greatest(0, b.purchase_date - coalesce(w.install_date, w.first_seen_date)) + 0 * (b.purchase_date - coalesce(w.install_date, w.first_seen_date))"

cte("q_bi_iap", f"""
SELECT b.purchase_date AS event_date, b.player_id, coalesce(w.marketing_campaign, {UNKNOWN}) AS marketing_campaign,
       CASE WHEN w.player_id IS NOT NULL THEN coalesce(w.country, {UNKNOWN}) END AS country,
       CASE WHEN w.player_id IS NOT NULL THEN coalesce(w.app_version, {UNKNOWN}) END AS app_version,
       CASE WHEN w.player_id IS NOT NULL THEN coalesce(w.install_platform, {UNKNOWN}) END AS install_platform, w.install_date,
       {LIFETIME_BUCKET(f'({_LIFE})')} AS lifetime_bucket, {LIFETIME_ORDER(f'({_LIFE})')} AS lifetime_order, b.product,
       coalesce((SELECT arg_max(s.section, length(s.prefix)) FROM (VALUES {_SECTIONS}) s(prefix, section)
                 WHERE starts_with(b.product, s.prefix)),
                CASE b.product WHEN 'adfree' THEN 'AdFree' WHEN {UNKNOWN} THEN {UNKNOWN} ELSE 'Other' END) AS placement,
       b.usd_amount, 1 AS purchase_cnt,
       b.purchase_date = min(b.purchase_date) OVER (PARTITION BY b.player_id) AS is_first_purchase
FROM (SELECT * FROM q_iap WHERE purchase_date IS NOT NULL) b LEFT JOIN q_dim_players w ON w.player_id = b.player_id
""")

_REVENUE_KEYS = "event_date, marketing_campaign, country, app_version, install_platform, install_date, lifetime_bucket"
cte("q_bi_revenue", f"""
SELECT revenue_source, {_REVENUE_KEYS}, sum(usd) AS revenue_usd
FROM (SELECT 'Ads' AS revenue_source, {_REVENUE_KEYS}, ad_revenue AS usd FROM q_bi_ads
      UNION ALL BY NAME SELECT 'IAP' AS revenue_source, {_REVENUE_KEYS}, usd_amount AS usd FROM q_bi_iap)
GROUP BY revenue_source, {_REVENUE_KEYS}
""")

# -------------------------------------------------------------- level events
# What an event means: its name, the outcome that it needs (null: any), and whether failures must be (un)tracked.
_MEANS = [("story_start", None, None, "level_start"), ("chapter_fight_summary", "true", None, "level_complete"),
          ("chapter_fight_summary", "false", None, "level_fail"), ("chapter_finish", None, False, "level_complete")]
_LEVEL = {
    "chapter": INT(PR("chapter")), "all_chapter_tries": INT(PR("allChapterTries")), "chapter_run_number": INT(PR("chapterRunNumber")),
    "battles_count": INT(PR("BattlesCount")), "energy_spend": INT(PR("energy_spend")), "days_since_registration": _DSR,
    "avg_rounds": FLT(PR("AvgRounds")), "avg_hp_percent": FLT(PR("AvgHpPercent")), "player_power": FLT(PR("playerPower")),
    "ab_version": P("abVersion"), "locale": P("locale"), "run_id": P("runId"), "app_version": P("version"),
    "is_star_mode": f"lower(coalesce({P('isStarMode')}, {P('IsStarMode')})) = 'true'",
    "has_fail_tracking": VGTE(P("version"), "1.0.28"),
}


def _sql(v) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'"


cte("q_level_means", "SELECT * FROM (VALUES " + ", ".join(
    f"({', '.join(map(_sql, m))})" for m in _MEANS) + ") m(source_event, outcome, tracked, event_type)")

_OF_INSTALL = ["platform", "device_brand", "device_model", "os_name"]
cte("q_levels", f"""
SELECT l.id AS event_id, l.event_at, CAST(l.event_at AS DATE) AS event_date, m.event_type, m.source_event, l.player_id,
       l.* EXCLUDE (id, event_at, name, player_id, outcome, told_country, app_version),
       coalesce(l.chapter, -1) AS chapter_key, coalesce(l.app_version, {UNKNOWN}) AS app_version,
       {LIFETIME_BUCKET('l.days_since_registration')} AS lifetime_bucket, {LIFETIME_ORDER('l.days_since_registration')} AS lifetime_order,
       coalesce(l.told_country, c.install_country, {UNKNOWN}) AS country,
       {', '.join(f'coalesce(c.{x}, {UNKNOWN}) AS {x}' for x in _OF_INSTALL)},
       c.os_version, c.os_api_level, c.is_test_profile IS TRUE AS is_test_profile
FROM (SELECT id, event_at, name, player_id, lower({PR('IsWin')}) AS outcome, {P('country')} AS told_country,
             {', '.join(f'{e} AS {c}' for c, e in _LEVEL.items())}
      FROM q_final WHERE {PR('isTest')} <> 'true' AND {VGTE(P('version'), '1.0.22')}) l
JOIN q_level_means m ON m.source_event = l.name AND coalesce(m.outcome = l.outcome, m.outcome IS NULL)
                    AND coalesce(m.tracked = l.has_fail_tracking, m.tracked IS NULL)
LEFT JOIN q_campaign c ON c.player_id = l.player_id
""")

_FUNNEL = ("event_date, chapter, chapter_key, is_star_mode, app_version, has_fail_tracking, country, platform, os_name, "
           "device_brand, lifetime_bucket")
cte("q_level_funnel", f"""
WITH steps AS (
  SELECT {_FUNNEL}, max(lifetime_order) AS lifetime_order,
         list(player_id) FILTER (event_type = 'level_start') AS s, list(player_id) FILTER (event_type = 'level_complete') AS c,
         list(player_id) FILTER (event_type = 'level_fail') AS f, avg(battles_count) FILTER (event_type <> 'level_start') AS avg_battles,
         avg(avg_hp_percent) FILTER (event_type = 'level_fail') AS avg_hp_percent_on_fail
  FROM q_levels WHERE NOT is_test_profile GROUP BY {_FUNNEL}),
counted AS (
  SELECT * EXCLUDE (s, c, f), coalesce(len(s), 0) AS starts, coalesce(len(c), 0) AS completes, coalesce(len(f), 0) AS fails,
         coalesce(len(list_distinct(s)), 0) AS start_players, coalesce(len(list_distinct(c)), 0) AS complete_players,
         coalesce(len(list_distinct(f)), 0) AS fail_players
  FROM steps)
SELECT *, CASE WHEN has_fail_tracking THEN greatest(0, starts - completes - fails) END AS abandons,
       {RND('completes / nullif(starts, 0)', 4)} AS complete_rate,
       CASE WHEN has_fail_tracking THEN {RND('fails / nullif(completes + fails, 0)', 4)} END AS fail_rate
FROM counted
""")
