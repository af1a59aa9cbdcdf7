"""DuckDB oracle: reference-shaped inputs re-derived in SQL, plus a CTE assembler.

Each oracle query is written from the mart definitions (not from the Spark
plan). ``build(final_sql, *ctes)`` prepends every CTE the query needs, in
dependency order. CTE bodies are plain DuckDB SQL over the driver views.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _deps(body: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{re.escape(n)}\b", body)]


def build(final: str) -> str:
    """Return ``WITH <needed ctes> <final>``; dependencies found by name."""
    order: list[str] = []

    def visit(name: str, seen: tuple = ()):
        if name in order:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in seen:
                visit(d, seen + (name,))
        order.append(name)

    for n in _deps(final):
        visit(n)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n" + final.strip()


# ------------------------------------------------------------------ inputs
cte("g_base", r"""
SELECT e.event_id, e.ts, e.value, e.event_type AS t, e.user_id AS u,
       CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
       strftime(e.ts, '%Y%m%d') AS ymd, f.fam
FROM events e, (SELECT unnest(['a', 'b', 'c']) AS fam) f
""")

cte("g_parts", r"""
SELECT *,
  CASE u % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'PH' WHEN 2 THEN 'GB' WHEN 3 THEN 'DE' ELSE '' END AS country_s,
  CASE WHEN k % 10 = 0 THEN '1.0.9' ELSE '1.0.' || CAST(k % 10 + 20 AS VARCHAR) END AS version_s,
  CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS ab_s,
  CASE WHEN k % 40 = 39 THEN 'n/a' ELSE CAST(k % 40 AS VARCHAR) END AS dsr_s,
  CASE WHEN k % 50 = 49 THEN '"isTest":"true"' END AS test_s,
  CASE k % 8 WHEN 0 THEN 'Revive' WHEN 1 THEN 'Pets' WHEN 2 THEN 'ShopPacks' WHEN 3 THEN 'Roulette'
             WHEN 4 THEN 'DailyBenefits' WHEN 5 THEN 'ChapterRewards' WHEN 6 THEN 'Cheats' ELSE 'Mystery' END AS spend_s,
  CASE k % 5 WHEN 0 THEN 'revive' WHEN 1 THEN 'double_reward' WHEN 2 THEN 'free_chest' WHEN 3 THEN 'energy'
             ELSE 'shop_refresh' END AS placement_s,
  CASE k % 5 WHEN 0 THEN 'gems_small' WHEN 1 THEN 'gems_big' WHEN 2 THEN 'battle_pass' WHEN 3 THEN 'chapter_pack' END AS sku_s,
  CAST(value AS VARCHAR) AS value_s
FROM g_base
""")

cte("g_common", r"""
SELECT *, concat_ws(',', '"country":"' || country_s || '"', '"version":"' || version_s || '"',
                    '"abVersion":"' || ab_s || '"', '"daysSinceRegistration":"' || dsr_s || '"', test_s) AS common_s
FROM g_parts
""")

cte("game_events", r"""
SELECT
  fam || CAST(u AS VARCHAR) || '_' || t || '_' || ymd AS id,
  CASE fam
    WHEN 'a' THEN CASE WHEN t IN ('purchase', 'click') THEN 'revenue' WHEN t = 'view' THEN 'resource_top_up'
                       WHEN t = 'error' THEN 'resource_consume' WHEN k % 2 = 0 THEN 'session_end' ELSE 'pause' END
    WHEN 'b' THEN CASE WHEN t IN ('view', 'signup') THEN 'story_start' WHEN t = 'error' THEN 'chapter_finish'
                       ELSE 'chapter_fight_summary' END
    ELSE CASE WHEN t = 'signup' AND k % 10 = 0 THEN 'clan_creation' WHEN t = 'signup' THEN 'clan_join'
              WHEN t = 'purchase' THEN 'clan_raid_fight' WHEN t = 'click' THEN 'clan_role_change'
              WHEN t = 'error' THEN 'clan_kick' ELSE 'clan_lvl_up' END
  END AS name,
  'p' || CAST(u AS VARCHAR) AS player_id,
  'p' || CAST(u AS VARCHAR) || '_' || ymd AS session_id,
  'c' || CAST(u AS VARCHAR) || '_' || ymd AS client_session_id,
  ts AS event_at,
  CAST(ts AS DATE) AS event_date,
  CASE WHEN t = 'signup' THEN 'server' ELSE 'client' END AS source,
  '{' || CASE fam
    WHEN 'a' THEN CASE
      WHEN t = 'purchase' THEN concat_ws(',', common_s, '"chapter":' || CAST(k % 12 AS VARCHAR),
            '"allChapterTries":' || CAST(k % 20 AS VARCHAR),
            '"revenue":"' || CASE WHEN k % 10 = 3 THEN replace(value_s, '.', ',') ELSE value_s END || '"',
            '"type":"purchase"',
            '"currency":"' || CASE k % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'PHP' WHEN 2 THEN 'EUR' END || '"',
            '"source":"shop"', '"purchase_id":"com.example.game.' || sku_s || '"')
      WHEN t = 'click' THEN concat_ws(',', common_s, '"chapter":' || CAST(k % 12 AS VARCHAR),
            '"revenue":"' || value_s || '"', '"type":"ad_reward"', '"currency":"USD"',
            '"source":"' || placement_s || '"')
      WHEN t = 'view' THEN concat_ws(',', common_s, '"chapter":' || CAST(k % 12 AS VARCHAR),
            '"Currency_Gems":' || CAST(k AS VARCHAR), '"Chests_Common":' || CAST(k % 3 AS VARCHAR),
            '"CurrencyX":1', CASE WHEN k % 7 = 0 THEN '"Currency_Dust":1.5' END,
            '"balanceSnapshot":{"Gems":' || CAST(k AS VARCHAR) || ',"Gold":' || CAST(k * 10 AS VARCHAR) || '}',
            '"source":"' || spend_s || '"')
      WHEN t = 'error' THEN concat_ws(',', common_s, '"chapter":' || CAST(k % 12 AS VARCHAR),
            '"Currency_Gems":' || CAST(-(k % 30) AS VARCHAR), '"Currency_Gold":' || CAST(-k AS VARCHAR),
            '"source":"' || spend_s || '"')
      ELSE concat_ws(',', common_s) END
    WHEN 'b' THEN concat_ws(',', common_s,
            CASE WHEN k % 25 <> 24 THEN '"chapter":' || CAST(k % 12 AS VARCHAR) END, '"locale":"en"',
            '"allChapterTries":' || CAST(k % 20 AS VARCHAR),
            CASE k % 4 WHEN 0 THEN '"isStarMode":"true"' WHEN 1 THEN '"IsStarMode":"True"'
                       WHEN 2 THEN '"isStarMode":"false"' END,
            '"IsWin":"' || CASE k % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE 'maybe' END || '"',
            '"runId":"r' || CAST(event_id AS VARCHAR) || '"',
            '"chapterRunNumber":' || CAST(k % 5 AS VARCHAR), '"BattlesCount":' || CAST(k % 7 AS VARCHAR),
            '"AvgRounds":"' || CAST(k % 9 AS VARCHAR) || '.5"', '"AvgHpPercent":' || CAST(k AS VARCHAR),
            '"energy_spend":5', '"playerPower":' || CAST(k * 100 AS VARCHAR))
    ELSE concat_ws(',', common_s,
            '"clanId":"' || CASE WHEN k % 33 = 32 THEN '' ELSE 'c' || CAST(k % 6 AS VARCHAR) END || '"',
            '"clanName":"Clan ' || CAST(k % 6 AS VARCHAR) || '"',
            CASE WHEN t = 'signup' THEN '"joinMethod":"' || CASE WHEN k % 2 = 0 THEN 'invite' ELSE 'search' END || '"' END,
            CASE WHEN t = 'signup' THEN '"memberCountAfterJoin":' || CAST(k % 30 AS VARCHAR) END,
            CASE WHEN t = 'error' THEN '"kickUserId":"p' || CAST(u + k % 3 AS VARCHAR) || '"' END,
            CASE WHEN t = 'click' THEN '"changeUserId":"p' || CAST(u + k % 2 AS VARCHAR) || '"' END,
            CASE WHEN t = 'click' THEN '"oldRole":"' || CASE k % 3 WHEN 0 THEN 'member' WHEN 1 THEN 'officer' ELSE 'leader' END || '"' END,
            CASE WHEN t = 'click' THEN '"newRole":"' || CASE (k + 1) % 3 WHEN 0 THEN 'member' WHEN 1 THEN 'officer' ELSE 'leader' END || '"' END,
            CASE WHEN t = 'view' THEN '"newLevel":' || CAST(k % 10 + 1 AS VARCHAR) END,
            CASE WHEN t = 'purchase' THEN '"bossTier":' || CAST(k % 5 + 1 AS VARCHAR) END,
            CASE WHEN t = 'purchase' THEN '"IsWin":"' || CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END || '"' END,
            CASE WHEN t = 'purchase' THEN '"HpPercent":' || CAST(k + 1 AS VARCHAR) END,
            CASE WHEN t = 'purchase' THEN '"Rounds":' || CAST(k % 8 AS VARCHAR) END,
            CASE WHEN t = 'purchase' AND k % 9 <> 0 THEN
              '"Stats":"{\"CURRENT_HP\":' || CAST(k * 10 AS VARCHAR) || ',\"MAX_HP\":'
              || CASE WHEN k % 11 = 0 THEN '0' ELSE '1000' END || '}"' END)
  END || '}' AS properties,
  '{}' AS context,
  ts + to_hours(event_id * 7 % 96) AS received_at,
  ts + to_hours(event_id * 7 % 96) + INTERVAL 1 MINUTE AS ingested_at,
  event_id AS seq
FROM g_common
""")

cte("raw_profiles", r"""
SELECT '{' || concat_ws(',',
  '"id":"' || CASE WHEN c_custkey % 50 = 7 THEN '' ELSE 'p' || CAST(c_custkey AS VARCHAR) END || '"',
  '"userId":"u' || CAST(c_custkey AS VARCHAR) || '"',
  '"isTest":' || CASE WHEN c_custkey % 40 = 3 THEN 'true' ELSE 'false' END,
  '"serverId":"s' || CAST(c_custkey % 3 AS VARCHAR) || '"') || '}' AS data
FROM customer
""")

cte("raw_accounts", r"""
SELECT '{' || concat_ws(',',
  '"id":"u' || CAST(c.c_custkey AS VARCHAR) || '"',
  '"campaignName":"' || CASE WHEN c.c_custkey % 11 = 0 THEN '' ELSE c.c_mktsegment END || '"',
  '"externalId":"x' || CAST(c.c_custkey AS VARCHAR) || '"',
  '"appsFlyerId":"af' || CAST(c.c_custkey AS VARCHAR) || '"',
  '"country":"' || n.n_name || '"',
  '"platform":"' || CASE WHEN c.c_custkey % 2 = 0 THEN 'ios' ELSE 'android' END || '"',
  '"firstVersion":"1.0.' || CAST(c.c_custkey % 10 + 20 AS VARCHAR) || '"',
  '"createdAt":"' || strftime(DATE '2024-01-01' + CAST(c.c_custkey % 30 AS INTEGER), '%Y-%m-%d') || 'T08:00:00Z"',
  CASE WHEN c.c_custkey % 13 <> 0 THEN
    '"deviceInfo":"{\"model\":\"' || CASE c.c_custkey % 4 WHEN 0 THEN 'samsung' WHEN 1 THEN 'Xiaomi' WHEN 2 THEN 'Google' ELSE 'Apple' END
    || ' M' || CAST(c.c_custkey % 100 AS VARCHAR) || '\",\"os\":\"'
    || CASE WHEN c.c_custkey % 2 = 0 THEN 'iOS 17.' || CAST(c.c_custkey % 5 AS VARCHAR)
            ELSE 'Android OS 1' || CAST(c.c_custkey % 5 AS VARCHAR) || ' / API-3' || CAST(c.c_custkey % 5 AS VARCHAR) || ' (build)' END
    || '\"}"' END) || '}' AS data
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_custkey % 9 <> 0
""")

cte("raw_transactions", r"""
SELECT '{' || concat_ws(',',
  '"id":"t' || CAST(o_orderkey AS VARCHAR) || '"',
  '"profileId":"p' || CAST(o_custkey AS VARCHAR) || '"',
  '"occurredAt":"' || CASE WHEN o_orderkey % 23 = 0 THEN 'not a time'
      ELSE strftime(DATE '2024-01-12' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER), '%Y-%m-%d')
           || 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':15:00Z' END || '"',
  CASE WHEN o_orderkey % 17 <> 0 THEN '"usdAmount":' || CAST(floor(o_totalprice / 100) / 100.0 AS VARCHAR) END,
  '"productId":"com.example.game.' || lower(replace(substr(o_orderpriority, 3, 20), ' ', '_')) || '"',
  '"type":"' || CASE WHEN o_orderkey % 10 = 1 THEN 'SUBSCRIPTION' ELSE 'IAP' END || '"',
  '"status":"' || CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'RECORDED' END || '"') || '}' AS data
FROM orders
""")

cte("currency_rates", r"""
SELECT DATE '2024-01-05' + di AS business_date, 'EUR' AS base_currency, target_currency,
  CASE WHEN target_currency = 'GBP' AND di = 5 THEN 0.0 ELSE
    (CASE target_currency WHEN 'USD' THEN 1.08 + di * 0.001 WHEN 'PHP' THEN 60.0 + di * 0.1
                          WHEN 'EUR' THEN 1.0 ELSE 0.85 + di * 0.001 END) * (1.0 + ver / 100.0) END AS rate,
  CAST(DATE '2024-01-05' + di AS TIMESTAMP) + to_hours(ver) AS update_at
FROM (SELECT CAST(o_orderkey % 26 AS INTEGER) AS di,
             CASE (o_orderkey // 26) % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'PHP' WHEN 2 THEN 'EUR' ELSE 'GBP' END AS target_currency,
             CAST(o_orderkey % 3 AS INTEGER) AS ver
      FROM orders GROUP BY ALL) g
WHERE NOT (target_currency = 'USD' AND DATE '2024-01-05' + di = DATE '2024-01-20')
""")

cte("iap_backfill", r"""
SELECT 'p' || CAST(o_custkey AS VARCHAR) AS player_id,
       DATE '2024-01-02' + CAST(o_orderkey % 10 AS INTEGER) AS event_date,
       floor(o_totalprice / 1000) / 100.0 AS revenue_amount
FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
""")

cte("user_props", r"""
SELECT 'p' || CAST(o_custkey AS VARCHAR) AS user_id,
  '{"device_type":"' || CASE o_orderkey % 4 WHEN 0 THEN 'phone' WHEN 1 THEN 'tablet' WHEN 2 THEN 'desktop' ELSE '' END
  || '","os":"x"}' AS props,
  o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS updated_at
FROM orders
""")
