"""Oracle SQL: big-win detection by round and by session (M-43, M-44)."""

from playgrid.oracle.base import cte
from playgrid.oracle.sqlfn import RND
from playgrid.plans.alerts import _CURRENCIES, _PROVIDERS, THRESHOLDS


def _lst(vals) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in vals) + "]"


cte("q_wins", f"""
SELECT 'casino' AS source_service,
       'agg' || CAST(s.s_suppkey % 3 AS VARCHAR) || ':' || {_lst([p[1] for p in _PROVIDERS])}[CAST(s.s_suppkey % 12 AS INTEGER) + 1] AS provider_key,
       {_lst([p[0] for p in _PROVIDERS])}[CAST(s.s_suppkey % 12 AS INTEGER) + 1] AS provider_slug,
       'u' || CAST(o.o_custkey AS VARCHAR) AS user_id,
       CASE WHEN o.o_orderkey % 11 = 0 THEN '' ELSE 'u' || CAST(o.o_custkey AS VARCHAR) || '-' || strftime(o.o_orderdate, '%Y%m') END AS session_id,
       'r' || CAST(l.l_orderkey AS VARCHAR) AS round_id,
       'g' || CAST(l.l_partkey % 40 AS VARCHAR) AS game_id,
       {_lst(_CURRENCIES)}[CAST(s.s_nationkey % 4 AS INTEGER) + 1] AS currency,
       CASE WHEN l.l_linenumber = 1 THEN 'bet' ELSE 'win' END AS event_type,
       CAST(l.l_extendedprice AS DECIMAL(18, 2)) AS amount,
       o.o_orderdate + to_hours(l.l_linenumber) AS occurred_at,
       l.l_shipdate + to_minutes(l.l_linenumber) AS created_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")

cte("q_fx", """
SELECT CASE WHEN o_orderkey % 2 = 1 AND (o_orderkey // 2) % 2 = 0 THEN 'other'
            WHEN o_custkey % 2 = 0 THEN 'main' ELSE 'other' END AS customer,
       CASE WHEN o_orderkey % 2 = 0 THEN 'EUR' ELSE 'TRY' END AS currency_from,
       CASE WHEN (o_orderkey // 2) % 2 = 0 AND o_orderkey % 2 = 1 THEN 'EUR' ELSE 'USD' END AS currency_to,
       o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS effective_at,
       CASE WHEN o_orderkey % 2 = 0 THEN 1.05 + (o_orderkey % 10) / 100.0
            WHEN (o_orderkey // 2) % 2 <> 0 THEN 0.03 + (o_orderkey % 100) / 10000.0
            ELSE 0.028 + (o_orderkey % 100) / 10000.0 END AS rate
FROM orders
""")


def _norm(x: str) -> str:
    return f"regexp_replace(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


def _rule(x: str) -> str:
    n = _norm(x)
    whens = " ".join(f"WHEN {n} <> '' AND starts_with({n}, '{t[0]}') THEN {i}" for i, t in enumerate(THRESHOLDS))
    return f"(CASE {whens} END)"


def _rcol(idx: str, k: int) -> str:
    vals = ", ".join((str(t[k]) if isinstance(t[k], (int, float)) else f"'{t[k]}'") for t in THRESHOLDS)
    return f"[{vals}][{idx} + 1]"


def _dedup_list(expr: str) -> str:
    return f"list_filter({expr}, lambda x, i: list_position({expr}, x) = i)"


def _big_wins(grp: str, mode: str, all_time: bool = False) -> str:
    """``all_time``: every key, all rates and an empty ledger, as a stream from the first event on has it."""
    key = f"source_service, provider_key, user_id, {grp}"
    return f"""
WITH w AS (SELECT * FROM q_wins WHERE event_type = 'win'),
since AS (SELECT {"max(TIMESTAMP '0001-01-01')" if all_time else "max(created_at) - INTERVAL 90 DAY"} AS t FROM q_wins),
prov AS (SELECT slug, max(title) AS provider_title FROM (
           SELECT {_lst([p[0] for p in _PROVIDERS])}[CAST(s_suppkey % 12 AS INTEGER) + 1] AS slug,
                  CASE WHEN s_suppkey % 5 = 0 THEN NULL
                       ELSE {_lst([p[2] for p in _PROVIDERS])}[CAST(s_suppkey % 12 AS INTEGER) + 1] END AS title
           FROM supplier) GROUP BY slug),
t0 AS (SELECT {key}, max(provider_slug) AS provider_slug FROM w
       WHERE amount > 0 AND created_at >= (SELECT t FROM since) AND {grp} IS NOT NULL AND {grp} <> ''
       GROUP BY ALL),
touched AS (
  SELECT * FROM (
    SELECT t0.*, p.provider_title,
           coalesce({_rule('t0.provider_slug')}, {_rule("string_split(t0.provider_key, ':')[-1]")},
                    {_rule('p.provider_title')}) AS rule
    FROM t0 LEFT JOIN prov p ON p.slug = t0.provider_slug) WHERE rule IS NOT NULL),
gd AS (SELECT 'g' || CAST(p_partkey % 40 AS VARCHAR) AS game_id, max(p_name) AS game_title FROM part GROUP BY 1),
pd AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS user_id, max('P' || CAST(c_custkey AS VARCHAR)) AS public_id,
              max(CAST(c_custkey % 40 = 3 AS INTEGER)) AS is_test FROM customer GROUP BY 1),
per_round AS (
  SELECT e.source_service, e.provider_key, e.user_id, e.round_id, e.session_id, e.currency,
         sum(e.amount) AS amount, min(e.occurred_at) AS first_at, max(e.occurred_at) AS win_at, count(*) AS n,
         max(e.game_id) AS game_id, max(g.game_title) AS game_title, max(pl.public_id) AS public_id,
         max(coalesce(pl.is_test, 0)) AS is_test
  FROM w e LEFT JOIN gd g ON g.game_id = e.game_id LEFT JOIN pd pl ON pl.user_id = e.user_id
  WHERE (e.source_service, e.provider_key, e.user_id, e.{grp}) IN (SELECT ({key}) FROM touched)
  GROUP BY ALL),
grp AS (
  SELECT r.source_service, r.provider_key, r.user_id, r.{grp}, r.currency,
         any_value(t.provider_slug) AS provider_slug, any_value(t.provider_title) AS provider_title,
         any_value(t.rule) AS rule, CAST(sum(r.amount) AS DOUBLE) AS amount, max(r.win_at) AS win_at,
         sum(r.n) AS win_events, max(r.is_test) AS is_test,
         list(r.round_id ORDER BY r.first_at, r.round_id) AS round_list,
         list(coalesce(r.game_title, r.game_id, '?') ORDER BY r.first_at, r.round_id) AS game_list,
         list(coalesce(r.game_id, '') ORDER BY r.first_at, r.round_id) AS game_id_list,
         list(r.session_id ORDER BY r.first_at, r.round_id) FILTER (WHERE r.session_id IS NOT NULL AND r.session_id <> '') AS sess_list,
         first(r.public_id ORDER BY r.first_at, r.round_id) AS public_id
  FROM per_round r JOIN touched t USING (source_service, provider_key, user_id, {grp})
  GROUP BY ALL),
g AS (SELECT *, concat_ws('|', source_service, provider_key, user_id, {grp}, currency) AS gid FROM grp),
fx_since AS (SELECT {"max(TIMESTAMP '0001-01-01')" if all_time else "min(win_at) - INTERVAL 14 DAY"} AS t FROM g),
f AS (SELECT * FROM q_fx WHERE currency_to IN ('USD', 'EUR')
        AND currency_from IN (SELECT currency FROM g UNION SELECT 'EUR')),
in_win AS (SELECT * FROM f WHERE effective_at >= (SELECT t FROM fx_since)),
before AS (
  SELECT customer, currency_from, currency_to, effective_at, rate FROM f
  WHERE effective_at < (SELECT t FROM fx_since)
    AND (currency_from, currency_to) NOT IN (SELECT (currency_from, currency_to) FROM in_win)
  QUALIFY row_number() OVER (PARTITION BY currency_from, currency_to
                             ORDER BY effective_at DESC, rate DESC, customer DESC) = 1),
cand0 AS (SELECT customer, currency_from, currency_to, effective_at, rate FROM in_win
          UNION ALL SELECT * FROM before),
cand AS (SELECT * FROM cand0 c
         WHERE customer = 'main' OR NOT EXISTS (SELECT 1 FROM cand0 d WHERE d.currency_from = c.currency_from
                                                AND d.currency_to = c.currency_to AND d.customer = 'main')),
usd AS (
  SELECT g.gid, c.rate, c.effective_at FROM g JOIN cand c ON c.currency_from = g.currency AND c.currency_to = 'USD'
  QUALIFY row_number() OVER (PARTITION BY g.gid ORDER BY CASE WHEN c.effective_at <= g.win_at THEN 0 ELSE 1 END,
      CASE WHEN c.effective_at <= g.win_at THEN c.effective_at END DESC,
      CASE WHEN c.effective_at <= g.win_at THEN c.rate END DESC, c.effective_at, c.rate) = 1),
eur AS (
  SELECT g.gid, c.rate, c.effective_at FROM g JOIN cand c ON c.currency_from = 'EUR' AND c.currency_to = 'USD'
  QUALIFY row_number() OVER (PARTITION BY g.gid ORDER BY CASE WHEN c.effective_at <= g.win_at THEN 0 ELSE 1 END,
      CASE WHEN c.effective_at <= g.win_at THEN c.effective_at END DESC,
      CASE WHEN c.effective_at <= g.win_at THEN c.rate END DESC, c.effective_at, c.rate) = 1),
conv AS (
  SELECT g.*, CASE WHEN g.currency = 'USD' THEN 1.0 WHEN u.rate IS NOT NULL THEN u.rate
                   WHEN g.currency IN ('USD', 'USDT', 'USDC') THEN 1.0 END AS rate_usd,
         CASE WHEN g.currency <> 'USD' THEN u.effective_at END AS rate_usd_at,
         e.rate AS rate_eur_usd, e.effective_at AS rate_eur_usd_at
  FROM g LEFT JOIN usd u ON u.gid = g.gid LEFT JOIN eur e ON e.gid = g.gid),
big AS (
  SELECT *, amount * rate_usd AS amount_usd, amount * rate_usd / rate_eur_usd AS amount_eur FROM conv
  WHERE rate_usd IS NOT NULL AND rate_eur_usd IS NOT NULL),
sel AS (
  SELECT * FROM big
  WHERE {RND(f"CASE WHEN {_rcol('rule', 3)} = 'USD' THEN amount_usd ELSE amount_eur END", 2)} > {_rcol('rule', 2)}
    AND is_test = 0),
ledger AS (
  SELECT DISTINCT concat_ws('|', source_service, provider_key, user_id, {grp}, currency) AS alert_key
  FROM q_wins WHERE {"false" if all_time else "true"} AND event_type = 'win' AND {grp} <> '' AND suffix(round_id, '7'))
SELECT gid AS alert_key, win_at, coalesce(provider_title, {_rcol('rule', 1)}) AS provider,
       coalesce(provider_slug, provider_key) AS provider_slug,
       array_to_string({_dedup_list('game_list')}, ', ') AS game,
       array_to_string({_dedup_list('game_id_list')}, ', ') AS game_id,
       'site' AS site,
       coalesce(array_to_string({_dedup_list('sess_list')}, ', '), '') AS session_id,
       {grp if mode == 'round' else "''"} AS round_id,
       array_to_string(round_list, ', ') AS round_ids, CAST(len(round_list) AS INTEGER) AS rounds,
       user_id AS player_id, coalesce(public_id, '') AS player_public_id, currency, amount,
       {RND('amount_usd', 2)} AS amount_usd, {RND('amount_eur', 2)} AS amount_eur,
       rate_usd, rate_usd_at, rate_eur_usd, rate_eur_usd_at,
       CAST({_rcol('rule', 2)} AS DOUBLE) AS threshold, {_rcol('rule', 3)} AS threshold_currency,
       {_rcol('rule', 4)} AS report_to, win_events
FROM sel WHERE gid NOT IN (SELECT alert_key FROM ledger)
"""


cte("q_big_wins_round", _big_wins("round_id", "round"))
cte("q_big_wins_session", _big_wins("session_id", "session"))
cte("q_big_wins_stream", _big_wins("session_id", "session", all_time=True))
