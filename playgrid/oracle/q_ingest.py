"""Oracle SQL: landed API JSON ingest (M-39 .. M-42)."""

from playgrid.oracle.base import cte
from playgrid.sources.ingest import CONV_NESTED, CONV_STR, METRICS, STATUSES

_DAY = ("(DATE '2024-01-12' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER))")


def _dec(cents: str) -> str:
    return f"CAST(CAST(({cents}) / 100 AS DECIMAL(18, 2)) AS VARCHAR)"


cte("api_conversions", f"""
SELECT CAST(o_orderkey // 1000 AS BIGINT) AS page, o_orderkey % 1000 AS pos,
  '{{' || concat_ws(',',
    '"conversion_id":' || CAST(o_orderkey // 2 AS VARCHAR),
    '"conversion_datetime":"' || CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE ts END || '"',
    '"updated_at":"' || ts || '"',
    '"click_datetime":"' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ts END || '"',
    '"payment_model":' || CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE CAST(o_orderkey % 3 AS VARCHAR) END,
    '"payout":' || CASE WHEN o_orderkey % 6 = 0 THEN 'null' ELSE {_dec('o_orderkey % 500')} END,
    '"revenue":' || {_dec('CAST(round(o_totalprice * 100) AS BIGINT) % 100000')},
    '"value":' || {_dec('o_custkey % 300')},
    '"edited_by_manager":' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END,
    CASE WHEN o_orderkey % 5 = 0 THEN '"is_qualification":true' END,
    '"condition_id":' || CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE CAST(o_orderkey % 11 AS VARCHAR) END,
    '"landing_id":' || CAST(o_orderkey % 4 AS VARCHAR),
    '"tid":"t' || CAST(o_orderkey AS VARCHAR) || '"',
    '"status":"' || CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending' ELSE 'hold' END || '"',
    '"country":"C' || CAST(o_custkey % 4 AS VARCHAR) || '"',
    '"os":"' || CASE WHEN o_orderkey % 2 = 0 THEN 'ios' ELSE 'android' END || '"',
    '"sub1":"' || o_orderpriority || '"',
    '"promocode":null',
    '"goal":' || CASE WHEN o_orderkey % 9 = 0 THEN 'null' ELSE
        '{{"id":' || CAST(o_orderkey % 3 AS VARCHAR) || ',"name":"goal ' || CAST(o_orderkey % 3 AS VARCHAR)
        || '","key":"g' || CAST(o_orderkey % 3 AS VARCHAR) || '"}}' END,
    '"partner":{{"id":' || CAST(o_custkey % 7 AS VARCHAR) || ',"full_name":"Partner ' || CAST(o_custkey % 7 AS VARCHAR) || '"}}',
    '"offer":{{"id":' || CAST(o_custkey % 3 AS VARCHAR) || ',"name":null}}') || '}}' AS body
FROM (SELECT *, strftime({_DAY}, '%Y-%m-%d') || ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00' AS ts
      FROM orders) o
""")


def _js(path: str) -> str:
    return f"json_extract_string(body, '$.{path}')"


def _ts(path: str) -> str:
    return f"try_strptime(nullif({_js(path)}, ''), '%Y-%m-%d %H:%M:%S')"


_conv_cols = [
    "CAST(" + _js("conversion_id") + " AS BIGINT) AS conversion_id",
    _ts("conversion_datetime") + " AS conversion_datetime", _ts("updated_at") + " AS updated_at",
    _ts("click_datetime") + " AS click_datetime",
    "CAST(" + _js("payment_model") + " AS INTEGER) AS payment_model",
    *[f"coalesce(CAST({_js(m)} AS DECIMAL(18, 4)), 0) AS {m}" for m in ("payout", "revenue", "value")],
    f"coalesce({_js('edited_by_manager')} = 'true', false) AS edited_by_manager",
    f"coalesce({_js('is_qualification')} = 'true', false) AS is_qualification",
    "CAST(" + _js("condition_id") + " AS BIGINT) AS condition_id",
    "CAST(" + _js("landing_id") + " AS BIGINT) AS landing_id",
    *[f"coalesce({_js(k)}, '') AS {k}" for k in CONV_STR],
    *[(f"CAST({_js(obj + '.' + f)} AS BIGINT) AS {col}" if col.endswith("_id")
       else f"coalesce({_js(obj + '.' + f)}, '') AS {col}") for col, obj, f in CONV_NESTED],
    "body AS raw",
]

cte("q_conversions", "SELECT " + ",\n  ".join(_conv_cols) + """
FROM (SELECT * FROM api_conversions
      QUALIFY row_number() OVER (PARTITION BY CAST(json_extract_string(body, '$.conversion_id') AS BIGINT)
                                 ORDER BY page DESC, pos DESC) = 1) c
""")


def _status_obj(s: str, cnt: str) -> str:
    return (f"'\"{s}\":{{\"count\":' || CAST(coalesce({cnt}, 0) AS VARCHAR) || ',\"payout\":' || "
            f"{_dec(f'coalesce({s}_pc, 0)')} || ',\"revenue\":' || {_dec(f'coalesce({s}_rc, 0)')} || "
            f"',\"value\":' || {_dec(f'coalesce({s}_vc, 0)')} || '}}'")


_aggs = ["count(*) AS n"]
for _s in ("confirmed", "pending", "hold"):
    _aggs += [f"count(*) FILTER (WHERE st = '{_s}') AS {_s}_count",
              f"sum(pc) FILTER (WHERE st = '{_s}') AS {_s}_pc",
              f"sum(rc) FILTER (WHERE st = '{_s}') AS {_s}_rc",
              f"sum(vc) FILTER (WHERE st = '{_s}') AS {_s}_vc"]
_aggs += ["sum(pc) AS total_pc", "sum(rc) AS total_rc", "sum(vc) AS total_vc"]

cte("api_stats", f"""
WITH x AS (
  SELECT {_DAY} AS request_day,
         CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'pending' ELSE 'hold' END AS st,
         o_orderkey % 500 AS pc, CAST(round(o_totalprice * 100) AS BIGINT) % 100000 AS rc, o_custkey % 300 AS vc,
         unnest([
           {{'gb': 'day', 'gid': strftime({_DAY}, '%Y-%m-%d')}},
           {{'gb': 'partner', 'gid': CAST(o_custkey % 7 AS VARCHAR)}},
           {{'gb': 'offer', 'gid': CAST(o_custkey % 3 AS VARCHAR)}},
           {{'gb': 'country', 'gid': 'C' || CAST(o_custkey % 4 AS VARCHAR)}},
           {{'gb': 'os', 'gid': CASE WHEN o_orderkey % 2 = 0 THEN 'ios' ELSE 'android' END}},
           {{'gb': 'landing', 'gid': CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 4 AS VARCHAR) END}},
           {{'gb': 'sub1', 'gid': o_orderpriority}}]) AS g
  FROM orders),
g AS (
  SELECT request_day, g.gb AS group_by, g.gid AS gid, {', '.join(_aggs)}
  FROM x GROUP BY request_day, g.gb, g.gid),
l AS (SELECT *, unnest([1, 2]) AS load FROM g)
SELECT request_day, group_by, CAST(TIMESTAMP '2024-02-01 00:00:00' + to_days(load) AS TIMESTAMP) AS loaded_at,
  '{{"group_fields":[{{"group_field":"' || group_by || '","id":'
  || CASE WHEN gid IS NULL THEN 'null' ELSE '"' || gid || '"' END
  || CASE WHEN gid IS NULL THEN '' ELSE ',"label":"L-' || gid || '"' END
  || '}}],"click_count":' || CAST(n * 3 + load AS VARCHAR)
  || ',"click_unique_count":' || CAST(n * 2 AS VARCHAR)
  || ',"conversions":{{' || concat_ws(',', {_status_obj('confirmed', 'confirmed_count')},
                                          {_status_obj('pending', 'pending_count')},
                                          {_status_obj('hold', 'hold_count')},
                                          {_status_obj('total', 'n')}) || '}}}}' AS body
FROM l
""")

_met = [f"coalesce(CAST({_js('click_count')} AS BIGINT), 0) AS click_count",
        f"coalesce(CAST({_js('click_unique_count')} AS BIGINT), 0) AS click_unique_count"]
for _s in STATUSES:
    for _m in METRICS:
        t = "BIGINT" if _m == "count" else "DECIMAL(18, 4)"
        _met.append(f"coalesce(CAST({_js(f'conversions.{_s}.{_m}')} AS {t}), 0) AS {_s}_{_m}")

_GF = ("from_json(json_extract(body, '$.group_fields'), "
       "'[{\"group_field\": \"VARCHAR\", \"id\": \"VARCHAR\", \"label\": \"VARCHAR\"}]')")

cte("q_daily_stats", f"""
SELECT CAST(day_s AS DATE) AS day, {', '.join(_met)}
FROM (SELECT *, list_filter({_GF}, lambda x: x.group_field = 'day')[1].id AS day_s FROM api_stats WHERE group_by = 'day') s
WHERE day_s IS NOT NULL AND day_s <> ''
QUALIFY row_number() OVER (PARTITION BY CAST(day_s AS DATE) ORDER BY loaded_at DESC) = 1
""")

cte("q_daily_stats_by", f"""
SELECT request_day AS day, group_by AS dim, coalesce(g.id, '') AS dim_id, coalesce(g.label, '') AS dim_label,
       {', '.join(_met)}
FROM (SELECT *, list_filter({_GF}, lambda x: x.group_field = group_by)[1] AS g FROM api_stats
      WHERE group_by IN ('partner', 'offer', 'country', 'os', 'landing', 'sub1')) s
WHERE g IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY request_day, group_by, coalesce(g.id, '') ORDER BY loaded_at DESC) = 1
""")

cte("api_rate_docs", """
SELECT update_at AS fetched_at,
  '{"result":"success","base_code":"EUR","time_last_update_utc":"' || strftime(business_date, '%a, %d %b %Y')
  || ' 00:00:01 +0000","conversion_rates":{'
  || string_agg('"' || target_currency || '":' || CAST(rate AS VARCHAR), ',' ORDER BY target_currency) || '}}' AS body
FROM currency_rates GROUP BY business_date, update_at
""")

cte("q_rates_etl", """
SELECT business_date, base_currency, target_currency, rate, update_at FROM (
  SELECT CAST(strptime(left(split_part(json_extract_string(body, '$.time_last_update_utc'), ', ', 2), 20),
                       '%d %b %Y %H:%M:%S') AS DATE) AS business_date,
         json_extract_string(body, '$.base_code') AS base_currency, j.key AS target_currency,
         CAST(json_extract_string(j.value, '$') AS DOUBLE) AS rate, fetched_at AS update_at
  FROM api_rate_docs, json_each(json_extract(body, '$.conversion_rates')) j)
QUALIFY row_number() OVER (PARTITION BY business_date, base_currency, target_currency ORDER BY update_at DESC) = 1
""")
