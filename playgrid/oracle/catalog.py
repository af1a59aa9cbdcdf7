"""Oracle SQL per registered query name."""

from playgrid.oracle import base, q_alerts, q_bi, q_clans, q_core, q_fin, q_forecast, q_ingest, q_ops  # noqa: F401
from playgrid.oracle.sqlfn import STABLE

# query name -> (final SELECT over the oracle CTEs, DOUBLE columns rounded at the boundary)
FINAL = {
    "stg_events": ("SELECT * FROM q_stg", ["revenue_amount"]),
    "int_revenue": ("SELECT * FROM q_revenue", ["revenue_amount"]),
    "int_economy": ("SELECT * FROM q_economy", []),
    "rates_usd": ("SELECT * FROM q_rates_usd", ["usd_per_unit"]),
    "player_campaign": ("SELECT * FROM q_campaign", []),
    "iap_usd": ("SELECT * FROM q_iap", ["usd_amount"]),
    "dim_players": ("SELECT * FROM q_dim_players", ["ltv"]),
    "daily_active_users": ("SELECT * FROM q_dau", ["revenue", "arpdau"]),
    "activity_windows": ("SELECT * FROM q_activity_windows", []),
    "activity_approx": ("SELECT *, true AS dau_within_error, true AS wau_within_error, true AS mau_within_error "
                        "FROM q_activity_windows", []),
    "fct_revenue": ("SELECT * FROM q_fct_revenue", ["revenue_amount", "revenue_amount_usd"]),
    "fct_economy": ("SELECT * FROM q_fct_economy", []),
    "currency_flows_daily": ("SELECT * FROM q_flows", []),
    "currency_balance_daily": ("SELECT * FROM q_balance", ["avg_balance", "median_balance"]),
    "balance_backfill": ("SELECT * FROM q_balance_backfill", ["avg_balance", "median_balance"]),
    "economy_incremental": ("SELECT * FROM q_fct_economy", []),
    "balance_incremental": ("SELECT * FROM q_balance WHERE event_date >= (SELECT max(event_date) - 5 FROM q_final)",
                            ["avg_balance", "median_balance"]),
    "conversions_upsert": ("SELECT * FROM q_conversions", []),
    "rates_upsert": ("SELECT * FROM q_rates_etl", ["rate"]),
    "level_events_by_month": ("SELECT *, CAST(strftime(event_date, '%Y%m') AS INTEGER) AS yyyymm FROM q_levels",
                              ["avg_rounds", "avg_hp_percent", "player_power"]),
    "revenue_daily": ("SELECT * FROM q_revenue_daily", ["revenue", "avg_transaction", "arpu", "arppu"]),
    "cohort_daily": ("SELECT * FROM q_cohort_daily",
                     ["retention_rate", "ad_revenue", "iap_revenue", "total_revenue", "cum_ad_revenue",
                      "cum_iap_revenue", "cum_total_revenue", "ad_arpu_cum", "arpu_cum"]),
    "cohort_daily_country": ("SELECT * FROM q_cohort_daily_country",
                             ["retention_rate", "ad_revenue", "iap_revenue", "total_revenue", "cum_ad_revenue",
                              "cum_iap_revenue", "cum_total_revenue", "ad_arpu_cum", "arpu_cum"]),
    "cohort_daily_campaign": ("SELECT * FROM q_cohort_campaign",
                              ["ad_revenue", "iap_revenue", "total_revenue", "cum_ad_revenue",
                               "cum_iap_revenue", "cum_total_revenue", "arpu_cum"]),
    "cohort_pu": ("SELECT * FROM q_cohort_pu",
                  ["iap_usd_d0", "iap_usd_d1", "iap_usd_d3", "iap_usd_d7"]),
    "cohort_pu_daily": ("SELECT * EXCLUDE (before) FROM q_cohort_pu_daily",
                        ["pu_rate_cum", "iap_usd", "iap_usd_cum", "iap_arpu_cum"]),
    "forecast_input": ("SELECT * FROM q_forecast_input", ["cum_ad_arpu", "cum_arpu"]),
    "ad_placement_version": ("SELECT * FROM q_ad_placement_version",
                             ["ad_revenue", "ecpm", "rev_per_viewer", "rev_share_in_version"]),
    "ad_placement_country": ("SELECT * FROM q_ad_placement_country",
                             ["ad_revenue", "ecpm", "rev_per_viewer", "rev_share_in_version_country"]),
    "ad_segment": ("SELECT * FROM q_ad_segment", []),
    "bi_activity": ("SELECT * FROM q_bi_activity", []),
    "bi_ads": ("SELECT * FROM q_bi_ads", ["ad_revenue"]),
    "bi_gem_flows": ("SELECT * FROM q_bi_gem_flows", []),
    "bi_iap": ("SELECT * FROM q_bi_iap", ["usd_amount"]),
    "bi_revenue": ("SELECT * FROM q_bi_revenue", ["revenue_usd"]),
    "fct_level_events": ("SELECT * FROM q_levels", ["avg_rounds", "avg_hp_percent", "player_power"]),
    "level_funnel_daily": ("SELECT * FROM q_level_funnel",
                           ["complete_rate", "fail_rate", "avg_battles", "avg_hp_percent_on_fail"]),
    "clan_events": ("SELECT * FROM q_clan_events", ["hp_percent"]),
    "clan_members": ("SELECT * FROM q_clan_members", ["days_in_clan", "raid_win_rate"]),
    "clan_raid_fights": ("SELECT * FROM q_clan_fights", ["hp_percent", "stats_current_hp", "stats_max_hp"]),
    "clan_raid_tiers": ("SELECT * FROM q_clan_tiers",
                        ["win_rate", "hours_to_first_win", "avg_rounds", "avg_hp_percent_on_win"]),
    "clan_daily": ("SELECT * FROM q_clan_daily", ["active_share", "raid_participation", "tech_issue_rate"]),
    "dim_clans": ("SELECT * FROM q_dim_clans", ["active_share_7d", "raid_win_rate", "tech_issue_rate"]),
    "trend_forecast": ("SELECT * FROM q_trend", ["prophet_cum_ad_arpu", "prophet_cum_arpu"]),
    "arpu_forecast": ("SELECT * FROM q_arpu_forecast", [
        "observed_cum_ad_arpu", "observed_cum_arpu", "forecast_cum_ad_arpu", "forecast_cum_arpu",
        "best_cum_ad_arpu", "best_cum_arpu", "prophet_cum_ad_arpu", "prophet_cum_arpu",
        "prophet_obs_cum_ad_arpu", "prophet_obs_cum_arpu", "prophet_obs_cum_iap_arpu",
        "observed_cum_iap_arpu", "forecast_cum_iap_arpu", "best_cum_iap_arpu", "prophet_cum_iap_arpu",
        "observed_iap", "forecast_iap"]),
    "conversions": ("SELECT * FROM q_conversions", []),
    "daily_stats": ("SELECT * FROM q_daily_stats", []),
    "daily_stats_by": ("SELECT * FROM q_daily_stats_by", []),
    "currency_rates": ("SELECT * FROM q_rates_etl", ["rate"]),
    "player_lookup": ("SELECT * FROM q_player_lookup", []),
    "new_files": ("SELECT * FROM q_new_files", []),
    "mart_tests": ("SELECT * FROM q_mart_tests", []),
    "dq_report": ("SELECT * FROM q_dq", []),
    "events_stream": ("SELECT * FROM q_final", []),
    "fights_stream": ("SELECT event_id, event_at, player_id, clan_id, boss_tier, is_win FROM q_clan_fights WHERE NOT is_duplicate", []),
    "file_ledger_stream": ("SELECT * FROM q_new_files", []),
    "big_wins_stream": ("SELECT * FROM q_big_wins_stream",
                        ["amount", "amount_usd", "amount_eur", "rate_usd", "rate_eur_usd", "threshold"]),
    "big_wins_round": ("SELECT * FROM q_big_wins_round",
                       ["amount", "amount_usd", "amount_eur", "rate_usd", "rate_eur_usd", "threshold"]),
    "big_wins_session": ("SELECT * FROM q_big_wins_session",
                         ["amount", "amount_usd", "amount_eur", "rate_usd", "rate_eur_usd", "threshold"]),
}


def oracle_sql() -> dict[str, str]:
    return {k: base.build(STABLE(v, cols)) for k, (v, cols) in FINAL.items()}
