"""Parameters of the jobs, read from the session as ``spark.playgrid.<name>`` with these defaults (X-04)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

DEFAULTS = {
    "clan_start_date": dt.date(2024, 1, 3),
    "alert_lookback_days": 90,  # arrivals that an alert run looks at
    "alert_since": "",  # a time instead of the look-back
    "alert_dry_run": False,  # alerts are worked out but no ledger is written
    "alert_threshold_scale": 1.0,  # thresholds are multiplied by it
    "fx_lookback_days": 14,
    "fx_customer": "main",
    "trailing_days": 2,  # re-loaded days of an incremental mart
    "reread_days": 60,  # re-read days of the affiliate network
    "backfill_from": dt.date(2024, 1, 1),
    "backfill_to": dt.date(2024, 1, 31),
}


def param(spark: SparkSession, name: str):
    """The session's value of a parameter, in the type of its default."""
    default = DEFAULTS[name]
    text = spark.conf.get(f"spark.playgrid.{name}", None)
    if text is None:
        return default
    if isinstance(default, bool):
        if text.lower() not in ("true", "false"):
            raise ValueError(f"spark.playgrid.{name} must be true or false, not {text!r}")
        return text.lower() == "true"
    return dt.date.fromisoformat(text) if isinstance(default, dt.date) else type(default)(text)
