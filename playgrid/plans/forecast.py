"""Forecast marts (M-22, M-23): per-segment trend of cumulative ARPU and the
log-regression ARPU forecast anchored at day 7.

The reference fits a Bayesian trend model per segment in a driver-side
loop. Here the trend is a least-squares line per segment (re-aimed: the
fitting library is not part of this engine; contract = shape, horizon 1..60,
clamp at 0, segments with < 2 points skipped). It is computed with the
built-in ``regr_slope`` / ``regr_intercept`` aggregates (partial aggregation,
JVM-side); ``trend_forecast_pandas`` is the same fit as a grouped
``applyInPandas`` (one segment = at most 31 points, a bounded group).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.functions.cols import safe_div

SEG = ["cohort_version", "country", "campaign"]
HORIZON = 60
ANCHOR = 7


def _gz(x: Column) -> Column:
    """greatest(0, x), NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), x))


def _days(df: DataFrame, n: int = HORIZON) -> DataFrame:
    """Each segment row x days 1..n (bounded explode, no cross join)."""
    return df.withColumn("day_since_install", F.explode(F.sequence(F.lit(1), F.lit(n))))


def trend_forecast(fc_input: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """M-22: per segment, linear trend of cum_ad_arpu / cum_arpu over day of life, days 1..horizon."""
    x = F.col("day_since_install").cast("double")
    fit = fc_input.groupBy(*SEG).agg(
        F.count("cum_ad_arpu").alias("n_ad"), F.count("cum_arpu").alias("n_tot"),
        F.regr_slope("cum_ad_arpu", x).alias("b_ad"), F.regr_intercept("cum_ad_arpu", x).alias("a_ad"),
        F.regr_slope("cum_arpu", x).alias("b_tot"), F.regr_intercept("cum_arpu", x).alias("a_tot"))
    fit = fit.filter((F.col("n_ad") >= 2) | (F.col("n_tot") >= 2))
    d = F.col("day_since_install").cast("double")

    def pred(n, a, b):
        return F.when(F.col(n) >= 2, F.greatest(F.lit(0.0), F.col(a) + F.col(b) * d)).otherwise(F.lit(0.0))

    return _days(fit, horizon).select(
        *SEG, "day_since_install",
        pred("n_ad", "a_ad", "b_ad").alias("prophet_cum_ad_arpu"),
        pred("n_tot", "a_tot", "b_tot").alias("prophet_cum_arpu"))


def _fit_group(pdf: pd.DataFrame, horizon: int = HORIZON) -> pd.DataFrame:
    days = np.arange(1, horizon + 1, dtype="float64")
    out = {}
    ok = False
    for col, name in (("cum_ad_arpu", "prophet_cum_ad_arpu"), ("cum_arpu", "prophet_cum_arpu")):
        d = pdf[["day_since_install", col]].dropna()
        if len(d) < 2:
            out[name] = np.zeros(horizon)
            continue
        ok = True
        xs, ys = d["day_since_install"].to_numpy("float64"), d[col].to_numpy("float64")
        xm, ym = xs.mean(), ys.mean()
        b = ((xs - xm) * (ys - ym)).sum() / ((xs - xm) ** 2).sum()
        out[name] = np.maximum(0.0, ym - b * xm + b * days)
    if not ok:
        return pd.DataFrame(columns=[*SEG, "day_since_install", "prophet_cum_ad_arpu", "prophet_cum_arpu"])
    key = {k: pdf[k].iloc[0] for k in SEG}
    return pd.DataFrame({**{k: [v] * horizon for k, v in key.items()},
                         "day_since_install": days.astype("int32"), **out})


def trend_forecast_pandas(fc_input: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """X-02: the same trend as a grouped-map Pandas UDF (Arrow batches per segment)."""
    schema = ("cohort_version string, country string, campaign string, day_since_install int, "
              "prophet_cum_ad_arpu double, prophet_cum_arpu double")
    return (fc_input.select(*SEG, "day_since_install", "cum_ad_arpu", "cum_arpu")
            .groupBy(*SEG).applyInPandas(lambda p: _fit_group(p, horizon), schema))


def arpu_forecast(grid: DataFrame, trend: DataFrame, min_installs: int = 20, anchor: int = ANCHOR) -> DataFrame:
    """M-23: observed / forecast / best / trend cumulative ARPU per segment, days 1..60.

    Slope b from cum_arpu ~ a + b*ln(day) over the fixed-cohort window
    1..H (H = min(14, oldest cohort age)), anchored at the observed day-7
    value; the last observed day is trimmed from the observed line when it
    drops more than 10 % below the day before.
    """
    big = (grid.filter(F.col("day_since_install") == 0).groupBy(*SEG)
           .agg(F.sum("cohort_size").alias("_n")).filter(F.col("_n") >= min_installs).select(*SEG))
    src = grid.join(big, SEG, "left_semi")
    seg_h = src.groupBy(*SEG).agg(
        F.least(F.lit(14), F.max("cohort_age_days")).alias("H"),
        F.least(F.lit(30), F.max("cohort_age_days")).alias("last_obs_day"))
    pts = (src.join(seg_h, SEG)
           .filter((F.col("cohort_age_days") >= F.col("H")) & F.col("day_since_install").between(1, F.col("H")))
           .groupBy(*SEG, "day_since_install")
           .agg((F.sum("cum_ad_revenue") / F.sum("cohort_size")).alias("y_ad"),
                (F.sum("cum_total_revenue") / F.sum("cohort_size")).alias("y_tot")))
    lx = F.ln(F.col("day_since_install").cast("double"))
    reg = pts.groupBy(*SEG).agg(F.regr_slope("y_ad", lx).alias("b_ad"), F.regr_slope("y_tot", lx).alias("b_tot"),
                                F.count(F.lit(1)).alias("fit_points"))
    obs = src.groupBy(*SEG, "day_since_install").agg(
        (F.sum("cum_ad_revenue") / F.sum("cohort_size")).alias("obs_ad"),
        (F.sum("cum_total_revenue") / F.sum("cohort_size")).alias("obs_tot"))
    anch = obs.filter(F.col("day_since_install") == anchor).select(
        *SEG, F.col("obs_ad").alias("anch_ad"), F.col("obs_tot").alias("anch_tot"))
    # last two observed days per segment -> trim day (one aggregate, no window)
    last2 = obs.groupBy(*SEG).agg(
        F.max_by(F.struct("day_since_install", "obs_tot"), "day_since_install").alias("l1"),
        F.max("day_since_install").alias("_dmax"))
    prev = obs.join(last2.select(*SEG, "_dmax"), SEG).filter(F.col("day_since_install") < F.col("_dmax")) \
        .groupBy(*SEG).agg(F.max_by("obs_tot", "day_since_install").alias("o2"))
    trim = last2.join(prev, SEG, "left").select(
        *SEG, F.when((F.col("o2") > 0) & (F.col("l1.obs_tot") < F.col("o2") * 0.90), F.col("l1.day_since_install"))
        .otherwise(F.lit(-1)).alias("trim_day"))
    d = F.col("day_since_install")
    base = (_days(reg).join(seg_h.select(*SEG, "last_obs_day"), SEG).join(anch, SEG)
            .join(obs, SEG + ["day_since_install"], "left").join(trim, SEG, "left")
            .join(trend, SEG + ["day_since_install"], "left"))
    lnd = F.ln(d.cast("double")) - F.lit(float(np.log(anchor)))
    fut = d > F.col("last_obs_day")
    hide = fut | (d == F.col("trim_day"))
    f_ad = _gz(F.col("anch_ad") + F.col("b_ad") * lnd)
    f_tot = _gz(F.col("anch_tot") + F.col("b_tot") * lnd)
    p_ad, p_tot = F.col("prophet_cum_ad_arpu"), F.col("prophet_cum_arpu")
    fc = base.select(
        *SEG, "day_since_install", "fit_points",
        F.when(~hide, F.col("obs_ad")).alias("observed_cum_ad_arpu"),
        F.when(~hide, F.col("obs_tot")).alias("observed_cum_arpu"),
        f_ad.alias("forecast_cum_ad_arpu"), f_tot.alias("forecast_cum_arpu"),
        F.when(fut, f_ad).otherwise(F.col("obs_ad")).alias("best_cum_ad_arpu"),
        F.when(fut, f_tot).otherwise(F.col("obs_tot")).alias("best_cum_arpu"),
        p_ad.alias("prophet_cum_ad_arpu"), p_tot.alias("prophet_cum_arpu"),
        F.when(fut, p_ad).otherwise(F.col("obs_ad")).alias("prophet_obs_cum_ad_arpu"),
        F.when(fut, p_tot).otherwise(F.col("obs_tot")).alias("prophet_obs_cum_arpu"),
        F.when(fut, _gz(p_tot - p_ad)).otherwise(_gz(F.col("obs_tot") - F.col("obs_ad"))).alias("prophet_obs_cum_iap_arpu"),
        fut.cast("int").alias("is_forecast"))
    iap = lambda t, a: _gz(F.col(t) - F.col(a))
    return fc.select(
        "*",
        iap("observed_cum_arpu", "observed_cum_ad_arpu").alias("observed_cum_iap_arpu"),
        iap("forecast_cum_arpu", "forecast_cum_ad_arpu").alias("forecast_cum_iap_arpu"),
        iap("best_cum_arpu", "best_cum_ad_arpu").alias("best_cum_iap_arpu"),
        iap("prophet_cum_arpu", "prophet_cum_ad_arpu").alias("prophet_cum_iap_arpu"),
        iap("observed_cum_arpu", "observed_cum_ad_arpu").alias("observed_iap"),
        iap("best_cum_arpu", "best_cum_ad_arpu").alias("forecast_iap"))


__all__ = ["trend_forecast", "trend_forecast_pandas", "arpu_forecast", "safe_div"]
