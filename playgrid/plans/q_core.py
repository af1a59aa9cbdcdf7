"""Query registrations: staging, intermediate and core marts (M-01 .. M-09)."""

from pyspark.sql import functions as F

from playgrid.plans import core, staging as S
from playgrid.plans.registry import Ctx, query


@query("stg_events")
def q_stg_events(spark, sf):
    return Ctx(spark, sf, single=True).stg()


@query("int_revenue")
def q_int_revenue(spark, sf):
    return S.int_revenue(Ctx(spark, sf, single=True).stg())


@query("int_economy")
def q_int_economy(spark, sf):
    return S.int_economy(Ctx(spark, sf, single=True).stg())


@query("rates_usd")
def q_rates_usd(spark, sf):
    return Ctx(spark, sf, single=True).rates_usd()


@query("player_campaign")
def q_player_campaign(spark, sf):
    return Ctx(spark, sf, single=True).build_campaign()


@query("iap_usd")
def q_iap_usd(spark, sf):
    return Ctx(spark, sf, single=True).build_iap()


@query("dim_players")
def q_dim_players(spark, sf):
    return Ctx(spark, sf, single=True).build_dim()


@query("daily_active_users")
def q_dau(spark, sf):
    c = Ctx(spark, sf)
    return core.daily_active_users(c.stg(), c.dim())


@query("activity_windows")
def q_activity_windows(spark, sf):
    c = Ctx(spark, sf, single=True)
    return core.activity_windows(c.stg())


@query("activity_approx")
def q_activity_approx(spark, sf):
    """Approximate windows over the days' stored sketches beside the exact ones, and whether they are within the stated error."""
    from playgrid.session import materialize
    activity = Ctx(spark, sf, single=True).stg().select("player_id", "event_date")
    activity = materialize(activity.distinct(), "player_days")
    near = core.approx_windows(materialize(core.day_sketches(activity), "sketches")).withColumnsRenamed(
        {c: f"{c}_approx" for c in ("dau", "wau", "mau")})
    both = core.activity_windows(activity).join(near, "event_date", "left")
    return both.select("event_date", "dau", "wau", "mau", *(
        F.coalesce(F.abs(F.col(f"{c}_approx") - F.col(c)) <= F.ceil(F.col(c) * core.SKETCH_ERROR), F.lit(False)).alias(f"{c}_within_error")
        for c in ("dau", "wau", "mau")))
