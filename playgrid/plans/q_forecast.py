"""Query registrations: trend forecast and ARPU forecast (M-22, M-23)."""

from playgrid.plans import cohorts, forecast
from playgrid.plans.registry import Ctx, query


def _trend(c: Ctx):
    return c.mat("trend", lambda: forecast.trend_forecast(cohorts.forecast_input(c.campaign_grid())))


@query("trend_forecast")
def q_trend_forecast(spark, sf):
    return _trend(Ctx(spark, sf))


@query("arpu_forecast")
def q_arpu_forecast(spark, sf):
    c = Ctx(spark, sf)
    return forecast.arpu_forecast(c.campaign_grid(), _trend(c))
