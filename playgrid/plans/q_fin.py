"""Query registrations: finance facts, balances, revenue by day, cohorts (M-10 .. M-21)."""

from playgrid.plans import cohorts, finance
from playgrid.plans.registry import Ctx, query


@query("fct_revenue")
def q_fct_revenue(spark, sf):
    return Ctx(spark, sf).build_rev()


@query("fct_economy")
def q_fct_economy(spark, sf):
    return Ctx(spark, sf, single=True).econ()


@query("currency_flows_daily")
def q_flows(spark, sf):
    return finance.currency_flows_daily(Ctx(spark, sf, single=True).econ())


@query("currency_balance_daily")
def q_balance(spark, sf):
    return finance.currency_balance_daily(finance.balance_snapshots(Ctx(spark, sf, single=True).final()))


@query("revenue_daily")
def q_revenue_daily(spark, sf):
    c = Ctx(spark, sf)
    return finance.revenue_daily(c.rev(), c.iap(), c.dau())


@query("cohort_daily")
def q_cohort_daily(spark, sf):
    c = Ctx(spark, sf)
    return cohorts.cohort_daily(c.dim(), c.stg(), c.rev(), c.iap(), c.as_of())


@query("cohort_daily_country")
def q_cohort_daily_country(spark, sf):
    c = Ctx(spark, sf)
    return cohorts.cohort_daily(c.dim(), c.stg(), c.rev(), c.iap(), c.as_of(), countries=("US", "PH"))


@query("cohort_daily_campaign")
def q_cohort_daily_campaign(spark, sf):
    return Ctx(spark, sf).build_campaign_grid()


@query("cohort_pu")
def q_cohort_pu(spark, sf):
    c = Ctx(spark, sf, single=True)
    return cohorts.cohort_pu(c.dim(), c.store(), c.as_of())


@query("cohort_pu_daily")
def q_cohort_pu_daily(spark, sf):
    c = Ctx(spark, sf, single=True)
    return cohorts.cohort_pu_daily(c.dim(), c.store(), c.as_of())


@query("forecast_input")
def q_forecast_input(spark, sf):
    return cohorts.forecast_input(Ctx(spark, sf).campaign_grid())
