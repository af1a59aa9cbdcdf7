"""Query registrations: BI marts and progression (M-24 .. M-33)."""

from playgrid.plans import bi
from playgrid.plans.registry import Ctx, query


@query("ad_placement_version")
def q_ad_placement_version(spark, sf):
    return bi.ad_placement(Ctx(spark, sf).rev())


@query("ad_placement_country")
def q_ad_placement_country(spark, sf):
    return bi.ad_placement(Ctx(spark, sf).rev(), by_country=("US", "PH"))


@query("ad_segment")
def q_ad_segment(spark, sf):
    c = Ctx(spark, sf)
    return bi.ad_segment(c.dim(), c.inp("user_props"))


@query("bi_activity")
def q_bi_activity(spark, sf):
    c = Ctx(spark, sf)
    return bi.bi_activity(c.final(), c.dim())


@query("bi_ads")
def q_bi_ads(spark, sf):
    c = Ctx(spark, sf, single=True)
    return bi.bi_ads(c.final(), c.campaign())


@query("bi_gem_flows")
def q_bi_gem_flows(spark, sf):
    c = Ctx(spark, sf, single=True)
    return bi.bi_gem_flows(c.final(), c.campaign())


@query("bi_iap")
def q_bi_iap(spark, sf):
    c = Ctx(spark, sf)
    return bi.bi_iap(c.iap(), c.dim())


@query("bi_revenue")
def q_bi_revenue(spark, sf):
    c = Ctx(spark, sf)
    return bi.bi_revenue(bi.bi_ads(c.final(), c.campaign()), bi.bi_iap(c.iap(), c.dim()))


@query("fct_level_events")
def q_fct_level_events(spark, sf):
    c = Ctx(spark, sf, single=True)
    return bi.fct_level_events(c.final(), c.campaign())


@query("level_funnel_daily")
def q_level_funnel_daily(spark, sf):
    c = Ctx(spark, sf, single=True)
    return bi.level_funnel_daily(bi.fct_level_events(c.final(), c.campaign()))
