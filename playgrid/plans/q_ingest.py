"""Query registrations: landed API ingest (M-39 .. M-42)."""

from playgrid.plans.registry import query
from playgrid.sources import ingest


@query("conversions")
def q_conversions(spark, sf):
    return ingest.conversions(ingest.api_conversions(spark, sf))


@query("daily_stats")
def q_daily_stats(spark, sf):
    return ingest.daily_stats(ingest.api_stats(spark, sf))


@query("daily_stats_by")
def q_daily_stats_by(spark, sf):
    return ingest.daily_stats_by(ingest.api_stats(spark, sf))


@query("currency_rates")
def q_currency_rates(spark, sf):
    import uuid

    from playgrid.session import checkpoint_dir
    stage = f"{checkpoint_dir(spark).rstrip('/')}/landing/currency_rates-{uuid.uuid4().hex[:12]}"
    return ingest.currency_rates_etl(ingest.api_rate_docs(spark, sf), stage_dir=stage)
