"""Named queries: (spark, sf_dir) -> DataFrame, one per pipeline of the inventory.

Each callable derives the reference-shaped inputs from the driver tables of
``sf_dir`` and runs the pipeline on all of it. A mart that others read is a table,
built when first read and shared by the queries of a session (``Ctx.mat``); the
mart that a query returns is always computed by that query. The deduplicated
event log is such a table, in files sorted by day and event name, so readers
skip days, names and columns; a lone reader of a log that nobody has built yet
streams through it, with its filters below the deduplication.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playgrid.session import apply_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


class Ctx:
    """Memoised inputs and intermediate DataFrames for one (spark, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str, single: bool = False):
        """``single``: the query reads the event log once, so it streams through
        without building the deduplicated log first."""
        self.spark, self.sf_dir, self.single = spark, sf_dir, single
        self._m: dict[str, DataFrame] = {}

    def get(self, name: str, fn):
        if name not in self._m:
            self._m[name] = fn()
        return self._m[name]

    def mat(self, name: str, fn, **layout):
        """Like ``get``, but a table that the queries of a session share (see ``session.build_once``)."""
        from playgrid.session import build_once
        return self.get(name, lambda: build_once(self.spark, self.sf_dir, name, fn, **layout))

    # inputs
    def inp(self, name: str) -> DataFrame:
        """Reference-shaped input plan (analysed once per query, no data cached)."""
        from playgrid.sources import adapters as A
        fns = {"events": A.game_events, "profiles": A.raw_profiles, "accounts": A.raw_accounts,
               "transactions": A.raw_transactions, "rates": A.currency_rates,
               "backfill": A.iap_backfill, "user_props": A.user_props}
        return self.get(f"inp:{name}", lambda: fns[name](self.spark, self.sf_dir))

    def log_rows(self) -> int:
        """Rows of the raw event log: how many tasks deduplicate it and group its rows by player."""
        from playgrid.sources import adapters as A
        return self.get("log_rows", lambda: A.game_event_rows(self.spark, self.sf_dir))

    # staging / intermediate
    def final(self):
        """The deduplicated event log (FINAL read), in files ordered by day and event name.

        The deduplication has the rows in that order, so the table costs no further shuffle or sort; readers skip
        by the statistics of row groups and pages.
        """
        from playgrid.plans import staging as S
        build = lambda: S.events_final(self.inp("events"), self.log_rows())
        if self.single:
            return self.get("final", build)
        return self.mat("final", build, sort_by=["event_date", "name"])

    def stg(self):
        from playgrid.plans import staging as S
        return self.get("stg", lambda: S.stg_events(self.final()))

    def build_campaign(self):
        from playgrid.plans import staging as S
        return S.player_campaign(self.inp("profiles"), self.inp("accounts"))

    def campaign(self):
        return self.mat("campaign", self.build_campaign)

    def rates_usd(self):
        from playgrid.plans import staging as S
        return self.get("rates_usd", lambda: S.rates_usd(self.inp("rates")))

    def build_iap(self):
        from playgrid.plans import staging as S
        return S.iap_usd(self.final(), self.inp("transactions"), self.rates_usd())

    def iap(self):
        return self.mat("iap", self.build_iap)

    def as_of(self):
        """'Today' for the marts: the day after the last event day (a scalar subquery)."""
        from pyspark.sql import functions as F
        from playgrid.sources.tables import read
        return self.get("as_of", lambda: F.date_add(
            read(self.spark, self.sf_dir, "events").agg(F.max(F.to_date("ts"))).scalar(), 1))

    def build_rev(self):
        from playgrid.plans import finance
        return finance.fct_revenue(self.stg(), self.rates_usd(), self.campaign(), self.inp("backfill"), self.dim())

    def rev(self):
        return self.mat("rev", self.build_rev)

    def store(self):
        from playgrid.plans import staging as S
        return self.get("store", lambda: S.store_transactions(self.inp("transactions")))

    def dau(self):
        from playgrid.plans import core
        return self.get("dau", lambda: core.daily_active_users(self.stg(), self.dim()))

    def econ(self):
        from playgrid.plans import finance
        return self.get("econ", lambda: finance.fct_economy(self.stg(), self.campaign()))

    def build_campaign_grid(self):
        from playgrid.plans import cohorts
        return cohorts.cohort_daily_campaign(self.dim(), self.rev(), self.iap(), self.as_of())

    def campaign_grid(self):
        return self.mat("cgrid", self.build_campaign_grid)

    def build_dim(self):
        from playgrid.plans import core
        return core.dim_players(self.final(), self.campaign(), self.log_rows())

    def dim(self):
        return self.mat("dim", self.build_dim)


def stable(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every DOUBLE column of a result (float summation-order noise guard).

    Applied where results are compared (``__spark_entry__``); the library's queries
    keep full precision. The oracle applies the same rounding to the same columns.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import DoubleType, FloatType
    cols = [F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)

