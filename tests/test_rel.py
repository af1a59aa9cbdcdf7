"""Rank selection, activity windows and sketches against brute force."""

import datetime as dt
import random
import statistics

import pytest

from playgrid.operators.rel import grouped_median
from playgrid.plans import core, finance


@pytest.mark.parametrize("low,high", [(0, 1), (-5, 9), (0, 4095), (-70_000, 10**6), (10**15, 10**15 + 3), (-(1 << 63), (1 << 63) - 1)])
def test_grouped_median(spark, low, high):
    rng = random.Random(high % 97)
    data, groups = [], {}
    for k, n in [(None, 3), ("a", 1), ("b", 2), ("c", 101), ("d", 400), ("hot", 900)]:
        values = [rng.choice([low, high, rng.randint(low, high)]) for _ in range(n)]
        groups[k] = float(sum(map(float, sorted(values)[(n - 1) // 2:n // 2 + 1])) / (2 if n % 2 == 0 else 1))
        data += [(k, v, 1) for v in values]
    counts = spark.createDataFrame(data, "k string, v long, n long").groupBy("k", "v").sum("n").withColumnRenamed("sum(n)", "n")
    got = {r.k: r.median for r in grouped_median(counts, ["k"], "v", "n").collect()}
    assert got == pytest.approx(groups, rel=1e-15)
    assert grouped_median(counts.limit(0), ["k"], "v", "n").collect() == []


def test_balance_has_no_percentile_buffer(spark):
    rows = [(dt.date(2024, 1, d), f"p{i % 7}", c, b) for d in (1, 2) for c in ("Gems", "Gold") for i, b in enumerate([5, 1, 9, 9, -3, 700][:4 + d])]
    df = finance.currency_balance_daily(spark.createDataFrame(rows, "event_date date, player_id string, currency string, balance long"))
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "percentile" not in plan and "median(" not in plan and "expand" not in plan
    got = {(r.event_date.day, r.currency): r for r in df.collect()}
    for key, r in got.items():
        own = [x for x in rows if (x[0].day, x[2]) == key]
        b = [x[3] for x in own]
        assert (r.median_balance, r.min_balance, r.max_balance, r.players) == (
            statistics.median(b), min(b), max(b), len({x[1] for x in own}))
        assert r.avg_balance == pytest.approx(round(sum(b) / len(b), 2))


def days(rng, players, span):
    first = dt.date(2024, 1, 1)
    return {(f"p{p}", first + dt.timedelta(days=rng.randrange(span))) for p in range(players) for _ in range(rng.randint(1, 6))}


def brute(seen, n):
    return {e: len({p for p, d in seen if 0 <= (e - d).days < n}) for e in {d for _, d in seen}}


def test_activity_windows(spark):
    seen = days(random.Random(3), 60, 120)
    df = spark.createDataFrame([*seen, *list(seen)[:20]], "player_id string, event_date date")
    out = core.activity_windows(df)
    assert {r.event_date: (r.dau, r.wau, r.mau) for r in out.collect()} == {
        e: (brute(seen, 1)[e], brute(seen, 7)[e], brute(seen, 30)[e]) for e in {d for _, d in seen}}
    assert "sequence" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_within_error(spark):
    """30,000 players, far more than a sketch holds exactly: unions of day sketches stay within the stated error."""
    seen = days(random.Random(4), 30_000, 40)
    sketches = core.day_sketches(spark.createDataFrame(list(seen), "player_id string, event_date date"))
    for r in core.approx_windows(sketches).collect():
        for name, n in (("dau", 1), ("wau", 7), ("mau", 30)):
            want = len({p for p, d in seen if 0 <= (r.event_date - d).days < n})
            assert abs(r[name] - want) <= core.SKETCH_ERROR * want
    assert sketches.selectExpr("max(length(players))").first()[0] < 20_000
