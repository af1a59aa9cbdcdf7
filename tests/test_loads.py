"""Loads into an existing target (K-04 .. K-07, K-09 .. K-13): what they replace, what they leave, re-runs, counts."""

import datetime as dt
import hashlib
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from playgrid.operators import loads, sinks
from playgrid.plans import finance, q_loads, staging
from playgrid.plans.registry import Ctx

SF = "/root/testdata/sf0.001"
D = lambda x: dt.date(2024, 1, x)


def files(path):
    """Content hash of every data file of a target."""
    out = {}
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(d, n), "rb") as f:
                    out[os.path.relpath(os.path.join(d, n), path)] = hashlib.sha256(f.read()).hexdigest()
    return out


def day_of(name):
    return dt.date.fromisoformat(name.split("event_date=")[1][:10])


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_trailing_window(spark, scratch):
    """Keys of the new rows are replaced, others of the window stay, older days keep their files, new columns are added."""
    path = os.path.join(scratch, "t")
    kind = "event_date date, k string, v int"
    old = spark.createDataFrame([(D(d), k, d) for d in range(1, 6) for k in "ab"] + [(D(4), None, 4)], kind)
    new = spark.createDataFrame([(D(3), "a", 30, "x"), (D(4), None, 40, "y"), (D(6), "c", 60, None), (D(2), "a", 99, "no")],
                                kind + ", note string")
    assert loads.load_trailing(spark, path, lambda since: old, ["k"]) == (11, 11)
    before = files(path)
    for _ in range(2):
        assert loads.load_trailing(spark, path, lambda since: new.filter(new.event_date >= since), ["k"])[0] == (3 if _ == 0 else 2)
        if not _:
            once = rows(loads.existing(spark, path), "event_date", "k", "v", "note")
    got = loads.existing(spark, path)
    assert rows(got, "event_date", "k", "v", "note") == once
    want = {(D(d), k): (d, None) for d in range(1, 6) for k in "ab"} | {
        (D(3), "a"): (30, "x"), (D(4), None): (40, "y"), (D(6), "c"): (60, None)}
    assert {(r.event_date, r.k): (r.v, r.note) for r in got.collect()} == want
    assert {n: h for n, h in files(path).items() if day_of(n) in (D(1), D(2), D(5))} == {
        n: h for n, h in before.items() if day_of(n) in (D(1), D(2), D(5))}
    assert got.columns[-1] == "event_date" and set(got.columns) == {"event_date", "k", "v", "note"}


def test_economy_load_equals_full_build(spark, scratch):
    path, c = os.path.join(scratch, "economy"), Ctx(spark, SF)
    events = c.inp("events")
    last = q_loads._last_day(events)
    key = ["event_id", "currency"]
    loads.load_trailing(spark, path, q_loads.economy_rows(c, q_loads.earlier_log(events, last)), key)
    state = files(path)
    full = c.econ()
    cols = sorted(full.columns)
    assert rows(loads.existing(spark, path), *cols) != rows(full, *cols)
    done = loads.load_trailing(spark, path, q_loads.economy_rows(c, events), key)
    assert rows(loads.existing(spark, path), *cols) == rows(full, *cols)
    since = max(map(day_of, state)) - dt.timedelta(days=2)
    after = files(path)
    assert {n: h for n, h in after.items() if day_of(n) < since} == {n: h for n, h in state.items() if day_of(n) < since}
    assert done.loaded == done.written == full.filter(full.event_date >= since).count()
    loads.load_trailing(spark, path, q_loads.economy_rows(c, events), key)
    assert rows(loads.existing(spark, path), *cols) == rows(full, *cols)


def test_filters_reach_below_the_deduplication(spark):
    """The window's start, and the event names that a mart reads, stand below the log's dedup window."""
    c = Ctx(spark, SF, single=True)
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    log = staging.events_final(q_loads._since(c.inp("events"), D(10)))
    assert re.search("Window.*Filter.*2024-01-10", text(finance.balance_snapshots(log)), re.S)
    assert re.search("Window.*Filter.*resource_top_up", text(staging.int_economy(c.stg())), re.S)


def test_log_is_pruned_by_day_and_name(spark):
    """A reader of the shared log skips days by partition and names by the files' statistics."""
    log = Ctx(spark, SF).final().filter("event_date = DATE '2024-01-10' AND name = 'revenue'").select("player_id")
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,revenue)" in plan and re.search(r"PartitionFilters: \[[^]]*event_date", plan)
    assert re.search(r"ReadSchema: struct<name:string,player_id:string>", plan)


def test_empty_target_and_no_rows(spark, scratch):
    path = os.path.join(scratch, "t")
    none = spark.createDataFrame([], "event_date date, k string")
    assert loads.existing(spark, path) is None
    assert loads.load_trailing(spark, path, lambda since: none, ["k"]) == (0, 0)
    some = spark.createDataFrame([(D(d), "a") for d in range(1, 9)], "event_date date, k string")
    assert loads.load_trailing(spark, path, lambda since: some, ["k"], first_day=D(5)).loaded == 4
    assert rows(loads.existing(spark, path), "event_date") == [(D(d),) for d in range(5, 9)]
    assert loads.load_trailing(spark, path, lambda since: none, ["k"]) == (0, 0)
    assert loads.existing(spark, path).count() == 4


def test_upsert(spark, scratch):
    path = os.path.join(scratch, "t")
    kind = "k int, v string, ver int"
    a = spark.createDataFrame([(i, "old", 5) for i in range(200)] + [(None, "null", 1)], kind)
    b = spark.createDataFrame([(3, "new", 6), (4, "older", 4), (5, "same", 5), (500, "first", 1), (500, "last", 2),
                               (None, "null2", 1)], kind)
    assert loads.upsert(path, a, ["k"], ["ver"], buckets=16) == (201, 201)
    before = files(path)
    loads.upsert(path, b, ["k"], ["ver"], buckets=16)
    got = loads.upserted(spark, path)
    want = {i: "old" for i in range(200)} | {None: "null2", 3: "new", 5: "same", 500: "last"}
    assert {r.k: r.v for r in got.collect()} == want and got.columns == ["k", "v", "ver"]
    touched = {r[0] for r in loads.existing(spark, path).join(b.select("k").distinct(), "k").select("bucket16").distinct().collect()}
    after = files(path)
    same = {n for n in before if before[n] == after.get(n)}
    assert {int(n.split("=")[1].split("/")[0]) for n in before if n not in same} <= touched | {
        r[0] for r in loads.existing(spark, path).filter("k is null").select("bucket16").collect()}
    assert same
    loads.upsert(path, b, ["k"], ["ver"], buckets=16)
    assert {r.k: r.v for r in loads.upserted(spark, path).collect()} == want
    loads.upsert(path, b.filter("k = 4"), ["k"], buckets=16)  # without a version the incoming row wins
    assert loads.upserted(spark, path).filter("k = 4").first().v == "older"
    with pytest.raises(ValueError):
        loads.upsert(path, b, ["k"], ["ver"], buckets=8)


def test_upsert_adds_columns(spark, scratch):
    path = os.path.join(scratch, "t")
    loads.upsert(path, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], buckets=4)
    loads.upsert(path, spark.createDataFrame([(2, "c", 9)], "k int, v string, extra int"), ["k"], buckets=4)
    assert rows(loads.upserted(spark, path), "k", "v", "extra") == [(1, "a", None), (2, "c", 9)]


def test_backfill_replaces_its_range_only(spark, scratch):
    path, events = os.path.join(scratch, "balance"), Ctx(spark, SF).inp("events")
    log = staging.events_final(events)
    full = finance.currency_balance_daily(finance.balance_snapshots(log))
    cols = sorted(full.columns)
    days = [r[0] for r in full.select("event_date").distinct().orderBy("event_date").collect()]
    d_from, d_to = days[2], days[-3]
    stale = full.withColumn("players", full.players + 1000)
    loads.put(stale, path, ["event_date"])
    before = files(path)
    fresh = finance.balance_backfill(log.filter(log.event_date != days[4]), str(d_from), str(d_to))
    for _ in range(2):
        done = loads.replace_range(path, fresh, d_from, d_to)
        assert done.loaded == fresh.count()
        got = loads.existing(spark, path)
        inside = got.event_date.between(d_from, d_to)
        assert rows(got.filter(inside), *cols) == rows(fresh, *cols)
        assert got.filter(got.event_date == days[4]).count() == 0
        outside = lambda f: {n: h for n, h in f.items() if not d_from <= day_of(n) <= d_to}
        assert outside(files(path)) == outside(before) and len(outside(before)) >= 4


def test_ledger_appends_once(spark, scratch):
    path = os.path.join(scratch, "ledger")
    batch = lambda *keys: spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "alert_key string, x int")
    keys = lambda: sorted((r.alert_key, r.batch_id) for r in spark.read.parquet(path).collect())
    assert loads.append_once(path, batch("k1", "k2", "k2"), ["alert_key"], 0).loaded == 2
    assert loads.append_once(path, batch("k2", "k3"), ["alert_key"], 1).loaded == 1
    assert loads.append_once(path, batch("k2", "k3"), ["alert_key"], 1).loaded == 1  # the batch again
    assert loads.append_once(path, batch("k1"), ["alert_key"], 2).loaded == 0
    assert keys() == [("k1", 0), ("k2", 0), ("k3", 1)]


def test_month_layout_prunes(spark, scratch):
    path = os.path.join(scratch, "levels")
    data = [(dt.date(2024, m, d), d % 3, f"p{d}") for m in (1, 2, 3) for d in range(1, 29)]
    df = loads.by_month(spark.createDataFrame(data, "event_date date, chapter_key int, player_id string"))
    assert loads.put(df, path, ["yyyymm"], ["event_date", "chapter_key"], mode="static") == (84, 84)
    got = spark.read.parquet(path).filter(loads.months(dt.date(2024, 2, 3), dt.date(2024, 2, 20)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan and got.count() == 28
    read = {r[0] for r in got.select(F.input_file_name()).distinct().collect()}
    assert {f.split("yyyymm=")[1][:6] for f in read} == {"202402"}
    for f in read:
        order = pq.read_table(f.replace("file://", "")).select(["event_date", "chapter_key"]).to_pylist()
        assert order == sorted(order, key=lambda r: (r["event_date"], r["chapter_key"]))


def test_full_builds(spark, scratch):
    """K-01, K-02, K-10: a full build replaces the whole table; a view follows its table."""
    path = os.path.join(scratch, "t")
    sinks.overwrite(spark.range(5).selectExpr("id", "id % 2 AS day"), path, ["day"])
    sinks.overwrite(spark.range(3).selectExpr("id", "id % 2 + 7 AS day"), path, ["day"], ["id"])
    assert rows(spark.read.parquet(path), "id", "day") == [(0, 7), (1, 8), (2, 7)]
    sinks.view(spark.read.parquet(path), "built")
    assert spark.sql("SELECT count(*) AS n FROM built").first().n == 3
