"""Shapes of plans and layouts that keep time and volume in proportion to the input."""

import contextlib
import glob
import io

import pytest
from pyspark.sql import functions as F

from playgrid import session
from playgrid.operators import loads, rel
from playgrid.plans import clans, core, staging
from playgrid.plans.q_ops import q_dq_report
from playgrid.plans.q_streams import Landing
from playgrid.plans.registry import Ctx
from playgrid.sources import ingest
from playgrid.sources.tables import spread


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_window_dedup_sorts_nothing_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"), (None, 1, "u"), (None, 3, "v")],
                               "k string, v int, x string")
    last = rel.latest_version(df, ["k"], ["v"], method="window")
    assert "WindowGroupLimit" not in plan(last)
    assert {tuple(r) for r in last.collect()} == {("a", 2, "y"), ("b", None, "z"), (None, 3, "v")}


def test_scan_is_spread_by_its_rows(spark):
    parts = spread(spark.range(250_000).coalesce(1), "id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 3 and sum(r["count"] for r in parts) == 250_000
    assert spread(spark.range(10).coalesce(1), "id").select(F.spark_partition_id()).distinct().count() == 1


def test_filters_on_parsed_columns_stay_above_the_spread(spark, scratch):
    spark.range(250_000).coalesce(1).write.parquet(f"{scratch}/t")
    rows = spread(spark.read.parquet(f"{scratch}/t"), "id").select(F.concat(F.lit('{"a":'), "id", F.lit("}")).alias("data"))
    text = plan(rows.filter(F.get_json_object("data", "$.a") == "7"))
    assert "get_json_object" not in text[text.index("Exchange"):]
    assert rows.filter(F.get_json_object("data", "$.a") == "7").count() == 1


def test_player_payload_is_parsed_once(spark):
    ev = spark.createDataFrame(
        [("2024-01-01 10:00:00", "revenue", "p1", "s", "i1", '{"country":"US","version":"1.0.22","revenue":"1,5","type":"purchase"}'),
         ("2024-01-02 10:00:00", "pause", "p1", "s2", "i2", '{"country":"","chapter":3,"abVersion":"B"}'),
         ("2024-01-03 10:00:00", "pause", "p1", "s2", "i3", None)],
        "event_at string, name string, player_id string, session_id string, id string, properties string")
    ev = ev.withColumn("event_at", F.col("event_at").cast("timestamp_ntz"))
    camp = spark.createDataFrame([], "player_id string, campaign_name string, install_country string, platform string, "
                                     "first_version string, install_date date, is_test_profile boolean")
    dim = core.dim_players(ev, camp)
    assert "get_json_object" not in plan(dim)
    r = dim.first()
    assert (r.country, r.app_version, r.ab_version, r.current_chapter, r.ltv, r.is_payer, r.total_sessions, r.active_days) == (
        "US", "1.0.22", "B", 3, 1.5, True, 2, 3)


def test_store_payload_is_parsed_as_a_whole(spark):
    rows = spark.createDataFrame([('{"type":"IAP","status":"RECORDED","profileId":"p1","occurredAt":"2024-01-12T05:15:00Z","usdAmount":12.5,"productId":"a"}',),
                                  ('{"type":"IAP","status":"PENDING","profileId":"p2"}',), (None,),
                                  ('{"type":"IAP","status":"RECORDED","profileId":"p3","occurredAt":"not a time"}',)], "data string")
    store = staging.store_transactions(rows)
    assert "get_json_object" not in plan(store)
    assert [(r[0], str(r[1]), r[2], r[3]) for r in store.orderBy("player_id").collect()] == [
        ("p1", "2024-01-12", 12.5, "a"), ("p3", "None", 0.0, "")]


def test_rows_of_one_partition_are_written_by_their_own_tasks(spark, scratch):
    rows = spark.range(100).repartition(4).withColumn("batch_id", F.lit(3))
    assert loads.put(rows, f"{scratch}/t", ["batch_id"], gather=False) == (100, 100)
    assert len(glob.glob(f"{scratch}/t/batch_id=3/*.parquet")) == 4


@pytest.mark.parametrize("most", [None, 6])
def test_stream_over_a_shared_history_has_a_bounded_number_of_batches(spark, most):
    land, seen = Landing(spark.range(30).repartition(30), "growth"), []
    run = land.stream(most).writeStream.foreachBatch(lambda df, i: seen.append(df.count()))
    run.option("checkpointLocation", f"{land.state}-{most}").trigger(availableNow=True).start().awaitTermination()
    assert sum(seen) == 30 and (len(seen) <= 6 if most else len(seen) == -(-len(land.table().inputFiles()) // 2) > 6)


def test_conversions_are_compared_before_they_are_parsed(spark):
    pages = spark.createDataFrame([(0, 0, '{"conversion_id":1,"payout":2.5,"goal":{"id":7}}'), (1, 0, '{"conversion_id":1,"payout":"x"}'),
                                   (0, 1, '{"conversion_id":2,"status":"ok"}'), (0, 2, "no record"), (0, 3, None)], "page long, pos long, body string")
    got = ingest.conversions(pages)
    assert "SortAggregate" not in plan(got)
    rows = {r.conversion_id: r for r in got.collect()}
    assert set(rows) == {1, 2, None} and rows[1].raw == '{"conversion_id":1,"payout":"x"}' and rows[2].status == "ok"


def events(spark, n):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 90000)").alias("ts"),
        (F.col("id") % 97).alias("user_id"), F.element_at(F.array(*map(F.lit, ("purchase", "click", "view", "error", "signup"))),
                                                          (F.col("id") % 5 + 1).cast("int")).alias("event_type"),
        F.lit(1.5).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 80, F.lit("}")).alias("props"))


def test_log_is_deduplicated_by_tasks_that_hold_a_bounded_number_of_rows(spark, scratch):
    events(spark, 40_000).write.parquet(f"{scratch}/events.parquet")
    log = Ctx(spark, scratch, single=True).final()
    assert log.rdd.getNumPartitions() == 3  # 120,000 wide rows; Spark's choice would be by compressed size
    key, raw = staging.EVENT_KEY, Ctx(spark, scratch).inp("events")
    assert log.count() == raw.select(*key).distinct().count() == log.select(*key).distinct().count() < raw.count()
    late = raw.groupBy(*key).agg(F.max(F.struct("received_at", "seq")).alias("v")).select(*key, "v.*")
    assert log.select(*key, "received_at", "seq").exceptAll(late).isEmpty()


def test_rows_of_a_player_and_day_of_the_log_lie_in_one_task(spark, scratch):
    rows = events(spark, 40_000).withColumn("user_id", F.when(F.col("event_id") % 11 > 0, F.col("user_id")))
    rows.write.parquet(f"{scratch}/events.parquet")
    raw = Ctx(spark, scratch).inp("events").withColumn("id", F.coalesce("id", F.concat(F.lit("n"), F.col("seq") % 5000)))
    log = staging.events_final(raw, 120_000)
    tasks = (log.select("event_date", "player_id", F.spark_partition_id().alias("task")).distinct()
             .groupBy("event_date", "player_id").agg(F.count("task").alias("n")).groupBy(F.col("player_id").isNull().alias("nobody")).agg(F.max("n").alias("n")).collect())
    assert {r.nobody: r.n for r in tasks} == {False: 1, True: 3}  # rows without a player are not one task's
    assert plan(log).count("Exchange") - plan(raw).count("Exchange") == 1
    got = log.select(*raw.columns)
    same = staging.latest_version(raw, staging.EVENT_KEY, ["received_at", "seq"])
    assert got.columns == log.columns and got.exceptAll(same.select(*raw.columns)).isEmpty() and got.count() == same.count()


def test_players_are_aggregated_by_tasks_that_hold_a_bounded_number_of_rows(spark):
    rows = [("2024-01-01 23:59:00", "revenue", "p1", "s", "i1", '{"country":"US","version":"1.0.22","revenue":"1,5","type":"purchase"}'),
            ("2024-01-02 00:01:00", "revenue", "p1", "s", "i2", '{"country":"GB","chapter":3,"revenue":"0.25","type":"ad_reward"}'),
            ("2024-01-03 10:00:00", "pause", "p1", "s2", "i4", '{"version":"1.0.9","revenue":"7"}'),
            ("2024-01-03 10:00:00", "pause", "p1", None, "i3", '{"version":"1.0.8"}'),
            ("2024-01-04 10:00:00", "revenue", "p2", None, "i5", '{"revenue":"1"}'),
            ("2024-01-04 10:00:00", "pause", None, "s9", "i6", None)]
    ev = spark.createDataFrame(rows, "event_at string, name string, player_id string, session_id string, id string, properties string")
    ev = ev.withColumn("event_at", F.col("event_at").cast("timestamp_ntz"))
    camp = spark.createDataFrame([], "player_id string, campaign_name string, install_country string, platform string, "
                                     "first_version string, install_date date, is_test_profile boolean")
    dim = core.dim_players(ev, camp, 250_000)
    text = plan(dim)
    assert text.count("REPARTITION_BY_NUM") == 2 and text.count(", 5), REPARTITION_BY_NUM") == 2
    got = {r.player_id: r for r in dim.collect()}
    r = got["p1"]
    assert (r.country, r.first_country, r.app_version, r.first_app_version, r.current_chapter, r.ab_version) == ("GB", "US", "1.0.9", "1.0.22", 3, None)
    assert (r.total_sessions, r.active_days, r.total_events, r.ltv, r.purchases_count, r.ad_rewards_count, r.is_payer, r.lifespan_days) == (
        2, 3, 4, 1.75, 1, 1, True, 2)
    assert (got["p2"].total_sessions, got["p2"].ltv, got["p2"].is_payer, got["p2"].country) == (0, 1.0, None, None)
    assert (got[None].total_sessions, got[None].ltv, got[None].is_payer) == (1, None, False) and len(got) == 3


def test_report_reads_the_log_once_without_building_it(spark, scratch):
    events(spark, 500).write.parquet(f"{scratch}/events.parquet")
    report = q_dq_report(spark, scratch).collect()
    assert not [k for k in session._BUILT if k[2] == scratch]
    assert len(report) == 27 and {r.metric for r in report if r.check_name == "table is not empty"} >= {1500}


def test_members_of_a_clan_are_counted_without_copies(spark):
    ts = lambda d: f"2024-01-{d:02d} 00:00:00"
    mart = lambda rows, schema: spark.createDataFrame(rows, schema)
    ev = mart([("c1", "A", ts(1), "e1", "p1", "clan_creation", None)],
              "clan_id string, clan_name string, event_at string, event_id string, actor_id string, event_name string, new_level int")
    ev = ev.withColumn("event_at", F.col("event_at").cast("timestamp_ntz"))
    members = mart([("c1", "p1", ts(1), False, "LEADER", "switched_clan"), ("c1", "p1", ts(5), True, "LEADER", None),
                    ("c1", "p2", ts(5), True, "LEADER", None), ("c1", "p3", ts(9), True, "MEMBER", None),
                    ("c1", "p4", ts(9), False, "LEADER", "kicked"), ("c1", "p4", ts(2), False, "MEMBER", "switched_clan")],
                   "clan_id string, member_id string, joined_at string, is_current boolean, role string, leave_reason string")
    members = members.withColumn("joined_at", F.col("joined_at").cast("timestamp_ntz"))
    daily = mart([], "clan_id string, event_date date, members_eod long, raid_fights long")
    fights = mart([], "clan_id string, player_id string, event_at timestamp_ntz, is_win int, boss_tier int, has_tech_issue boolean, is_loss_full_hp boolean")
    tiers = mart([], "clan_id string, is_cleared boolean, first_win_at timestamp_ntz, boss_tier int")
    dim = mart([("p1", True)], "player_id string, is_test_profile boolean")
    out = clans.dim_clans(ev, members, daily, mart([], "player_id string, event_date date"), fights, tiers, dim, "2024-01-31")
    assert "Expand" not in plan(out)
    r = out.first()
    assert (r.members_current, r.members_ever, r.switched_out_total, r.leader_id, r.is_test_creator) == (3, 4, 2, "p2", True)
