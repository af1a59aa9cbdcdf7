"""Semantic traps of typed payload access (N-2, N-4, N-5, N-6, N-12, N-19) and macros."""

from pyspark.sql import functions as F

from playgrid.functions import cols as C


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(expr.alias("x")).first()["x"]


def test_missing_json_path_reads_empty_not_null(spark):
    # N-2: properties.isTest != 'true' must keep events without the key
    df = spark.createDataFrame([('{"a":1}',), ('{"isTest":"true"}',)], "properties string")
    kept = df.filter(C.prop_raw("isTest") != "true").count()
    assert kept == 1
    assert one(spark, C.prop("country"), properties='{"country":""}') is None


def test_strict_int_and_float_parse(spark):
    assert one(spark, C.int_or_null(F.col("v")), v="12") == 12
    assert one(spark, C.int_or_null(F.col("v")), v="1.5") is None       # N-4
    assert one(spark, C.int_or_null(F.col("v")), v="abc") is None
    assert one(spark, C.float_or_null(F.col("v")), v="1.5d") is None    # N-5
    assert one(spark, C.float_or_null_comma(F.col("v")), v="145,93") == 145.93


def test_version_compare_is_semantic(spark):
    df = spark.createDataFrame([("1.0.9",), ("1.0.22",), ("1.1",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(C.version_gte("v", "1.0.22")).collect()]
    assert got == [False, True, True, False, False]


def test_lifetime_bucket_and_order(spark):
    df = spark.createDataFrame([(None,), (0,), (3,), (7,), (14,), (30,), (31,)], "d int")
    rows = df.select(C.lifetime_bucket("d"), C.lifetime_order("d")).collect()
    assert [tuple(r) for r in rows] == [("(unknown)", 99), ("D00", 0), ("D01-03", 1), ("D04-07", 2),
                                        ("D08-14", 3), ("D15-30", 4), ("D31+", 5)]


def test_spend_category_and_country_name(spark):
    df = spark.createDataFrame([("Revive",), ("Pets",), ("Nope",)], "s string")
    assert [r[0] for r in df.select(C.spend_category("s")).collect()] == ["Revive", "Pet", "Other"]
    df = spark.createDataFrame([("PH",), ("XX",)], "c string")
    assert [r[0] for r in df.select(C.country_name("c")).collect()] == ["Philippines", "XX"]


def test_second_boundaries_not_elapsed_units(spark):
    # N-12: 00:00:00.900 -> 00:00:01.100 crosses one second boundary
    df = spark.createDataFrame([("2024-01-01 00:00:00.900", "2024-01-01 00:00:01.100")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    assert df.select(C.seconds_between("a", "b")).first()[0] == 1


def test_economy_unpivot_skips_non_integers(spark):
    # N-19: one bad value must not null the whole map; look-alike keys excluded
    from playgrid.plans.staging import int_economy
    props = '{"Currency_Gems":-5,"Chests_A":0,"Currency_Dust":1.5,"CurrencyX":1,"balanceSnapshot":{"Gems":3}}'
    stg = spark.createDataFrame(
        [("e1", "resource_consume", "p1", "s1", None, None, "c", None, "src", props)],
        "id string, event_name string, player_id string, session_id string, event_at timestamp, "
        "event_date date, country string, ab_version string, action_source string, properties string")
    rows = {r.currency: (r.delta, r.direction, r.amount) for r in int_economy(stg).collect()}
    assert rows == {"Currency_Gems": (-5, "out", 5), "Chests_A": (0, "in", 0)}
