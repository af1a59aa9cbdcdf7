"""Landed API JSON -> typed tables (S-09 .. S-13, M-39 .. M-42).

The reference pulls pages from HTTP APIs in a driver loop and flattens
records in Python. Here ingestion starts from landed JSON (one record per
row, e.g. ``spark.read.text`` / ``spark.read.json`` of the landing folder);
flattening is ``from_json`` with an explicit schema plus struct field access,
and "last version wins" is the same grouped ``max_by`` as the event log.

``api_*`` builders derive landed pages from the driver ``orders`` table
(deterministically, so the DuckDB oracle can rebuild them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playgrid.operators.rel import latest_version
from playgrid.sources.tables import read, spread

# String fields of an affiliate conversion record, in the
# order of the target table.
CONV_STR = ["tid", "status", "decline_reason", "payout_currency", "revenue_currency", "value_currency",
            *[f"sub{i}" for i in range(1, 11)], *[f"custom{i}" for i in range(1, 6)],
            "note", "comment", "comment_to_partner", "click_id", "click_redirect_url", "click_ip",
            "browser", "os", "device_type", "country", "referer", "user_agent", "x_requested_with",
            "promocode", "promocode_user_id"]
# Fixed values: (column, nested object, field) of a conversion record.
CONV_NESTED = [("goal_id", "goal", "id"), ("goal_name", "goal", "name"), ("goal_key", "goal", "key"),
               ("advertiser_id", "advertiser", "id"), ("advertiser_name", "advertiser", "full_name"),
               ("product_id", "product", "id"), ("product_name", "product", "name"),
               ("offer_id", "offer", "id"), ("offer_name", "offer", "name"),
               ("partner_id", "partner", "id"), ("partner_name", "partner", "full_name")]
# Conversion statuses x metrics of the daily statistics.
STATUSES = ("confirmed", "pending", "hold", "rejected", "total")
METRICS = ("count", "payout", "revenue", "value")
BREAKDOWN_DIMS = ("partner", "offer", "country", "os", "landing", "sub1")


def _s(x) -> Column:
    return x.cast("string")


def _day(o_orderdate: Column) -> Column:
    return F.date_add(F.lit("2024-01-12").cast("date"),
                      (F.datediff(o_orderdate, F.lit("1995-01-01").cast("date")) % 30).cast("int"))


def _dec(cents: Column) -> Column:
    return _s((cents / 100).cast("decimal(18,2)"))


def _q(v: Column) -> Column:
    return F.concat(F.lit('"'), v, F.lit('"'))


# --------------------------------------------------------------- conversions
def api_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed conversion pages: (page, pos, body). Ids repeat across pages."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                            "o_orderpriority", "o_totalprice")
    o = spread(o, "o_orderkey")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    ts = F.concat(F.date_format(_day(F.col("o_orderdate")), "yyyy-MM-dd"), F.lit(" "),
                  F.lpad(_s(ok % 24), 2, "0"), F.lit(":30:00"))
    status = F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "pending") \
        .otherwise("hold")
    nz = lambda cond, v: F.when(cond, F.lit("null")).otherwise(v)
    body = F.concat_ws(",",
        F.concat(F.lit('"conversion_id":'), _s((ok / 2).cast("bigint"))),
        F.concat(F.lit('"conversion_datetime":'), _q(F.when(ok % 13 == 0, F.lit("")).otherwise(ts))),
        F.concat(F.lit('"updated_at":'), _q(ts)),
        F.concat(F.lit('"click_datetime":'), _q(F.when(ok % 3 == 0, F.lit("")).otherwise(ts))),
        F.concat(F.lit('"payment_model":'), nz(ok % 4 == 0, _s(ok % 3))),
        F.concat(F.lit('"payout":'), nz(ok % 6 == 0, _dec(ok % 500))),
        F.concat(F.lit('"revenue":'), _dec(F.round(F.col("o_totalprice") * 100).cast("bigint") % 100000)),
        F.concat(F.lit('"value":'), _dec(ck % 300)),
        F.concat(F.lit('"edited_by_manager":'), F.when(ok % 2 == 0, F.lit("true")).otherwise(F.lit("false"))),
        F.when(ok % 5 == 0, F.lit('"is_qualification":true')),
        F.concat(F.lit('"condition_id":'), nz(ok % 7 == 0, _s(ok % 11))),
        F.concat(F.lit('"landing_id":'), _s(ok % 4)),
        F.concat(F.lit('"tid":'), _q(F.concat(F.lit("t"), _s(ok)))),
        F.concat(F.lit('"status":'), _q(status)),
        F.concat(F.lit('"country":'), _q(F.concat(F.lit("C"), _s(ck % 4)))),
        F.concat(F.lit('"os":'), _q(F.when(ok % 2 == 0, F.lit("ios")).otherwise(F.lit("android")))),
        F.concat(F.lit('"sub1":'), _q(F.col("o_orderpriority"))),
        F.lit('"promocode":null'),
        F.concat(F.lit('"goal":'), F.when(ok % 9 == 0, F.lit("null")).otherwise(
            F.concat(F.lit('{"id":'), _s(ok % 3), F.lit(',"name":"goal '), _s(ok % 3), F.lit('","key":"g'),
                     _s(ok % 3), F.lit('"}')))),
        F.concat(F.lit('"partner":{"id":'), _s(ck % 7), F.lit(',"full_name":"Partner '), _s(ck % 7), F.lit('"}')),
        F.concat(F.lit('"offer":{"id":'), _s(ck % 3), F.lit(',"name":null}')))
    return o.select((ok / 1000).cast("bigint").alias("page"), (ok % 1000).alias("pos"),
                    F.concat(F.lit("{"), body, F.lit("}")).alias("body"))


def _conv_schema() -> T.StructType:
    f = [T.StructField("conversion_id", T.LongType()),
         T.StructField("conversion_datetime", T.StringType()), T.StructField("updated_at", T.StringType()),
         T.StructField("click_datetime", T.StringType()), T.StructField("payment_model", T.IntegerType()),
         T.StructField("payout", T.DecimalType(18, 4)), T.StructField("revenue", T.DecimalType(18, 4)),
         T.StructField("value", T.DecimalType(18, 4)), T.StructField("edited_by_manager", T.BooleanType()),
         T.StructField("is_qualification", T.BooleanType()), T.StructField("condition_id", T.LongType()),
         T.StructField("landing_id", T.LongType())]
    f += [T.StructField(c, T.StringType()) for c in CONV_STR]
    objs: dict[str, list[str]] = {}
    for _, obj, fld in CONV_NESTED:
        objs.setdefault(obj, []).append(fld)
    f += [T.StructField(obj, T.StructType([T.StructField(x, T.LongType() if x == "id" else T.StringType())
                                           for x in flds])) for obj, flds in objs.items()]
    return T.StructType(f)


def conversions(pages: DataFrame) -> DataFrame:
    """M-39: one row per conversion id (last page wins), 60 flat columns + raw record.

    Only the id is parsed before the versions are compared, so the records are shuffled as they landed.
    """
    schema = _conv_schema()
    c = F.from_json("body", T.StructType([schema["conversion_id"]]))
    r = pages.select("page", "pos", "body", c["conversion_id"].alias("conversion_id"))
    r = latest_version(r, ["conversion_id"], ["page", "pos"], method="window")
    r = r.select("conversion_id", "body", F.from_json("body", schema).alias("c"))

    def ts(name):
        return F.try_to_timestamp(F.nullif(F.col(f"c.{name}"), F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss")).alias(name)

    cols = [F.col("conversion_id"), ts("conversion_datetime"), ts("updated_at"), ts("click_datetime"),
            F.col("c.payment_model").alias("payment_model"),
            *[F.coalesce(F.col(f"c.{m}"), F.lit(0).cast("decimal(18,4)")).alias(m) for m in ("payout", "revenue", "value")],
            F.coalesce(F.col("c.edited_by_manager"), F.lit(False)).alias("edited_by_manager"),
            F.coalesce(F.col("c.is_qualification"), F.lit(False)).alias("is_qualification"),
            F.col("c.condition_id").alias("condition_id"), F.col("c.landing_id").alias("landing_id"),
            *[F.coalesce(F.col(f"c.{k}"), F.lit("")).alias(k) for k in CONV_STR]]
    for col, obj, fld in CONV_NESTED:
        v = F.col(f"c.{obj}.{fld}")
        cols.append(v.alias(col) if col.endswith("_id") else F.coalesce(v, F.lit("")).alias(col))
    cols.append(F.col("body").alias("raw"))
    return r.select(*cols)


# ------------------------------------------------------------- daily stats
def api_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed statistics records: (request_day, group_by, loaded_at, body), two loads each."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                            "o_orderpriority", "o_totalprice")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    dims = F.array(
        F.struct(F.lit("day").alias("gb"), F.date_format(_day(F.col("o_orderdate")), "yyyy-MM-dd").alias("gid")),
        F.struct(F.lit("partner").alias("gb"), _s(ck % 7).alias("gid")),
        F.struct(F.lit("offer").alias("gb"), _s(ck % 3).alias("gid")),
        F.struct(F.lit("country").alias("gb"), F.concat(F.lit("C"), _s(ck % 4)).alias("gid")),
        F.struct(F.lit("os").alias("gb"), F.when(ok % 2 == 0, F.lit("ios")).otherwise(F.lit("android")).alias("gid")),
        F.struct(F.lit("landing").alias("gb"), F.when(ok % 5 != 0, _s(ok % 4)).alias("gid")),
        F.struct(F.lit("sub1").alias("gb"), F.col("o_orderpriority").alias("gid")))
    st = F.when(F.col("o_orderstatus") == "F", "confirmed").when(F.col("o_orderstatus") == "O", "pending") \
        .otherwise("hold")
    x = o.select(_day(F.col("o_orderdate")).alias("request_day"), st.alias("st"),
                 (ok % 500).alias("pc"), (F.round(F.col("o_totalprice") * 100).cast("bigint") % 100000).alias("rc"),
                 (ck % 300).alias("vc"), F.explode(dims).alias("g"))
    aggs = [F.count(F.lit(1)).alias("n")]
    for s in ("confirmed", "pending", "hold"):
        m = F.col("st") == s
        aggs += [F.count_if(m).alias(f"{s}_count"), F.sum(F.when(m, F.col("pc"))).alias(f"{s}_pc"),
                 F.sum(F.when(m, F.col("rc"))).alias(f"{s}_rc"), F.sum(F.when(m, F.col("vc"))).alias(f"{s}_vc")]
    aggs += [F.sum("pc").alias("total_pc"), F.sum("rc").alias("total_rc"), F.sum("vc").alias("total_vc")]
    g = x.groupBy("request_day", F.col("g.gb").alias("group_by"), F.col("g.gid").alias("gid")).agg(*aggs)
    g = g.withColumn("load", F.explode(F.array(F.lit(1), F.lit(2))))

    def status_obj(s, cnt):
        return F.concat(F.lit(f'"{s}":{{"count":'), _s(F.coalesce(cnt, F.lit(0))),
                        F.lit(',"payout":'), _dec(F.coalesce(F.col(f"{s}_pc"), F.lit(0))),
                        F.lit(',"revenue":'), _dec(F.coalesce(F.col(f"{s}_rc"), F.lit(0))),
                        F.lit(',"value":'), _dec(F.coalesce(F.col(f"{s}_vc"), F.lit(0))), F.lit("}"))

    gid = F.col("gid")
    gf = F.concat(F.lit('[{"group_field":"'), F.col("group_by"), F.lit('","id":'),
                  F.when(gid.isNull(), F.lit("null")).otherwise(_q(gid)),
                  F.when(gid.isNull(), F.lit("")).otherwise(F.concat(F.lit(',"label":"L-'), gid, F.lit('"'))),
                  F.lit("}]"))
    body = F.concat(
        F.lit('{"group_fields":'), gf,
        F.lit(',"click_count":'), _s(F.col("n") * 3 + F.col("load")),
        F.lit(',"click_unique_count":'), _s(F.col("n") * 2),
        F.lit(',"conversions":{'),
        F.concat_ws(",", *[status_obj(s, F.col(f"{s}_count")) for s in ("confirmed", "pending", "hold")],
                    status_obj("total", F.col("n"))),
        F.lit("}}"))
    return g.select("request_day", "group_by",
                    (F.to_timestamp(F.lit("2024-02-01")) + F.make_interval(days=F.col("load"))).alias("loaded_at"),
                    body.alias("body"))


def _stats_schema() -> T.StructType:
    met = T.StructType([T.StructField("count", T.LongType()), T.StructField("payout", T.DecimalType(18, 4)),
                        T.StructField("revenue", T.DecimalType(18, 4)), T.StructField("value", T.DecimalType(18, 4))])
    return T.StructType([
        T.StructField("group_fields", T.ArrayType(T.StructType([
            T.StructField("group_field", T.StringType()), T.StructField("id", T.StringType()),
            T.StructField("label", T.StringType())]))),
        T.StructField("click_count", T.LongType()), T.StructField("click_unique_count", T.LongType()),
        T.StructField("conversions", T.StructType([T.StructField(s, met) for s in STATUSES]))])


def _metrics(c: str = "r") -> list[Column]:
    """22 flat metric columns: clicks + status x metric matrix, missing -> 0."""
    out = [F.coalesce(F.col(f"{c}.click_count"), F.lit(0)).alias("click_count"),
           F.coalesce(F.col(f"{c}.click_unique_count"), F.lit(0)).alias("click_unique_count")]
    for s in STATUSES:
        for m in METRICS:
            zero = F.lit(0) if m == "count" else F.lit(0).cast("decimal(18,4)")
            out.append(F.coalesce(F.col(f"{c}.conversions.{s}.{m}"), zero).alias(f"{s}_{m}"))
    return out


def daily_stats(stats: DataFrame) -> DataFrame:
    """M-40: one row per day (day taken from the 'day' group field), latest load wins."""
    r = stats.filter(F.col("group_by") == "day").select("loaded_at", F.from_json("body", _stats_schema()).alias("r"))
    r = r.select("loaded_at", "r",
                 F.get(F.filter("r.group_fields", lambda g: g["group_field"] == "day"), 0)["id"].alias("day_s"))
    r = r.filter(F.col("day_s").isNotNull() & (F.col("day_s") != ""))
    flat = r.select(F.col("day_s").try_cast("date").alias("day"), *_metrics(), F.col("loaded_at").alias("_loaded_at"))
    return latest_version(flat, ["day"], ["_loaded_at"]).drop("_loaded_at")


def daily_stats_by(stats: DataFrame, dims: Sequence[str] = BREAKDOWN_DIMS) -> DataFrame:
    """M-41: per day and breakdown dimension value; NULL id -> '', missing label -> ''."""
    r = stats.filter(F.col("group_by").isin(list(dims))).select(
        "request_day", "group_by", "loaded_at", F.from_json("body", _stats_schema()).alias("r"))
    r = r.withColumn("g", F.get(F.filter("r.group_fields", lambda g: g["group_field"] == F.col("group_by")), 0))
    r = r.filter(F.col("g").isNotNull())
    flat = r.select(F.col("request_day").alias("day"), F.col("group_by").alias("dim"),
                    F.coalesce(F.col("g.id"), F.lit("")).alias("dim_id"),
                    F.coalesce(F.col("g.label"), F.lit("")).alias("dim_label"),
                    *_metrics(), F.col("loaded_at").alias("_loaded_at"))
    return latest_version(flat, ["day", "dim", "dim_id"], ["_loaded_at"]).drop("_loaded_at")


# ------------------------------------------------------------------ rates
def api_rate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rate documents: one per (day, fetch), EUR base, map of currency -> rate."""
    from playgrid.sources.adapters import currency_rates
    r = currency_rates(spark, sf_dir)
    g = r.groupBy("business_date", "update_at").agg(
        F.sort_array(F.collect_list(F.struct("target_currency", "rate"))).alias("kv"))
    rates = F.concat_ws(",", F.transform("kv", lambda x: F.concat(
        F.lit('"'), x["target_currency"], F.lit('":'), x["rate"].cast("string"))))
    upd = F.date_format("business_date", "dd MMM yyyy")
    body = F.concat(F.lit('{"result":"success","base_code":"EUR","time_last_update_utc":"'),
                    F.date_format("business_date", "E"), F.lit(", "), upd, F.lit(' 00:00:01 +0000",'),
                    F.lit('"conversion_rates":{'), rates, F.lit("}}"))
    return g.select(F.col("update_at").alias("fetched_at"), body.alias("body"))


def currency_rates_etl(docs: DataFrame, stage_dir: str | None = None) -> DataFrame:
    """M-42: rate documents -> (business_date, base, target, rate, update_at), upsert on the date key.

    With ``stage_dir`` the exploded rows go through a landing Parquet file
    partitioned by day (snappy), whose physical types are those of the
    extraction step (business_date as an epoch-day integer); the load reads it
    back with ``read_parquet_cast`` before the upsert.
    """
    schema = T.StructType([T.StructField("base_code", T.StringType()),
                           T.StructField("time_last_update_utc", T.StringType()),
                           T.StructField("conversion_rates", T.MapType(T.StringType(), T.DoubleType()))])
    d = docs.select("fetched_at", F.from_json("body", schema).alias("d"))
    upd = F.substring_index(F.col("d.time_last_update_utc"), ", ", -1)
    rows = d.select(
        F.to_date(F.try_to_timestamp(upd, F.lit("dd MMM yyyy HH:mm:ss Z"))).alias("business_date"),
        F.col("d.base_code").alias("base_currency"),
        F.explode("d.conversion_rates").alias("target_currency", "rate"),
        F.col("fetched_at").alias("update_at"))
    if stage_dir is not None:
        from playgrid.operators.sinks import overwrite
        from playgrid.sources.files import read_parquet_cast
        landed = rows.select(F.unix_date("business_date").alias("business_date"), "base_currency",
                             "target_currency", "rate", "update_at", F.col("business_date").alias("day"))
        overwrite(landed, stage_dir, partition_by=["day"])
        rows = read_parquet_cast(docs.sparkSession, stage_dir, timestamp_cols=["update_at"],
                                 epoch_day_cols=["business_date"]).drop("day")
    return latest_version(rows, ["business_date", "base_currency", "target_currency"], ["update_at"])
