"""Seed CSV with declared types (S-07) and Parquet read with casts (S-13)."""

import datetime as dt
import os

import pytest

from playgrid.sources.files import SEED_SCHEMAS, read_parquet_cast, read_seed_csv


def test_seed_csv_declared_types(spark, scratch):
    p = os.path.join(scratch, "seed")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as f:
        f.write("player_id,event_date,revenue_amount\nabc,2026-07-25,6.96\n007,2026-07-23,11.61\n")
    df = read_seed_csv(spark, p, SEED_SCHEMAS["iap_backfill"])
    assert [(x.name, x.dataType.simpleString()) for x in df.schema.fields] == [
        ("player_id", "string"), ("event_date", "date"), ("revenue_amount", "double")]
    rows = sorted(df.collect())
    assert rows[0].player_id == "007"                       # a string id keeps its leading zeros
    assert rows[1].event_date == dt.date(2026, 7, 25) and rows[1].revenue_amount == 6.96


def test_seed_csv_bad_value_fails(spark, scratch):
    p = os.path.join(scratch, "bad")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as f:
        f.write("player_id,event_date,revenue_amount\nabc,not-a-date,1.0\n")
    with pytest.raises(Exception):
        read_seed_csv(spark, p, SEED_SCHEMAS["iap_backfill"]).collect()


def test_read_parquet_cast(spark, scratch):
    p = os.path.join(scratch, "landed")
    spark.createDataFrame([(19723, "2024-01-01 10:00:00", 1.5), (None, None, 2.0)],
                          "business_date long, update_at string, rate double").write.parquet(p)
    df = read_parquet_cast(spark, p, timestamp_cols=["update_at"], epoch_day_cols=["business_date"])
    got = sorted(df.collect(), key=lambda r: r.rate)
    assert got[0].business_date == dt.date(2024, 1, 1)
    assert got[0].update_at == dt.datetime(2024, 1, 1, 10, 0)
    assert got[1].business_date is None and got[1].update_at is None
