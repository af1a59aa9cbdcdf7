"""File sources with declared types: seed CSVs (S-07) and staged Parquet
files whose physical types need casting on read (S-13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared column types of the seed tables.
SEED_SCHEMAS = {
    "iap_backfill": "player_id STRING, event_date DATE, revenue_amount DOUBLE",
}


def write_seed_csv(df: DataFrame, path: str) -> str:
    """Lay a seed down as CSV with a header line (the versioned seed file)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_seed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S-07: a seed CSV read with its declared column types (no inference pass;
    a value that does not parse fails the read instead of turning into NULL)."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("dateFormat", "yyyy-MM-dd").csv(path))


def read_parquet_cast(spark: SparkSession, path: str, timestamp_cols: Sequence[str] = (),
                      epoch_day_cols: Sequence[str] = ()) -> DataFrame:
    """S-13: read a staged Parquet file and fix its physical types: timestamps
    become TIMESTAMP (UTC session clock, microseconds), integer day numbers
    since 1970-01-01 become DATE."""
    df = spark.read.parquet(path)
    fix = {c: F.col(c).cast("timestamp") for c in timestamp_cols}
    fix.update({c: F.date_from_unix_date(F.col(c).cast("int")) for c in epoch_day_cols})
    return df.withColumns(fix) if fix else df
