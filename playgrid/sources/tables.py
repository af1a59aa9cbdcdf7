"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; projections and filters applied later are pushed into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROWS_PER_TASK = 100_000


def spread(df: DataFrame, *key: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """A scan whose rows become much wider or are parsed next, dealt to one task for each ``rows`` of them.

    The tasks of a scan are bound to the file's row groups, so a few of them would do all the work and hold all of
    the widened rows. The rows are counted from the files' footers and dealt by a hash of ``key`` while they are
    narrow. The last filter keeps every row; Spark moves no filter past it, so those on parsed columns, which parse,
    do not go down into the scan's few tasks.
    """
    tasks = -(-df.count() // rows)
    return df if tasks < 2 else df.repartition(tasks, *key).filter(F.spark_partition_id() >= 0)


ROWS_PER_SORT = 50_000


def deal(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """Rows that are sorted or grouped by strings next, dealt by ``key`` to one task for each 50,000 of ``rows``.

    Adaptive execution merges shuffle partitions by their compressed size, and rows that repeat each other's text are
    several times that in memory, so the tasks of a larger table spilled. A given number of tasks is left as it is:
    what a task holds does not grow with the table. ``rows`` is a number that the caller knows (at least about) before
    the query runs; what fits one task, and 0, leaves the partitions to Spark.
    """
    tasks = -(-rows // ROWS_PER_SORT)
    return df if tasks < 2 else df.repartition(tasks, *key)
