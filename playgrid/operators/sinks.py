"""Full builds (K-01, K-02, K-08, K-10): whole tables and views. Loads into an existing table are in ``loads``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


# ------------------------------------------------------------------ writers
def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
              compression: str = "snappy") -> str:
    """K-01 / K-08 / K-10: full rebuild, optionally partitioned (e.g. by day or month)
    and sorted inside each file by the sort key.

    Rows are clustered by the partition columns with a ``rebalance`` hint:
    AQE coalesces small day/month groups and splits a hot one over several
    tasks (and files), so one big day is not a single straggler task.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def view(df: DataFrame, name: str) -> DataFrame:
    """K-02: a named view (the plan is inlined wherever it is queried)."""
    df.createOrReplaceTempView(name)
    return df
