"""Session construction and cluster-safe lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: UTC wall clock (all reference timestamps are
# UTC), ANSI stays on (safe casts are explicit try_* calls), AQE for runtime
# partition coalescing and skew-join splitting.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "playgrid") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", os.environ.get("PLAYGRID_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Timestamps are UTC; every other setting of an existing session is the cluster's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when it is unset (local tests) a scratch folder is created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="playgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Write an intermediate mart as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the whole upstream plan) and gives downstream plans a real table with
    column pruning, partition pruning and filter pushdown. The folder comes from
    ``spark.checkpoint.dir`` (set by the cluster); a scratch folder is used
    only when it is unset, as in local tests.
    """
    return df.sparkSession.read.parquet(_write(df, name, partition_by, sort_by))


def _write(df: DataFrame, name: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> str:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/marts/{name}-{uuid.uuid4().hex[:12]}"
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    out.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return path


_BUILT: dict[tuple, str] = {}


def build_once(spark: SparkSession, inputs: str, name: str, build: Callable[[], DataFrame], **layout) -> DataFrame:
    """A table that marts share, built when first read and then read again by later queries of the session.

    ``inputs`` is the folder of the tables that it is built from: when a file in it changes, it is built anew.
    """
    key = (spark.sparkContext.applicationId, checkpoint_dir(spark), inputs, _fingerprint(spark, inputs), name)
    if key in _BUILT:
        try:
            return spark.read.parquet(_BUILT[key])
        except AnalysisException:  # the folder was cleared meanwhile
            pass
    _BUILT[key] = _write(build(), name, **layout)
    return spark.read.parquet(_BUILT[key])


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the folder's files in one number (the files are listed, not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return tuple(files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())
