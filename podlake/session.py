"""Spark session and shared-folder helpers.

Cluster settings (AQE, skew handling, broadcast limits) live here so every job
runs with the same runtime re-planning. Nothing here picks a join strategy by
hand: AQE converts a shuffle join to a broadcast join only after it has measured
the real size of the smaller side at runtime, which is the size check we rely on
for every dimension whose row count grows with the data.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings applied to every session we build. Values are conservative
# for a large cluster: 64 MB advisory partitions, skew split at 5x the median.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "podlake",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the cluster settings above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        for k, v in LOCAL_CONF.items():
            builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    set_initial_partitions(spark)
    return spark


INITIAL_PARTITIONS_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def initial_partitions(parallelism: int) -> int:
    """Shuffle partitions a stage starts with on a cluster, before AQE merges
    them to the 64 MB advisory size. AQE can merge but not split (other than
    skew splits), so the start must suit the largest shuffle: 8 per core, at
    least 2048 (a 1000-executor, 8000-core cluster starts at 64k partitions,
    about 0.5 GB each for a 30 TB shuffle)."""
    return max(2048, 8 * parallelism)


def set_initial_partitions(spark: SparkSession) -> None:
    """On a cluster, and only where the session has no value of its own."""
    if spark.sparkContext.master.startswith("local"):
        return
    if spark.conf.get(INITIAL_PARTITIONS_KEY, None) is None:
        spark.conf.set(INITIAL_PARTITIONS_KEY,
                       str(initial_partitions(spark.sparkContext.defaultParallelism)))


# Local runs only: small test tables are one Parquet row group each, so without
# this AQE would coalesce a CPU-heavy stage (regex, tokenizing) into one task.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def spread(df: DataFrame) -> DataFrame:
    """Local runs only: the test tables are one Parquet row group each, so a
    CPU-heavy per-row step would run in one task. On a cluster the scan's own
    splits are used as they are and no shuffle is added."""
    spark = df.sparkSession
    if spark.sparkContext.master.startswith("local["):
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df


def apply_runtime_conf(spark: SparkSession) -> None:
    """Give a session that someone else built the SQL settings it has no value
    for; what an operator has set stays."""
    conf = dict(CLUSTER_CONF)
    if spark.sparkContext.master.startswith("local"):
        conf.update(LOCAL_CONF)
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    set_initial_partitions(spark)


#: Shuffle files go when the query that wrote them has ended, not when the driver next collects its garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Postings take 40 % less disk by zstd than by snappy, in about the same time.
SCRATCH_CONF = {CLEANUP_KEY: "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def scratch_writes(*sessions: SparkSession) -> Iterator[None]:
    """For tables that a query hands to its next steps: those written inside are packed
    closely and leave no shuffle files; nothing reads a write's shuffles again."""
    before = [(s.conf, k, s.conf.get(k, None)) for s in sessions for k in SCRATCH_CONF]
    for conf, k, _ in before:
        conf.set(k, SCRATCH_CONF[k])
    try:
        yield
    finally:
        for conf, k, value in reversed(before):
            conf.set(k, value) if value is not None else conf.unset(k)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and hand-over tables: what
    ``spark.checkpoint.dir`` names, or the folder set on the context. Where there
    is neither, a local run (tests) gets a private folder; a cluster is refused,
    since each of its machines would write to its own disk."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = held.get() if held.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="podlake-")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
