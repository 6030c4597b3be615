"""Session helpers: a local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the ledger relies on. UTC pins timestamp parsing of `updated_at`; AQE coalesces small
# shuffles, splits skewed join partitions and turns joins into broadcasts only after measuring
# the real size of a side at runtime.
LEDGER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # A top-k above this many rows (a deep reader page: up to 100,000 pages of 100) runs as a
    # range-partitioned sort with a streaming limit, not as an in-memory priority queue per task.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}

# Settings of the ledger's queries alone. A drop's text row is some twenty times as wide as its compressed columns, so a task
# of Spark's 128 MB would sort gigabytes, and one of 32 MB still spills; and the JVM only interprets a method above 8,000 bytes, so such plans run operator
# by operator instead.
QUERY_CONF = {
    "spark.sql.files.maxPartitionBytes": str(8 * 1024 * 1024),
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A query's shuffle files are deleted when it ends, not when the driver happens to collect garbage: a query that runs
    # several ones, one after the other, needs the disk of the largest.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """A local session for tests and the bench; a cluster job passes its own session in."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    import tempfile

    # Tests and the bench only: on a cluster the shared folder comes from spark.checkpoint.dir.
    scratch = tempfile.mkdtemp(prefix="ledger-ckpt-", dir=os.environ.get("LEDGER_SCRATCH", "/tmp"))
    builder = builder.config("spark.checkpoint.dir", scratch)
    for key, value in LEDGER_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_ledger_conf(spark: SparkSession, queries: bool = False) -> None:
    """Apply the session-level settings the ledger needs to an existing session; with ``queries`` also those of its
    queries, which are taken back otherwise."""
    for key, value in LEDGER_CONF.items():
        spark.conf.set(key, value)
    for key, value in QUERY_CONF.items():
        if queries:
            spark.conf.set(key, value)
        elif spark.conf.get(key, None) == value:
            spark.conf.unset(key)
