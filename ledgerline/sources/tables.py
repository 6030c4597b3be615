"""Run-tagged ledger tables (S3-S5, S8, S9, S10, J4).

Layout under a ledger root (any Hadoop path: local, HDFS, object store):
  tables/<dataset>/batch_date=<as-of>/run_id=<id>/part-*.parquet   one folder per run
  tables/pipeline_audit/     one row per run; a SUCCEEDED row is the publication commit
  tables/pipeline_alerts/    structured alert rows
Writers append into fresh ``run_id`` partitions, so a run never touches another run's files, and
readers only see runs that have a SUCCEEDED audit row (data first, audit row last).
"""

from __future__ import annotations

import json
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.contracts import POLICY_VERSION

AUDIT = "pipeline_audit"
ALERTS = "pipeline_alerts"
AUDIT_SCHEMA = StructType(
    [
        StructField(name, StringType(), True)
        for name in ("run_id", "batch_date", "status", "completed_at", "policy_version", "quality_json")
    ]
)
ALERT_SCHEMA = StructType(
    [
        StructField(name, StringType(), True)
        for name in ("run_id", "batch_date", "severity", "category", "details_json", "created_at")
    ]
)


#: Datasets in which a record is looked up. Their files are sorted by the record and carry bloom filters of it, so a lookup of one
#: id opens the row groups that may hold it: other files answer from their footer.
LOOKED_UP = ("gold_funding", "gold_reconciliation", "silver_payouts")
LOOKUP = "record_id"
LOOKUP_GROUP_BYTES = 32 * 1024 * 1024


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/tables/{name}"


def with_lineage(df: DataFrame, run_id: str, batch_date: str) -> DataFrame:
    """Lineage columns on every written dataset."""
    return df.withColumns(
        {
            "run_id": F.lit(run_id),
            "policy_version": F.lit(POLICY_VERSION),
            "batch_date": F.lit(batch_date),
            "written_at": F.current_timestamp(),
        }
    )


def check_format(fmt: str) -> str:
    if fmt not in ("parquet", "delta"):
        raise ValueError(f"{fmt!r} is no format of the ledger's tables: parquet or delta")
    return fmt


def run_folder(root: str, name: str, run_id: str, batch_date: str) -> str:
    return f"{table_path(root, name)}/batch_date={batch_date}/run_id={run_id}"


def read_run(spark: SparkSession, root: str, name: str, run_id: str, batch_date: str) -> DataFrame:
    """One run's rows of a Parquet dataset: only its own folder is listed and read."""
    return spark.read.parquet(run_folder(root, name, run_id, batch_date))


def scratch_root(spark: SparkSession) -> str:
    """A new folder below the shared one that the session names in spark.checkpoint.dir."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/ledger-{uuid.uuid4().hex}"


def write_dataset(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> None:
    """Append one run's rows; the (batch_date, run_id) partition is new for every run, because ``commits.claim``
    lets a run id be used once."""
    check_format(fmt)
    writer = (df.sortWithinPartitions(LOOKUP) if name in LOOKED_UP else df).write.format(fmt).mode("append")
    if name in LOOKED_UP:
        writer = writer.options(**{f"parquet.bloom.filter.enabled#{LOOKUP}": "true", "parquet.block.size": str(LOOKUP_GROUP_BYTES)})
    writer.partitionBy("batch_date", "run_id").save(table_path(root, name))


def write_empty_run(df: DataFrame, root: str, name: str, run_id: str, batch_date: str, fmt: str = "parquet") -> None:
    """A run that wrote no rows to ``name`` still gets its partition folder with one schema-only
    file: a partitioned write of no rows creates no files, and a table holding only such runs
    could not be read. ``limit(0)`` plans as an empty relation, so nothing is recomputed."""
    folder = run_folder(root, name, run_id, batch_date)
    empty = with_lineage(df, run_id, batch_date).drop("batch_date", "run_id").limit(0)
    empty.coalesce(1).write.format(fmt).mode("append").save(folder)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def append_audit(spark: SparkSession, root: str, run_id: str, batch_date: str, status: str, quality: dict) -> None:
    """Append the run's audit row. A SUCCEEDED row is the commit that publishes the run."""
    row = [(run_id, batch_date, status, utc_now(), POLICY_VERSION, json.dumps(quality, default=str, sort_keys=True))]
    spark.createDataFrame(row, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(table_path(root, AUDIT))


def append_alert(spark: SparkSession, root: str, run_id: str, batch_date: str, severity: str, category: str, details: dict) -> dict:
    """Append one structured alert row (the outbox; delivery is someone else's job)."""
    event = dict(
        run_id=run_id,
        batch_date=batch_date,
        severity=severity,
        category=category,
        details_json=json.dumps(details, default=str, sort_keys=True),
        created_at=utc_now(),
    )
    spark.createDataFrame([tuple(event[f.name] for f in ALERT_SCHEMA.fields)], ALERT_SCHEMA).coalesce(1).write.mode(
        "append"
    ).parquet(table_path(root, ALERTS))
    return event


def _read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:  # a table that was never written
        if "PATH_NOT_FOUND" in str(error) or "does not exist" in str(error):
            return spark.createDataFrame([], schema)
        raise


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return _read_or_empty(spark, table_path(root, AUDIT), AUDIT_SCHEMA)


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    return _read_or_empty(spark, table_path(root, ALERTS), ALERT_SCHEMA)


def read_dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, name))


def current_run(audit: DataFrame) -> DataFrame:
    """The published run: latest SUCCEEDED row by batch_date, completed_at, run_id (W5).

    A global top-1 (``orderBy().limit(1)``) instead of an unpartitioned row_number window.
    """
    return (
        audit.filter(F.col("status") == "SUCCEEDED")
        .orderBy(F.col("batch_date").desc(), F.col("completed_at").desc(), F.col("run_id").desc())
        .limit(1)
    )


def published(dataset: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows of ``dataset`` that belong to the published run (J4).

    The right side is exactly one row, so the broadcast is size-bounded by construction.
    """
    current = F.broadcast(current_run(audit).select("run_id", "batch_date"))
    return dataset.join(current, ["run_id", "batch_date"], "left_semi")


def snapshot(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    """Read one dataset of the published run (S10). A stale ``run_id`` raises (snapshot pinning)."""
    audit = read_audit(spark, root)
    current = current_run(audit).collect()  # at most one row
    if not current:
        raise LookupError("No published ledger yet")
    head = current[0]
    if run_id is not None and run_id != head["run_id"]:
        raise RuntimeError(f"Snapshot changed: requested {run_id}, published {head['run_id']}")
    data = read_dataset(spark, root, name)
    # Literal partition values let Spark prune to the one run folder before reading any file.
    return data.filter((F.col("batch_date") == head["batch_date"]) & (F.col("run_id") == head["run_id"]))


def create_current_view(spark: SparkSession, root: str, name: str = "gold_reconciliation", view: str = "current_reconciliation") -> DataFrame:
    """Register ``view`` as the published run's rows of ``name`` (S11); returns the frame."""
    data = published(read_dataset(spark, root, name), read_audit(spark, root))
    data.createOrReplaceTempView(view)
    return data
