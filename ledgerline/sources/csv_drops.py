"""Daily CSV drops (S1, S2): ``<root>/raw/<YYYY-MM-DD>/{funding,payouts}.csv``.

Discovery lists the day folders through Spark's file system, so an empty folder counts, and their
files with a distributed ``binaryFile`` listing (content is never read); the as-of selection is a filter on the folder date, and the pairing rule (both files per day) is
an aggregate. All selected days of one source are then read by ONE multi-path CSV scan with the
all-string contract schema; each row carries its file and partition date from ``_metadata``.
Headers are checked per file by Spark's own CSV header check (``enforceSchema=false``), and
malformed rows abort the read (FAILFAST) - both happen during the scan itself.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import FIELDS, check_kind, contract_schema

DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


class ContractError(ValueError):
    """A drop does not match the contract (header, columns, malformed row)."""


def _files(spark: SparkSession, root: str) -> DataFrame:
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(f"{root.rstrip('/')}/raw/*/")
        .select("path")
    )
    parts = F.split(F.col("path"), "/")
    return listing.select(
        "path",
        F.element_at(parts, -2).alias("folder"),
        F.regexp_replace(F.element_at(parts, -1), r"\.csv$", "").alias("source"),
    )


def _folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders below ``raw``: one per day."""
    raw = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/raw")
    files = raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(raw):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(raw) if f.isDirectory())


def partitions(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """Per selected day (folder <= as_of): folder, funding path, payouts path.

    Raises when a folder name is not an ISO date, the as-of folder is missing, or a selected day
    lacks one of the two files. The result has one row per day (metadata, not data).
    """
    date.fromisoformat(as_of)
    folders = _folders(spark, root)
    for folder in folders:
        if not re.fullmatch(DATE_PATTERN, folder):
            raise ValueError(f"raw/{folder}: a day folder is named YYYY-MM-DD")
        date.fromisoformat(folder)
    if as_of not in folders:
        raise FileNotFoundError(f"no day folder raw/{as_of}")
    files = _files(spark, root).filter(F.col("source").isin("funding", "payouts"))
    days = files.groupBy("folder").agg(
        F.max(F.when(F.col("source") == "funding", F.col("path"))).alias("funding"),
        F.max(F.when(F.col("source") == "payouts", F.col("path"))).alias("payouts"),
    )
    found = {r["folder"]: r for r in days.collect()}  # one row per day folder
    for folder in folders:
        row = found.get(folder)
        if folder <= as_of and (row is None or row["funding"] is None or row["payouts"] is None):
            raise FileNotFoundError(f"raw/{folder} needs a funding.csv and a payouts.csv")
    return days.filter(F.col("folder") <= F.lit(as_of))


def read_drops(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """One scan over all selected files of a source: contract columns + batch_date + source_file."""
    check_kind(kind)
    frame = (
        spark.read.schema(contract_schema(kind))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(paths)
    )
    source = F.col("_metadata.file_path")
    return frame.select(
        *FIELDS[kind],
        F.regexp_extract(source, r"/raw/(\d{4}-\d{2}-\d{2})/[^/]+$", 1).alias("batch_date"),
        source.alias("source_file"),
    )


def selected_days(spark: SparkSession, root: str, as_of: str) -> list[tuple[str, str, str]]:
    """(day, funding path, payouts path) of every selected day, oldest first; one row a day."""
    return [tuple(r) for r in partitions(spark, root, as_of).orderBy("folder").collect()]


def check_headers(files) -> None:
    """Exact, case-sensitive header check (S2) over fingerprint rows (key 'date/source', header).

    Spark's own check (``enforceSchema=false``) ignores case unless ``spark.sql.caseSensitive``
    is set; the contract requires the exact field list. ``files`` is one row per input file.
    """
    import csv

    for row in files:
        kind = row["key"].rsplit("/", 1)[-1]
        if kind not in FIELDS:
            continue
        found = next(csv.reader([row["header"] or ""]), [])
        if found != list(FIELDS[kind]):
            raise ContractError(f"{row['key']}: the header is {found}, the contract's fields are {list(FIELDS[kind])}")


def contract_violation(error: Exception) -> bool:
    text = str(error)
    return any(s in text for s in ("CSV header", "MALFORMED", "Malformed", "does not conform", "FAILFAST"))
