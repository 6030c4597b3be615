"""Pages of any dataset in a total order (O1).

The order is the reader's columns as far as a dataset has them, nulls first, then the digest of the whole
row. Only equal rows tie, and a cursor counts how many of them were shown, so a walk returns every row once.

``write_pages`` stores a dataset sorted in ranges, one folder each, with a sparse directory: per range and status its
first key and its number of rows. Page N is then found by adding up the directory, and read from the one or
two ranges that hold it, however deep it lies.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.contracts import PAGE_ORDER
from ledgerline.functions.digests import row_digest
from ledgerline.sources import tables

KEY = "_order"
RANGE = "page_range"
ROWS_PER_RANGE = 100_000


def order_key(df: DataFrame) -> Column:
    """A struct that orders the rows totally, but for equal ones. Structs compare field by field, nulls first."""
    fields = [F.col(c).cast("string").alias(c) for c in PAGE_ORDER if c in df.columns]
    return F.struct(*fields, row_digest(df.columns).alias("digest"))


def cursor_behind(df: DataFrame, **values: str | None) -> str:
    """A cursor behind all rows whose order columns have these texts (columns not given: null)."""
    key = {c: values[c] for c in PAGE_ORDER if c in df.columns and values.get(c) is not None}
    return json.dumps({"key": {**key, "digest": "~"}, "shown": 0})  # beyond any digest


def following(df: DataFrame, cursor: str | None, size: int) -> DataFrame:
    """The ``size`` rows behind ``cursor`` (None: the first ones). Each row brings a ``cursor`` of its own, which
    says its key and how many rows with that key were shown; the last one leads to the next page.

    The first order column is also compared alone, which a sorted Parquet table can prune by."""
    rows = df.withColumn(KEY, order_key(df))
    kind = rows.schema[KEY].dataType
    seen = F.lit(0)
    shown = 0
    if cursor is not None:
        given = json.loads(cursor)
        last = F.from_json(F.lit(json.dumps(given["key"])), kind)
        shown, lead = given["shown"], kind.names[0]
        if lead in df.columns and given["key"].get(lead) is not None:
            rows = rows.filter(F.col(lead).cast("string") >= F.lit(given["key"][lead]))
        rows = rows.filter(F.col(KEY) >= last)
        seen = F.when(F.col(KEY) == last, F.lit(shown)).otherwise(F.lit(0))
    page = rows.orderBy(KEY).offset(shown).limit(size)
    nth = F.row_number().over(Window.partitionBy(KEY).orderBy(KEY)) + seen  # among the rows of one page
    counted = page.withColumn("_nth", nth).withColumn("cursor", F.to_json(F.struct(F.col(KEY).alias("key"), F.col("_nth").alias("shown"))))
    return counted.orderBy(KEY, "_nth").drop(KEY, "_nth")


def write_pages(df: DataFrame, path: str, rows_per_range: int = ROWS_PER_RANGE) -> None:
    """Write ``df`` below ``path``: sorted rows in range folders, and the directory. The number of ranges follows the
    number of rows, so a range stays as large as it is however much there is. The rows are counted, sampled for the range
    bounds and dealt, so they are computed once and kept in files until they are sorted."""
    if rows_per_range < 1:
        raise ValueError("a range holds at least one row")
    spark, unsorted = df.sparkSession, f"{path}/unsorted"
    try:
        df.write.mode("errorifexists").parquet(unsorted)
        _write_sorted(spark.read.schema(df.schema).parquet(unsorted), path, rows_per_range)
    finally:
        tables.delete(spark, unsorted)


def _write_sorted(df: DataFrame, path: str, rows_per_range: int) -> None:
    ranges = max(1, -(-df.count() // rows_per_range))
    keyed = df.withColumn(KEY, order_key(df))
    # equal rows are dealt by their place in the input, so many copies of a row do not meet in one range
    tied = keyed.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(ranges, KEY, "_place")
    tied.sortWithinPartitions(KEY, "_place").drop("_place").withColumn(RANGE, F.spark_partition_id()).write.mode("errorifexists").partitionBy(RANGE).parquet(
        f"{path}/rows"
    )
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    status = F.col("status") if "status" in df.columns else F.lit(None).cast("string")
    directory = rows.groupBy(RANGE, status.alias("status")).agg(F.count(F.lit(1)).alias("rows"), F.min(KEY).alias("first"))
    directory.coalesce(1).write.mode("errorifexists").parquet(f"{path}/directory")  # a few rows a range


def directory(spark: SparkSession, path: str) -> DataFrame:
    """(page_range, status, rows, first): the sparse page directory."""
    return spark.read.parquet(f"{path}/directory")


def page_at(spark: SparkSession, path: str, page: int, size: int, status: str | None = None) -> DataFrame:
    """Page ``page`` (from 1) of a dataset written by ``write_pages``, of one ``status`` if given. The directory
    says which ranges hold it; only their folders are read, and only there rows are skipped."""
    if page < 1 or size < 1:
        raise ValueError("pages and sizes start at 1")
    entries = directory(spark, path)
    if status is not None:
        entries = entries.filter(F.col("status") == F.lit(status))
    sums = entries.groupBy(RANGE).agg(F.sum("rows").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begin, end = (page - 1) * size, page * size
    counted = sums.withColumn("before", before)
    held = counted.filter((F.col("before") < end) & (F.col("before") + F.col("rows") > begin)).orderBy(RANGE).collect()  # ranges of one page
    rows = spark.read.parquet(f"{path}/rows").filter(F.col(RANGE).isin([r[RANGE] for r in held]))
    if status is not None:
        rows = rows.filter(F.col("status") == F.lit(status))
    skipped = begin - held[0]["before"] if held else 0
    return rows.orderBy(RANGE, KEY).offset(skipped).limit(size).drop(KEY, RANGE)


def page_bounds(spark: SparkSession, path: str, size: int) -> DataFrame:
    """(page, rows, first_digest) of all pages: a row's place is its place in its range behind the ranges before."""
    sums = directory(spark, path).groupBy(RANGE).agg(F.sum("rows").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(RANGE, before.alias("before"))
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(KEY)) - 1
    rows = spark.read.parquet(f"{path}/rows").select(RANGE, KEY).withColumn("place", place).join(starts, RANGE)
    page = F.floor((F.col("before") + F.col("place")) / size) + 1
    return rows.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("rows"), F.min(KEY)["digest"].alias("first_digest"))
