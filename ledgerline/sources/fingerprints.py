"""Source fingerprints (S6) and change detection (S7), of files and of their rows.

*Files.* A file whose length and time of change are those of the last published run keeps the hash recorded
there, so unchanged days are not read again.

*Rows.* A hash tree per source and day: buckets by the hash of a row's key, each with the multiset digest of its rows
(``functions.digests``). A day's digest is the sum of its buckets, so trees grow by adding, and two states of a
source are compared from the days down: only where digests differ are buckets, and then rows, compared.

Hashing runs on executors. A ``binaryFile`` listing gives path and length (the content column is
pruned, so no file is read there); the files are spread round-robin over the cluster and each
task streams its files through SHA-256 in fixed-size chunks. No file is ever held whole in memory,
so there is no per-file size limit (``binaryFile`` content stops at 2 GB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import FIELDS, KEY
from ledgerline.functions.digests import as_text, limb_sums, row_digest, word_sums, words

CHUNK_BYTES = 8 * 1024 * 1024


def arrow_uri(path):
    """A Hadoop path (``file:/x``, ``s3a://b/k``, ``hdfs://nn/x``) as an Arrow filesystem URI."""
    local = F.regexp_replace(path, r"^file:/+", "file:///")
    return F.regexp_replace(local, r"^s3[an]://", "s3://")


def fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(key 'YYYY-MM-DD/source', path, sha256, length, header) per input file; ``header`` is the
    file's first line, read while hashing."""
    chunk = CHUNK_BYTES

    # Defined here so it is shipped by value: executors need no copy of this package.
    def sha256_files(batches):
        import hashlib

        from pyarrow import fs

        for batch in batches:
            digests, headers = [], []
            for uri in batch["uri"]:
                filesystem, inner = fs.FileSystem.from_uri(uri)
                digest = hashlib.sha256()
                head, whole = [], False
                with filesystem.open_input_stream(inner, compression=None) as stream:
                    while block := stream.read(chunk):
                        digest.update(block)
                        if not whole:
                            line, mark, _ = block.partition(b"\n")
                            head.append(line)
                            whole = bool(mark)
                digests.append(digest.hexdigest())
                headers.append(b"".join(head).rstrip(b"\r").decode("utf-8", "replace"))
            yield batch.assign(sha256=digests, header=headers)

    listing = spark.read.format("binaryFile").load(paths).select("path", "length")
    spread = listing.repartition(spark.sparkContext.defaultParallelism).withColumn("uri", arrow_uri(F.col("path")))
    hashed = spread.mapInPandas(sha256_files, "path string, length long, uri string, sha256 string, header string")
    return hashed.select(_file_key().alias("key"), "path", "sha256", "length", "header")


def _file_key():
    parts = F.split(F.col("path"), "/")
    return F.concat(F.element_at(parts, -2), F.lit("/"), F.regexp_replace(F.element_at(parts, -1), r"\.csv$", ""))


def listing(spark: SparkSession, paths: list[str]) -> dict[str, dict]:
    """key: path, and ``stamp``, the file's length and time of change; no file is opened. One entry per input file."""
    files = spark.read.format("binaryFile").load(paths)
    stamp = F.concat_ws("@", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    return {r["key"]: r.asDict() for r in files.select(_file_key().alias("key"), "path", stamp.alias("stamp")).collect()}


def file_hashes(spark: SparkSession, files: dict[str, dict], known: dict[str, dict]) -> dict[str, dict]:
    """``files`` with ``sha256`` and ``header``; only files whose stamp is not the ``known`` one are read."""
    same = {k: f | known[k] for k, f in files.items() if k in known and known[k]["stamp"] == f["stamp"]}
    paths = [f["path"] for k, f in files.items() if k not in same]
    read = fingerprints(spark, paths).select("key", "sha256", "header").collect() if paths else []  # one row per file
    return same | {r["key"]: files[r["key"]] | r.asDict() for r in read}


def hash_tree(drops: DataFrame, kind: str) -> DataFrame:
    """(source, batch_date, bucket, rows, four limbs): the buckets of every day of raw ``drops``."""
    bucket = F.substring(F.sha2(F.coalesce(F.col(KEY[kind]), F.lit("")), 256), 1, 2)
    digest = row_digest(FIELDS[kind])
    rows = drops.select(F.lit(kind).alias("source"), "batch_date", bucket.alias("bucket"), digest.alias("digest"))
    return rows.groupBy("source", "batch_date", "bucket").agg(F.count(F.lit(1)).alias("rows"), *word_sums(words(F.col("digest"))))


def day_digests(tree: DataFrame) -> DataFrame:
    """(source, batch_date, rows, digest): the fingerprint of each source's day, from a hash tree or several in a union."""
    days = tree.groupBy("source", "batch_date").agg(F.sum("rows").alias("rows"), *limb_sums())
    return days.select("source", "batch_date", "rows", as_text().alias("digest"))


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """Days of two hash trees whose digests differ, appeared or disappeared."""
    return _differing(day_digests(before), day_digests(after), ["source", "batch_date"])


def changed_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """The differing buckets of the days that differ."""
    days = changed_days(before, after).select("source", "batch_date")
    named = [tree.join(days, ["source", "batch_date"], "left_semi").withColumn("digest", as_text()) for tree in (before, after)]
    return _differing(*named, ["source", "batch_date", "bucket"])


def _differing(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    a = before.select(*keys, F.col("rows").alias("rows_before"), F.col("digest").alias("before"))
    b = after.select(*keys, F.col("rows").alias("rows_after"), F.col("digest").alias("after"))
    return a.join(b, keys, "full").filter(~F.col("before").eqNullSafe(F.col("after")))


def changed_rows(before: DataFrame, after: DataFrame, buckets: DataFrame, kind: str) -> DataFrame:
    """(source, batch_date, bucket, key, digest, change, copies) of the rows that were added or removed in ``buckets``
    (``changed_buckets``). Of both states only rows of those buckets' days are compared."""
    mine = buckets.filter(F.col("source") == kind).select("batch_date", "bucket")
    parts = []
    for sign, drops in ((-1, before), (1, after)):
        key = F.coalesce(F.col(KEY[kind]), F.lit(""))
        rows = drops.join(mine.select("batch_date").distinct(), "batch_date", "left_semi")
        rows = rows.select("batch_date", F.substring(F.sha2(key, 256), 1, 2).alias("bucket"), key.alias("key"), row_digest(FIELDS[kind]).alias("digest"))
        parts.append(rows.join(mine, ["batch_date", "bucket"], "left_semi").withColumn("copies", F.lit(sign).cast("long")))
    counted = parts[0].unionByName(parts[1]).groupBy("batch_date", "bucket", "key", "digest").agg(F.sum("copies").alias("copies"))
    change = F.when(F.col("copies") > 0, "added").otherwise("removed")
    return counted.filter("copies <> 0").select(
        F.lit(kind).alias("source"), "batch_date", "bucket", "key", "digest", change.alias("change"), F.abs("copies").alias("copies")
    )


def source_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys whose digest differs, appeared or disappeared between two fingerprint sets."""
    a = before.select("key", F.col("sha256").alias("before"))
    b = after.select("key", F.col("sha256").alias("after"))
    return a.join(b, "key", "full").filter(~F.col("before").eqNullSafe(F.col("after")))
