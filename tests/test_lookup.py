"""Lookups that read little: bloom filters of record ids, and the trigram index."""

from pyspark.sql import functions as F

from ledgerline.operators import search
from ledgerline.operators.reader import request_filter
from ledgerline.sources import tables


def scanned(df):
    """Rows that the scans of a frame bring up, once it has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_record_lookup_reads_few_row_groups(spark, scratch, monkeypatch):
    monkeypatch.setattr(tables, "LOOKUP_GROUP_BYTES", 64 * 1024)
    rows = spark.range(40_000).select(F.concat(F.lit("F"), F.col("id") * 2).alias("record_id"), F.sha2(F.col("id").cast("string"), 256).alias("status"))
    dealt = rows.repartition(4, "record_id").withColumns({"batch_date": F.lit("2026-10-01"), "run_id": F.lit("r")})
    for name in ("gold_funding", "exceptions"):  # looked up by record, and not
        tables.write_dataset(dealt, scratch, name)
    one, plain = (tables.read_run(spark, scratch, name, "r", "2026-10-01").filter("record_id = 'F31416'") for name in ("gold_funding", "exceptions"))
    missing = tables.read_run(spark, scratch, "gold_funding", "r", "2026-10-01").filter("record_id = 'F31417'")
    assert one.count() == plain.count() == 1
    assert scanned(one) < 5_000 < 30_000 < scanned(plain)
    assert scanned(missing) <= scanned(one)


def test_the_index_prunes_files_and_decides_nothing(spark, scratch):
    rows = spark.range(3000).select(
        F.concat(F.lit("rec"), "id").alias("record_id"), F.concat(F.lit("Vendor"), (F.col("id") / 100).cast("int")).alias("vendor_id"), F.lit("MATCHED").alias("status")
    )
    rows = rows.unionByName(spark.createDataFrame([(None, "Straße ÄÖ", "BAD"), ("x", None, None)], "record_id string, vendor_id string, status string"))
    folder = f"{scratch}/rows"
    rows.repartitionByRange(8, "vendor_id").write.parquet(folder)
    search.write_index(spark, folder)
    for text in ("vendor17", "REC29", "straße ä", "VENDOR1", "nd", "", "nowhere", "  vendor2 "):
        want = rows.filter(request_filter(rows, search=text))
        assert sorted(map(str, search.search(spark, folder, text).collect())) == sorted(map(str, want.collect())), text
    assert 0 < len(search.candidate_files(spark, folder, "vendor17")) < len(search.candidate_files(spark, folder, "ndo"))
    assert search.candidate_files(spark, folder, "nowhere") == [] and search.candidate_files(spark, folder, "nd") is None
    assert search.search(spark, folder, "vendor1", status="BAD").count() == 0
    assert spark.read.parquet(folder).count() == 3002  # the index is no part of the dataset
