"""What a query has on disk: only the columns that it needs are shuffled, each once, and not longer than needed."""

import glob

import pytest
from pyspark.sql import functions as F
from test_work_once import lineitem_dir, plan_of  # noqa: F401

import __spark_entry__
from ledgerline.operators.operations import replay_diff
from ledgerline.operators.reconcile import settlement_rollup
from ledgerline.operators.versions import content_digest, latest


@pytest.fixture(scope="module")
def queries():
    return __spark_entry__.queries()


def latest_rows(df):
    """The lines of the plan that take the latest rows."""
    return [line for line in plan_of(df).splitlines() if "Aggregate" in line and "AS _best" in line]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for f in glob.glob(f"{folder}/**/shuffle_*.data", recursive=True)}


def test_metrics_shuffle_narrow_rows(spark, lineitem_dir, queries):  # noqa: F811
    metrics = queries["quality_metrics"](spark, lineitem_dir)
    lines = latest_rows(metrics)
    assert lines and not [line for line in lines if "penalty" in line or "source_file" in line]
    rows = {r["source"]: r for r in metrics.collect()}
    assert rows["funding"]["input"] == 1200 and rows["funding"]["valid"] == 1200 - rows["funding"]["quarantined"] > 0
    assert rows["payouts"]["input"] == rows["payouts"]["valid"] + rows["payouts"]["quarantined"] + rows["payouts"]["duplicate_versions"]


def test_drilldown_reads_the_drops_once(spark, lineitem_dir, queries):  # noqa: F811
    found = queries["record_drilldown"](spark, lineitem_dir)
    assert final_plan(found).count("FileScan") == 1
    rows = found.collect()
    assert {r["part"] for r in rows} == {"funding", "reconciliation", "payouts"} and len({r["record_id"] for r in rows}) == 1
    ledger = queries["reconcile_cross_date"](spark, lineitem_dir).filter("status = 'INVALID_REVERSAL'")
    assert rows[0]["record_id"] == ledger.agg(F.min("record_id")).first()[0]


def test_same_date_reconciliation_shuffles_a_date_once(spark, lineitem_dir, queries):  # noqa: F811
    ledger = queries["reconcile_same_date"](spark, lineitem_dir)
    plan = plan_of(ledger)
    assert "min(event_date" not in plan and "first_settlement_date" in plan
    assert not [line for line in latest_rows(ledger) if "source_file" in line]


def test_same_date_settlements_have_their_date(spark):
    rows = [(f"P{n}", "F1", "V1", "INR", day, amount, None) for n, (day, amount) in enumerate([("2026-10-01", "5"), ("2026-10-01", "-5"), ("2026-10-02", "7"), (None, "1")])]
    payouts = spark.createDataFrame(rows, "payout_id string, record_id string, vendor_id string, currency string, event_date string, amount string, reversal_of string")
    found = settlement_rollup(payouts, cross_date=False).collect()
    assert {(r["event_date"], r["payout_count"], r["contra_pair_count"]) for r in found} == {("2026-10-01", 2, 1), ("2026-10-02", 1, 0), (None, 1, 0)}
    assert all(r["first_settlement_date"] == r["last_settlement_date"] == r["event_date"] for r in found)


def test_ties_are_broken_by_the_larger_digest(spark):
    """As by the whole digest, of which a shuffled row holds a part."""
    rows = [(f"K{n % 20}", "2026-10-01T01:00:00Z", str(n)) for n in range(400)]
    df = spark.createDataFrame(rows, "k string, updated_at string, text string")
    best = latest(df, "k")
    whole = df.select("k", F.struct(content_digest(["k", "updated_at", "text"]), "text").alias("d")).groupBy("k").agg(F.max("d.text").alias("_"), F.max("d").alias("d"))
    assert {(r["k"], r["text"]) for r in best.collect()} == {(r["k"], r["d"]["text"]) for r in whole.collect()}
    assert "substring(unhex" in plan_of(best)


def test_replays_keep_totals_alone(spark, lineitem_dir, queries):  # noqa: F811
    before = shuffle_files(spark)
    for name, rows in (("replay_same", 0), ("replay_diff", 7)):
        found = queries[name](spark, lineitem_dir)
        assert found.inputFiles() and not any("lineitem" in f for f in found.inputFiles())
        assert not shuffle_files(spark) - before
        assert (found.count() > 0) == (rows > 0)


def test_kept_totals_give_the_same_differences(spark):
    ledgers = [spark.createDataFrame(rows, "status string, net_payable decimal(20,2), paid_amount decimal(20,2), variance decimal(20,2)") for rows in ([("A", None, None, None), ("B", None, None, None)], [("A", None, None, None)] * 2)]
    kept = []

    def keep(df):
        kept.append(df)
        return spark.createDataFrame(df.collect(), df.schema)

    assert sorted(map(tuple, replay_diff(*ledgers, keep).collect())) == sorted(map(tuple, replay_diff(*ledgers).collect()))
    assert len(kept) == 2
