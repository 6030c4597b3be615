"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the lineitem adapter) over their whole extent.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import FUNDING_FIELDS, PAYOUT_FIELDS
from ledgerline.operators import reconcile as rec
from ledgerline.operators import summaries as summ
from ledgerline.operators.measures import identity_violation_count as violation_count
from ledgerline.operators import quality
from ledgerline.operators.validation import picked, quarantine, reason_counts
from ledgerline.plans.adapted import adapted_ledger, due_from_raw, gold_from_raw, lineitem, raw_funding
from ledgerline.plans.ledger import DUE, IDENTITY, SETTLED, due_funding, silver
from ledgerline.sources.adapter import funding_drops, payout_drops
from ledgerline.operators.validation import tag

Query = Callable[[SparkSession, str], DataFrame]


def _tagged_funding(spark, sf_dir):
    return tag(raw_funding(spark, sf_dir), "funding")


def _tagged_payouts(spark, sf_dir):
    return tag(payout_drops(due_from_raw(raw_funding(spark, sf_dir))), "payouts")


def _silver_payouts(spark, sf_dir):
    return silver(_tagged_payouts(spark, sf_dir), "payouts")


def funding_valid(spark, sf_dir):
    t = _tagged_funding(spark, sf_dir)
    return picked(t, True).select(*FUNDING_FIELDS, "batch_date", "source_file")


def payouts_valid(spark, sf_dir):
    t = _tagged_payouts(spark, sf_dir)
    return picked(t, True).select(*PAYOUT_FIELDS, "batch_date", "source_file")


def funding_quarantine(spark, sf_dir):
    return quarantine(picked(_tagged_funding(spark, sf_dir), False), "funding")


def payouts_quarantine(spark, sf_dir):
    return quarantine(picked(_tagged_payouts(spark, sf_dir), False), "payouts")


def quarantine_reason_counts(spark, sf_dir):
    tagged = tag(raw_funding(spark, sf_dir), "funding")  # one funding branch feeds both
    f = reason_counts(tagged).select(F.lit("funding").alias("source_type"), "*")
    p = reason_counts(tag(payout_drops(due_funding(tagged)), "payouts")).select(F.lit("payouts").alias("source_type"), "*")
    return f.unionByName(p)


def funding_latest(spark, sf_dir):
    _, silver_funding, _ = gold_from_raw(raw_funding(spark, sf_dir))
    return silver_funding


def payouts_latest(spark, sf_dir):
    return _silver_payouts(spark, sf_dir)


def funding_measures(spark, sf_dir):
    _, _, gold = gold_from_raw(raw_funding(spark, sf_dir))
    return gold.drop("source_file")


def identity_violation_count(spark, sf_dir):
    _, _, gold = gold_from_raw(raw_funding(spark, sf_dir))
    return violation_count(gold)


def reversal_reference_counts(spark, sf_dir):
    return rec.reference_counts(_silver_payouts(spark, sf_dir)).select("referenced_id", "reference_count")


def reversal_links(spark, sf_dir):
    return rec.reversal_links(_silver_payouts(spark, sf_dir), cross_date=True)


def contra_pairs(spark, sf_dir):
    return rec.contra_pairs(_silver_payouts(spark, sf_dir), cross_date=True)


def settlement_rollup(spark, sf_dir):
    return rec.settlement_rollup(_silver_payouts(spark, sf_dir), cross_date=True)


def _recon(spark, sf_dir, cross_date=True):
    return adapted_ledger(spark, sf_dir, cross_date=cross_date).reconciliation


def reconcile_cross_date(spark, sf_dir):
    return _recon(spark, sf_dir, True)


def reconcile_same_date(spark, sf_dir):
    return _recon(spark, sf_dir, False)


def exceptions(spark, sf_dir):
    return rec.exceptions(_recon(spark, sf_dir))


def status_distribution(spark, sf_dir):
    return summ.status_distribution(_recon(spark, sf_dir))


def vendor_summary(spark, sf_dir):
    return summ.vendor_summary(_recon(spark, sf_dir))


def month_end_summary(spark, sf_dir):
    return summ.month_end_summary(_recon(spark, sf_dir))


def month_end_report(spark, sf_dir):
    return summ.month_end_report(_recon(spark, sf_dir))


def ledger_totals(spark, sf_dir):
    return summ.ledger_totals(_recon(spark, sf_dir))


def monthly_totals(spark, sf_dir):
    return summ.monthly_totals(summ.month_end_summary(_recon(spark, sf_dir)))


def vendor_list(spark, sf_dir):
    return summ.vendor_list(_recon(spark, sf_dir))


def _counts(spark, sf_dir):
    led = adapted_ledger(spark, sf_dir, columns=(*DUE, *IDENTITY))
    return quality.ledger_counts(led.tagged, {"payouts": led.settled}, led.due, led.reconciliation)


def metrics(spark, sf_dir):
    """The latest rows are counted in the frames that need their fewest columns: ``due``, of which the payouts are made,
    and ``settled``."""
    led = adapted_ledger(spark, sf_dir)
    return quality.metrics_of(quality.ledger_counts(led.tagged, {"funding": led.due, "payouts": led.settled}))


def gates(spark, sf_dir):
    return quality.gates_of(_counts(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "funding_valid": funding_valid,
    "payouts_valid": payouts_valid,
    "funding_quarantine": funding_quarantine,
    "payouts_quarantine": payouts_quarantine,
    "quarantine_reason_counts": quarantine_reason_counts,
    "funding_latest": funding_latest,
    "payouts_latest": payouts_latest,
    "funding_measures": funding_measures,
    "identity_violations": identity_violation_count,
    "reversal_reference_counts": reversal_reference_counts,
    "reversal_links": reversal_links,
    "contra_pairs": contra_pairs,
    "settlement_rollup": settlement_rollup,
    "reconcile_cross_date": reconcile_cross_date,
    "reconcile_same_date": reconcile_same_date,
    "exceptions": exceptions,
    "status_distribution": status_distribution,
    "vendor_summary": vendor_summary,
    "month_end_summary": month_end_summary,
    "month_end_report": month_end_report,
    "ledger_totals": ledger_totals,
    "monthly_totals": monthly_totals,
    "vendor_list": vendor_list,
    "quality_metrics": metrics,
    "quality_gates": gates,
}


# ---------------------------------------------------------------------------
# Reader, publication and operations queries.
# The run history is derived from the partition dates of the funding drops: one run per as-of
# date, a replay on every 7th day of a month and a failed run on the 13th; ledger rows carry the
# run of their drop date (the failed run's on the 13th).
# ---------------------------------------------------------------------------
from ledgerline.contracts import POLICY_VERSION  # noqa: E402
from ledgerline.operators import operations as ops  # noqa: E402
from ledgerline.operators import reader  # noqa: E402
from ledgerline.sources.tables import current_run, published, scratch_root  # noqa: E402

RETENTION_CUTOFF = "2001-06-01T00:00:00+00:00"
ORPHAN_CUTOFF = "2002-01-01T00:00:00+00:00"
HEALTH_NOW = "2001-11-05T12:00:00+00:00"
AS_OF = "1998-06-30"
PAGE = dict(status="MATCHED", page=3, size=25)
SEARCH = "V000012"
AFTER = dict(record_id="F4504-5", vendor_id="V000088", status="MATCHED")


def _run_id(date_col, suffix: str):
    return F.substring(F.sha2(F.concat(date_col, F.lit(suffix)), 256), 1, 32)


def derived_audit(spark, sf_dir):
    dates = raw_funding(spark, sf_dir).select("batch_date").distinct()
    day = F.dayofmonth(F.col("batch_date").try_cast("date"))

    def run(suffix, hour, status, keep):
        return dates.filter(keep).select(
            _run_id(F.col("batch_date"), suffix).alias("run_id"),
            "batch_date",
            F.lit(status).alias("status"),
            F.concat("batch_date", F.lit(f"T{hour}:00:00+00:00")).alias("completed_at"),
            F.lit(POLICY_VERSION).alias("policy_version"),
            F.lit("{}").alias("quality_json"),
        )

    return (
        run("#1", "03", "SUCCEEDED", F.lit(True))
        .unionByName(run("#2", "05", "SUCCEEDED", day % 7 == 0))
        .unionByName(run("#3", "06", "FAILED", day == 13))
    )


def _stamped(df, date_column="event_date"):
    """Ledger rows with the lineage of the run that wrote them."""
    failed = F.dayofmonth(F.col(date_column).try_cast("date")) == 13
    suffix = F.when(failed, F.lit("#3")).otherwise(F.lit("#1"))
    hour = F.when(failed, F.lit("T06:00:00+00:00")).otherwise(F.lit("T03:00:00+00:00"))
    return df.withColumns(
        {
            "run_id": F.substring(F.sha2(F.concat(F.col(date_column), suffix), 256), 1, 32),
            "batch_date": F.col(date_column),
            "written_at": F.concat(F.col(date_column), hour).try_cast("timestamp"),
        }
    )


def current_snapshot(spark, sf_dir):
    return current_run(derived_audit(spark, sf_dir))


def superseded_runs(spark, sf_dir):
    return ops.superseded_runs(derived_audit(spark, sf_dir), RETENTION_CUTOFF)


def published_rows(spark, sf_dir):
    due = due_from_raw(raw_funding(spark, sf_dir))
    rows = _stamped(due.select("record_id", "vendor_id", "event_date", "net_payable"))
    return published(rows, derived_audit(spark, sf_dir)).select("record_id", "vendor_id", "event_date", "net_payable", "run_id")


def _stamped_tables(spark, sf_dir):
    due = due_from_raw(raw_funding(spark, sf_dir))
    payouts = silver(tag(payout_drops(due), "payouts"), "payouts")
    return {
        "gold_funding": _stamped(due.select("record_id", "event_date")),
        "silver_payouts": _stamped(payouts.select("payout_id", "event_date")),
    }


def orphan_rows(spark, sf_dir):
    return ops.orphan_rows(_stamped_tables(spark, sf_dir), derived_audit(spark, sf_dir), ORPHAN_CUTOFF)


def orphan_runs(spark, sf_dir):
    return ops.orphan_runs(_stamped_tables(spark, sf_dir), derived_audit(spark, sf_dir), ORPHAN_CUTOFF)


def freshness(spark, sf_dir):
    return ops.freshness(derived_audit(spark, sf_dir), HEALTH_NOW)


def ledger_page(spark, sf_dir):
    return reader.ledger_page(_recon(spark, sf_dir), **PAGE)


def ledger_search_count(spark, sf_dir):
    return reader.ledger_count(_recon(spark, sf_dir), search=SEARCH)


def ledger_page_after(spark, sf_dir):
    rows = _recon(spark, sf_dir)
    return reader.page_after(rows, cursor_behind(rows, **AFTER), status="MATCHED", size=25).drop("cursor")


def quarantine_search(spark, sf_dir):
    led = adapted_ledger(spark, sf_dir)
    rows = led.datasets()["quarantine"]
    return rows.filter(reader.request_filter(rows, search="currency"))


def exceptions_of_vendor(spark, sf_dir):
    rows = rec.exceptions(_recon(spark, sf_dir))
    return rows.filter(reader.request_filter(rows, vendor_id=SEARCH))


def record_drilldown(spark, sf_dir):
    led = adapted_ledger(spark, sf_dir)
    bad = led.reconciliation.filter(F.col("status") == "INVALID_REVERSAL")
    # The least record comes with the columns that the drill-down shows, so that both read the same shuffles.
    shown = F.struct("record_id", "event_date", "status", "variance")
    first = bad.agg(F.min(F.when(F.col("record_id").isNotNull(), shown)).alias("first")).select("first.record_id")
    return reader.record_drilldown(led.due, led.reconciliation, led.settled, first)


def as_of_status_counts(spark, sf_dir):
    from ledgerline.operators.summaries import status_distribution as dist

    return dist(adapted_ledger(spark, sf_dir, as_of_date=AS_OF).reconciliation)


def as_of_snapshot(spark, sf_dir):
    from ledgerline.plans.ledger import drop_inventory

    raw = raw_funding(spark, sf_dir)
    return drop_inventory(raw, payout_drops(due_from_raw(raw)), AS_OF)


def _kept(spark):
    """Writes a small frame below the shared folder and reads it back."""

    def keep(rows: DataFrame) -> DataFrame:
        path = f"{scratch_root(spark)}/totals"
        rows.write.parquet(path)
        return spark.read.parquet(path)

    return keep


def replay_diff(spark, sf_dir):
    """Two ledgers of different as-of dates: every status differs."""
    earlier = adapted_ledger(spark, sf_dir, as_of_date=AS_OF).reconciliation
    return ops.replay_diff(earlier, _recon(spark, sf_dir), _kept(spark))


def replay_same(spark, sf_dir):
    """A replay of the same inputs in another row order: nothing differs. The narrow source rows are dealt anew, over as
    many tasks as a shuffle has."""
    due = due_from_raw(funding_drops(lineitem(spark, sf_dir).repartition("l_partkey", "l_orderkey", "l_linenumber")))
    again = rec.reconcile(due, silver(tag(payout_drops(due), "payouts"), "payouts", SETTLED), cross_date=True)
    return ops.replay_diff(_recon(spark, sf_dir), again, _kept(spark))


def gate_alerts(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return quality.gate_alerts(quality.gates_of(counts), quality.metrics_of(counts))


def output_counts(spark, sf_dir):
    return quality.output_counts_of(_counts(spark, sf_dir))


QUERIES.update(
    {
        "current_snapshot": current_snapshot,
        "superseded_runs": superseded_runs,
        "published_rows": published_rows,
        "orphan_rows": orphan_rows,
        "freshness": freshness,
        "ledger_page": ledger_page,
        "ledger_search_count": ledger_search_count,
        "record_drilldown": record_drilldown,
        "as_of_status_counts": as_of_status_counts,
        "as_of_snapshot": as_of_snapshot,
        "replay_diff": replay_diff,
        "alerts": gate_alerts,
        "output_counts": output_counts,
    }
)


# ---------------------------------------------------------------------------
# Queries that write below the shared folder and read back.
# ---------------------------------------------------------------------------
from ledgerline.contracts import DATASETS, FIELDS, KEY  # noqa: E402
from ledgerline.operators import pages  # noqa: E402
from ledgerline.operators import search as text_search  # noqa: E402
from ledgerline.operators.pages import cursor_behind  # noqa: E402
from ledgerline.operators.versions import merged  # noqa: E402
from ledgerline.plans.broken import broken_funding, broken_payouts  # noqa: E402
from ledgerline.plans.staged import publish_staged  # noqa: E402
from ledgerline.sources import fingerprints as prints  # noqa: E402
from ledgerline.sources import tables  # noqa: E402

#: Ledgers that this application has published, by table folder and as-of date.
_PUBLISHED: dict[tuple, tuple[str, dict]] = {}
LAST_DAYS = ("1998-06-30", "1998-06-28", "1998-06-29")  # late days come after a newer one


def _published_ledger(spark, sf_dir):
    """The root of a ledger published from all drops, and its manifest; published once an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED:
        root = tables.scratch_root(spark)
        raw = raw_funding(spark, sf_dir)
        last = raw.agg(F.max("batch_date")).first()[0]
        _PUBLISHED[key] = (root, publish_staged(spark, raw, payout_drops, root, last, run_id="first"))
    return _PUBLISHED[key]


def published_reconciliation(spark, sf_dir):
    """The published run's reconciliation, read back by name."""
    root, manifest = _published_ledger(spark, sf_dir)
    return reader.dataset(spark, root, "gold_reconciliation", manifest["run_id"]).drop("policy_version")


def published_view(spark, sf_dir):
    """The same through the SQL view of the published run."""
    root, _ = _published_ledger(spark, sf_dir)
    tables.create_current_view(spark, root)
    return spark.sql("SELECT status, count(*) AS rows, sum(variance) AS variance FROM current_reconciliation GROUP BY status")


def published_counts(spark, sf_dir):
    """Rows of every published dataset, with one policy version and batch date each."""
    root, manifest = _published_ledger(spark, sf_dir)
    audit = tables.read_audit(spark, root)
    parts = []
    for name in DATASETS:
        rows = tables.published(tables.read_dataset(spark, root, name), audit)
        lineage = [F.max(c).alias(c) for c in ("batch_date", "policy_version")]
        counted = rows.agg(F.count(F.lit(1)).alias("rows"), *lineage, F.count("written_at").alias("stamped"))
        parts.append(counted.select(F.lit(name).alias("dataset"), "*"))
    return reduce(DataFrame.unionByName, parts)


def published_drilldown(spark, sf_dir):
    """All that the published run knows of its first record with a broken reversal. The id is a literal, so the
    scans of the three datasets skip files and row groups by their sorted ids and bloom filters."""
    root, _ = _published_ledger(spark, sf_dir)
    ledger = reader.dataset(spark, root, "gold_reconciliation")
    worst = ledger.filter(F.col("status") == "INVALID_REVERSAL").agg(F.min("record_id")).first()[0]
    funding, payouts = (reader.dataset(spark, root, name) for name in ("gold_funding", "silver_payouts"))
    return reader.record_drilldown(funding, ledger, payouts, worst)


def indexed_search(spark, sf_dir):
    """Rows of the published reconciliation that match a search, through the trigram index of its files."""
    root, manifest = _published_ledger(spark, sf_dir)
    folder = tables.run_folder(root, "gold_reconciliation", manifest["run_id"], manifest["batch_date"])
    if not tables.exists(spark, text_search.index_path(folder)):
        text_search.write_index(spark, folder)
    return text_search.search(spark, folder, SEARCH).drop("written_at", "policy_version")


def published_alerts(spark, sf_dir):
    """The alerts of the published run, from their table."""
    root, _ = _published_ledger(spark, sf_dir)
    return ops.alerts_listing(tables.read_alerts(spark, root)).select("run_id", "batch_date", "severity", "category")


def manifest_report(spark, sf_dir):
    """The typed report of the published run, from its audit row on disk."""
    root, manifest = _published_ledger(spark, sf_dir)
    report = ops.manifest_report(tables.read_audit(spark, root), manifest["batch_date"])
    return report.drop("completed_at")


#: A figure of each part of the audit document, and what a planted replay reports instead.
PLANTED = {
    "inputs": ("lineitem", "another"),
    "content": (f"{AS_OF}/funding", "another"),
    "metrics.funding": ("input", -1),
    "metrics.payouts": ("quarantined", -2),
    "output_counts": ("exceptions", -3),
    "reconciliation": ("MATCHED", -4),
    "totals": ("paid", "-5.00"),
    "checksums": ("silver_payouts", "another"),
}


def replay_differences(spark, sf_dir):
    """The published run against a replay that recorded one different figure of each kind."""
    import json

    root, manifest = _published_ledger(spark, sf_dir)
    audit = tables.read_audit(spark, root).filter(F.col("run_id") == manifest["run_id"])
    document = json.loads(audit.first()["quality_json"])  # one row
    document["inputs"] = {"lineitem": "one", "parts": "same"}
    replay = json.loads(json.dumps(document))
    for path, (name, value) in PLANTED.items():
        part = reduce(dict.__getitem__, path.split("."), replay)
        part[name] = value
    written = f"{tables.scratch_root(spark)}/audit"
    rows = [(run, manifest["batch_date"], "SUCCEEDED", "", POLICY_VERSION, json.dumps(d)) for run, d in (("first", document), ("replay", replay))]
    spark.createDataFrame(rows, tables.AUDIT_SCHEMA).write.parquet(written)
    return ops.replay_differences(spark.read.parquet(written), "first", "replay")


def latest_incremental(spark, sf_dir):
    """Latest funding rows as of AS_OF: a snapshot without the last three days, then each of them brought in."""
    raw = raw_funding(spark, sf_dir)
    first, rest = min(LAST_DAYS), tables.scratch_root(spark)
    snapshot = silver(tag(raw.filter(F.col("batch_date") < first), "funding"), "funding")
    for n, day in enumerate([None, *LAST_DAYS]):
        if day is not None:
            fresh = silver(tag(raw.filter(F.col("batch_date") == day), "funding"), "funding")
            snapshot = merged(snapshot, fresh, KEY["funding"], FIELDS["funding"])
        snapshot.write.parquet(f"{rest}/{n}")
        snapshot = spark.read.parquet(f"{rest}/{n}")
    return snapshot


def _all_quarantine(spark, sf_dir):
    led = adapted_ledger(spark, sf_dir)
    return led.datasets()["quarantine"]


def quarantine_page(spark, sf_dir):
    """Page 30 of the quarantine, which has no order column, through its page directory."""
    path = f"{tables.scratch_root(spark)}/quarantine"
    pages.write_pages(_all_quarantine(spark, sf_dir), path, rows_per_range=200)
    return pages.page_at(spark, path, 30, 25)


def tied_pages(spark, sf_dir):
    """All pages of a frame full of nulls and equal rows."""
    path = f"{tables.scratch_root(spark)}/ties"
    rows = _silver_payouts(spark, sf_dir).select("vendor_id", F.lit(None).cast("string").alias("status"), "event_date", F.col("reversal_of").isNull().alias("plain"))
    pages.write_pages(rows, path, rows_per_range=5_000)
    return pages.page_bounds(spark, path, 100)


def quarantine_walk(spark, sf_dir):
    """Four pages of the quarantine's funding rows, one after the other by cursor; all but the last are only passed.
    The quarantine is written first, as a publication would, so that the drops are validated once and not for every page."""
    path = f"{tables.scratch_root(spark)}/quarantine"
    quarantine(picked(_tagged_funding(spark, sf_dir), False), "funding").write.parquet(path)
    rows = spark.read.parquet(path)
    after = None
    for _ in range(3):
        after = reader.page_after(rows, after, size=50).collect()[-1]["cursor"]  # one page
    return reader.page_after(rows, after, size=50).drop("cursor")


def _broken(spark, sf_dir):
    """A ledger over drops that break every rule of the contract."""
    raw = broken_funding(raw_funding(spark, sf_dir))
    tagged_f = tag(raw, "funding")
    silver_f, due = silver(tagged_f, "funding"), due_funding(tagged_f, (*DUE, *IDENTITY))
    tagged_p = tag(broken_payouts(payout_drops(due)), "payouts")
    silver_p = silver(tagged_p, "payouts")
    return {"funding": tagged_f, "payouts": tagged_p}, {"funding": silver_f, "payouts": silver_p}, due, rec.reconcile(due, silver_p, cross_date=True)


def broken_reason_counts(spark, sf_dir):
    """All 37 reasons."""
    tagged, _, _, _ = _broken(spark, sf_dir)
    parts = [reason_counts(tagged[kind]).select(F.lit(kind).alias("source_type"), "*") for kind in tagged]
    return parts[0].unionByName(parts[1])


def broken_gates(spark, sf_dir):
    return quality.gates_of(quality.ledger_counts(*_broken(spark, sf_dir)))


def broken_alerts(spark, sf_dir):
    counts = quality.ledger_counts(*_broken(spark, sf_dir))
    return quality.gate_alerts(quality.gates_of(counts), quality.metrics_of(counts))


def broken_payouts_latest(spark, sf_dir):
    """Latest payouts where a seventh of them has a corrected second version."""
    _, latest_rows, _, _ = _broken(spark, sf_dir)
    return latest_rows["payouts"]


def _trees(spark, sf_dir):
    """Hash trees of both sources, and of a changed state: quantities and amounts of the 7th of a month corrected, the rows
    of the 21st gone. The trees are written, as a publication would. So are the payout drops, which take a ledger to
    derive, because both states and their rows are read from them."""
    root = tables.scratch_root(spark)
    raw = {"funding": raw_funding(spark, sf_dir)}
    payout_drops(due_from_raw(raw["funding"])).write.parquet(f"{root}/payouts")
    raw["payouts"] = spark.read.parquet(f"{root}/payouts")
    day = F.substring("batch_date", 9, 2)
    changed = {}
    for kind, column, value in (("funding", "quantity", "1"), ("payouts", "amount", "1.00")):
        changed[kind] = raw[kind].filter(day != "21").withColumn(column, F.when(day == "07", F.lit(value)).otherwise(F.col(column)))
    trees = []
    for name, state in (("before", raw), ("after", changed)):
        for kind in state:
            prints.hash_tree(state[kind], kind).write.mode("append").parquet(f"{root}/{name}")
        trees.append(spark.read.parquet(f"{root}/{name}"))
    return raw, changed, *trees


def source_fingerprint(spark, sf_dir):
    raw = raw_funding(spark, sf_dir)
    trees = [prints.hash_tree(raw, "funding"), prints.hash_tree(payout_drops(due_from_raw(raw)), "payouts")]
    return prints.day_digests(trees[0].unionByName(trees[1]))


def source_changes(spark, sf_dir):
    """Days of both sources that differ after the change."""
    _, _, before, after = _trees(spark, sf_dir)
    return prints.changed_days(before, after)


def source_changed_buckets(spark, sf_dir):
    _, _, before, after = _trees(spark, sf_dir)
    return prints.changed_buckets(before, after)


def source_changed_rows(spark, sf_dir):
    """The rows behind it, found from the days down."""
    raw, changed, before, after = _trees(spark, sf_dir)
    buckets = prints.changed_buckets(before, after)
    parts = [prints.changed_rows(raw[kind], changed[kind], buckets, kind) for kind in raw]
    return parts[0].unionByName(parts[1])


QUERIES.update(
    {
        "published_reconciliation": published_reconciliation,
        "published_view": published_view,
        "published_counts": published_counts,
        "published_drilldown": published_drilldown,
        "published_alerts": published_alerts,
        "indexed_search": indexed_search,
        "manifest_report": manifest_report,
        "replay_differences": replay_differences,
        "latest_incremental": latest_incremental,
        "quarantine_page": quarantine_page,
        "tied_pages": tied_pages,
        "quarantine_walk": quarantine_walk,
        "broken_reason_counts": broken_reason_counts,
        "broken_gates": broken_gates,
        "broken_alerts": broken_alerts,
        "broken_payouts_latest": broken_payouts_latest,
        "source_fingerprint": source_fingerprint,
        "source_changes": source_changes,
        "source_changed_buckets": source_changed_buckets,
        "source_changed_rows": source_changed_rows,
        "orphan_runs": orphan_runs,
        "ledger_page_after": ledger_page_after,
        "quarantine_search": quarantine_search,
        "exceptions_of_vendor": exceptions_of_vendor,
        "replay_same": replay_same,
    }
)
