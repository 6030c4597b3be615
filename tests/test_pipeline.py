"""End-to-end: CSV drops -> ledger -> gates -> run-tagged tables -> audit commit."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.contracts import FUNDING_FIELDS, PAYOUT_FIELDS
from ledgerline.operators import operations as ops
from ledgerline.operators.quality import QualityFailure, QualityPolicy
from ledgerline.operators.reader import dataset, ledger_count, ledger_page, page_after, record_drilldown
from ledgerline.plans.publish import PublicationRefused, run
from ledgerline.sources import tables
from ledgerline.sources.fingerprints import fingerprints

BASE = dict(
    vendor_id="V1",
    order_id="O1",
    currency="INR",
    quantity="2",
    unit_price="100",
    discount_rate="0.10",
    return_rate="0.05",
    commission_rate="0.12",
    tax_rate="0.18",
    withholding_rate="0.01",
    logistics_per_unit="15",
    marketing_rate="0.02",
    rebate_rate="0.03",
    penalty="5",
    adjustment="-2.50",
)
NET = "109.29"  # golden net payable of BASE


def write_day(root, day, funding, payouts):
    folder = os.path.join(root, "raw", day)
    os.makedirs(folder, exist_ok=True)
    for name, fields, rows in (("funding", FUNDING_FIELDS, funding), ("payouts", PAYOUT_FIELDS, payouts)):
        with open(os.path.join(folder, f"{name}.csv"), "w", newline="") as handle:
            writer = csv.DictWriter(handle, fieldnames=fields)
            writer.writeheader()
            for row in rows:
                writer.writerow(row)
    return folder


def funding_row(record_id, day, **extra):
    row = dict(BASE, record_id=record_id, event_date=day, updated_at=f"{day}T01:00:00Z")
    row.update(extra)
    return row


def payout_row(payout_id, record_id, day, amount=NET, reversal_of=""):
    return dict(
        payout_id=payout_id,
        record_id=record_id,
        vendor_id="V1",
        event_date=day,
        currency="INR",
        amount=amount,
        reversal_of=reversal_of,
        updated_at=f"{day}T02:00:00Z",
    )


LOOSE = QualityPolicy(max_quarantine_ratio=0.1)


@pytest.fixture
def ledger_root(tmp_path):
    root = str(tmp_path)
    day = "2026-10-01"
    funding = [funding_row(f"F{i}", day) for i in range(20)]
    funding.append(funding_row("F0", day, updated_at=f"{day}T00:30:00Z"))  # an older version
    funding.append(funding_row("BAD", day, quantity="-1"))  # quarantined
    payouts = [payout_row(f"P{i}", f"F{i}", day) for i in range(18)]
    write_day(root, day, funding, payouts)
    return root


def test_a_run_counts_what_it_wrote(spark, ledger_root):
    done = run(spark, ledger_root, "2026-10-01", policy=LOOSE)
    assert done["reconciliation"] == {"MATCHED": 18, "MISSING_PAYOUT": 2}
    assert done["output_counts"]["gold_funding"] == 20 and done["output_counts"]["quarantine"] == 1
    quality = done["quality"]["funding"]
    assert (quality["input"], quality["valid"], quality["quarantined"], quality["duplicate_versions"]) == (22, 20, 1, 1)
    assert tables.read_audit(spark, ledger_root).count() == 1


def test_a_failed_gate_leaves_the_published_run(spark, ledger_root):
    done = run(spark, ledger_root, "2026-10-01", policy=LOOSE)
    with pytest.raises(QualityFailure, match="quarantine"):
        run(spark, ledger_root, "2026-10-01", policy=QualityPolicy(max_quarantine_ratio=0))
    assert tables.current_run(tables.read_audit(spark, ledger_root)).first()["run_id"] == done["run_id"]
    assert {r["category"] for r in tables.read_alerts(spark, ledger_root).collect()} == {"QUALITY_EXCEPTIONS", "QUALITY_GATE_FAILED"}


def test_readers_see_the_published_run_only(spark, ledger_root):
    old, new = (run(spark, ledger_root, "2026-10-01", policy=LOOSE) for _ in range(2))
    assert {r["run_id"] for r in tables.snapshot(spark, ledger_root, "exceptions").collect()} == {new["run_id"]}
    assert dataset(spark, ledger_root, "gold_reconciliation").count() == 20
    with pytest.raises(RuntimeError):
        dataset(spark, ledger_root, "gold_reconciliation", run_id=old["run_id"])
    with pytest.raises(LookupError, match="no dataset 'gold'"):
        dataset(spark, ledger_root, "gold")
    tables.create_current_view(spark, ledger_root, "gold_month_end", "months")
    assert spark.sql("SELECT DISTINCT run_id FROM months").first()["run_id"] == new["run_id"]
    superseded = ops.superseded_runs(tables.read_audit(spark, ledger_root), "2999-01-01T00:00:00+00:00")
    assert [r["run_id"] for r in superseded.collect()] == [old["run_id"]]


def test_publication_does_not_go_back_in_time(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2026-11-01", "2026-11-02"):
        write_day(root, day, [funding_row(f"N{day}", day)], [payout_row(f"Q{day}", f"N{day}", day)])
    run(spark, root, "2026-11-02")
    with pytest.raises(PublicationRefused, match="lies before the published"):
        run(spark, root, "2026-11-01")


@pytest.mark.parametrize("name", ["funding", "payouts"])
def test_another_field_list_is_refused(spark, tmp_path, name):
    root, day = str(tmp_path), "2026-11-03"
    folder = write_day(root, day, [funding_row("N", day)], [])
    path = os.path.join(folder, f"{name}.csv")
    with open(path) as handle:
        fields, _, rest = handle.read().partition("\n")
    with open(path, "w") as handle:
        handle.write(fields.replace("currency", "money") + "\n" + rest)
    with pytest.raises(ValueError, match="header"):
        run(spark, root, day)
    assert tables.read_audit(spark, root).count() == 0


def test_header_differing_only_in_case_fails(spark, ledger_root):
    day = "2026-10-01"
    published = run(spark, ledger_root, day, policy=QualityPolicy(max_quarantine_ratio=0.1))
    path = os.path.join(ledger_root, "raw", day, "payouts.csv")
    with open(path) as handle:
        lines = handle.read().split("\n", 1)
    with open(path, "w") as handle:
        handle.write(lines[0].upper() + "\n" + lines[1])
    with pytest.raises(ValueError, match="header"):
        run(spark, ledger_root, day, policy=QualityPolicy(max_quarantine_ratio=0.1))
    audit = tables.read_audit(spark, ledger_root)
    assert tables.current_run(audit).first()["run_id"] == published["run_id"]
    failures = tables.read_alerts(spark, ledger_root).filter(F.col("category") == "PIPELINE_FAILED")
    assert failures.count() == 1


def test_late_settlement_in_later_partition(spark, tmp_path):
    root = str(tmp_path)
    write_day(root, "2026-09-30", [funding_row("M", "2026-09-30")], [])
    write_day(root, "2026-10-01", [], [payout_row("LATE", "M", "2026-10-01")])
    manifest = run(spark, root, "2026-10-01")
    assert manifest["source_partitions"] == ["2026-09-30", "2026-10-01"]
    assert manifest["reconciliation"] == {"MATCHED": 1}
    month = tables.snapshot(spark, root, "gold_month_end").first()
    assert month["accounting_month"] == "2026-09"
    with pytest.raises(FileNotFoundError):
        run(spark, root, "2026-10-02")


@pytest.mark.parametrize(
    "folder,files,error",
    [
        ("2026-09-29", [], FileNotFoundError),  # empty
        ("2026-09-29", ["Funding.csv", "payouts.csv"], FileNotFoundError),  # another case
        ("2026-09-29", ["payouts.csv"], FileNotFoundError),
        ("not-a-date", [], ValueError),
    ],
)
def test_an_incomplete_day_is_refused(spark, tmp_path, folder, files, error):
    from ledgerline.sources.csv_drops import selected_days

    write_day(str(tmp_path), "2026-09-30", [funding_row("M", "2026-09-30")], [])
    (tmp_path / "raw" / folder).mkdir()
    for name in files:
        (tmp_path / "raw" / folder / name).write_text("x\n")
    with pytest.raises(error):
        selected_days(spark, str(tmp_path), "2026-09-30")


def test_reader_filters_and_bounds(spark, ledger_root):
    run(spark, ledger_root, "2026-10-01", policy=QualityPolicy(max_quarantine_ratio=0.1))
    recon = tables.snapshot(spark, ledger_root, "gold_reconciliation")
    assert ledger_count(recon, status="MATCHED", search="f1").first()["total"] == 9  # F1, F10..F17
    assert ledger_count(recon, search="' OR 1=1 --").first()["total"] == 0
    assert ledger_page(recon, page=2, size=1).count() == 1
    assert ledger_page(recon, page=30, size=1).count() == 0
    with pytest.raises(ValueError):
        ledger_page(recon, size=101)
    with pytest.raises(ValueError):
        ledger_count(recon, search="x" * 201)
    funding = tables.snapshot(spark, ledger_root, "gold_funding")
    payouts = tables.snapshot(spark, ledger_root, "silver_payouts")
    rows = record_drilldown(funding, recon, payouts, "F1").collect()
    assert sorted(r["part"] for r in rows) == ["funding", "payouts", "reconciliation"]
    cut = record_drilldown(funding, recon, payouts, "F1", limits={"payouts": 0})
    assert cut.count() == 2
    seen, after = [], None
    while page := page_after(recon, after, size=7).collect():  # every row is reached, once
        seen += [r["record_id"] for r in page]
        after = page[-1]["cursor"]
    assert len(seen) == len(set(seen)) == recon.count() and seen == sorted(seen)
    with pytest.raises(ValueError):
        record_drilldown(funding, recon, payouts, "")


def test_fingerprint_matches_hashlib(spark, ledger_root):
    import hashlib

    path = os.path.join(ledger_root, "raw", "2026-10-01", "funding.csv")
    with open(path, "rb") as handle:
        expected = hashlib.sha256(handle.read()).hexdigest()
    row = fingerprints(spark, [path]).first()
    assert row["sha256"] == expected and row["key"] == "2026-10-01/funding"
    assert row["header"] == ",".join(FUNDING_FIELDS)


def test_malformed_row_fails_the_run(spark, ledger_root):
    day = "2026-10-01"
    published = run(spark, ledger_root, day, policy=QualityPolicy(max_quarantine_ratio=0.1))
    with open(os.path.join(ledger_root, "raw", day, "payouts.csv"), "a") as handle:
        handle.write("PX,F1,V1,2026-10-01,INR,1.00,,2026-10-01T02:00:00Z,EXTRA\n")
    with pytest.raises(ValueError, match="header"):
        run(spark, ledger_root, day, policy=QualityPolicy(max_quarantine_ratio=0.1))
    audit = tables.read_audit(spark, ledger_root)
    assert tables.current_run(audit).first()["run_id"] == published["run_id"]


def test_pair_rows_and_leftovers_of_a_failed_run(spark, tmp_path):
    from ledgerline.contracts import DATASETS

    root = str(tmp_path)
    day = "2026-10-01"
    funding = [funding_row(f"F{i}", day) for i in range(4)]
    payouts = [payout_row(f"P{i}", f"F{i}", day) for i in range(4)]
    payouts += [payout_row(f"C{i}", "F0", day, amount=a) for i, a in enumerate(["25.00", "-25.00", "25.00", "-25.00", "7.00"])]
    write_day(root, day, funding, payouts)
    policy = QualityPolicy(max_exception_ratio=1.0)

    done = run(spark, root, day, policy=policy)
    recon = tables.read_dataset(spark, root, "gold_reconciliation")
    first = recon.filter(F.col("record_id") == "F0").first()
    assert first.contra_pair_count == 2 and first.status == "AMOUNT_MISMATCH"
    pairs = tables.read_dataset(spark, root, "gold_contra_pairs").collect()
    assert done["output_counts"]["gold_contra_pairs"] == 2 and sorted(r.pair_rank for r in pairs) == [1, 2]

    # A failed gate leaves the run's written partitions without an audit row: orphans (A13),
    # found by the anti-join and removed by dropping the run's partition folders (D9).
    with pytest.raises(QualityFailure, match="min_funding_records"):
        run(spark, root, day, policy=QualityPolicy(max_exception_ratio=1.0, min_funding_records=100))
    failed = tables.read_alerts(spark, root).filter(F.col("category") == "QUALITY_GATE_FAILED")
    assert failed.count() == 1
    names = list(DATASETS)
    audit = tables.read_audit(spark, root)
    cutoff = "2999-01-01T00:00:00+00:00"

    def leftovers():
        present = {n: tables.read_dataset(spark, root, n) for n in names}
        return {r["table"]: r["rows"] for r in ops.orphan_rows(present, audit, cutoff).collect()}

    # Gates run on the written, unpublished stages, so every dataset of the failed run is left.
    before = leftovers()
    assert before == dict(
        silver_funding=4,
        silver_payouts=9,
        gold_funding=4,
        gold_reconciliation=4,
        gold_vendor_summary=2,
        gold_month_end=2,
        exceptions=1,
        quarantine=0,
        gold_contra_pairs=2,
    )
    present = {n: tables.read_dataset(spark, root, n) for n in names}
    failed = ops.orphan_runs(present, audit, cutoff)  # from the ledger's own rows, not from alerts
    targets = ops.drop_runs(spark, root, failed, names)  # preview: nothing removed
    assert len(targets) == len(names) and leftovers() == before
    ops.drop_runs(spark, root, failed, names, apply=True)
    assert set(leftovers().values()) == {0}
    # The published runs are untouched.
    assert tables.snapshot(spark, root, "gold_reconciliation").count() == 4
    assert recon.filter(F.col("run_id") == done["run_id"]).count() == 4
