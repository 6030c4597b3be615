"""Claims and commits, runs that read only new days, replay verification, hash trees."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_pipeline import funding_row, payout_row, write_day

from ledgerline.contracts import DATASETS, FIELDS, FUNDING_FIELDS
from ledgerline.functions.digests import as_text, limb_sums, limbs, row_digest
from ledgerline.operators import operations as ops
from ledgerline.operators.quality import QualityPolicy
from ledgerline.operators.validation import ERRORS, tag
from ledgerline.operators.versions import latest, merged
from ledgerline.plans.publish import run
from ledgerline.plans.staged import publish_staged
from ledgerline.sources import commits, csv_drops, tables
from ledgerline.sources import fingerprints as prints

ANY = QualityPolicy(max_quarantine_ratio=1.0, max_exception_ratio=1.0)


def days(root, names, late=()):
    for n, day in enumerate(names):
        funding = [funding_row(f"F{day}{i}", day) for i in range(3)] + [funding_row("BAD", day, quantity="x")]
        funding += [funding_row("SAME", day, unit_price=str(100 + n), updated_at=f"2026-12-{10 - n if day in late else 20 + n}T00:00:00Z")]
        write_day(root, day, funding, [payout_row(f"P{day}{i}", f"F{day}{i}", day) for i in range(2)])


def test_a_run_id_is_used_once(spark, tmp_path):
    root, day = str(tmp_path), "2026-10-01"
    days(root, [day])
    raw = {kind: csv_drops.read_drops(spark, [f"{root}/raw/{day}/{kind}.csv"], kind) for kind in FIELDS}
    publish_staged(spark, raw["funding"], raw["payouts"], root, day, ANY, run_id="one")
    before = {name: tables.read_dataset(spark, root, name).count() for name in DATASETS}
    with pytest.raises(commits.CommitConflict, match="used before"):
        publish_staged(spark, raw["funding"], raw["payouts"], root, day, ANY, run_id="one")
    assert {name: tables.read_dataset(spark, root, name).count() for name in DATASETS} == before
    assert tables.read_audit(spark, root).count() == 1


def test_the_slower_of_two_writers_is_refused(spark, tmp_path):
    root, day = str(tmp_path), "2026-10-01"
    days(root, [day])
    raw = {kind: csv_drops.read_drops(spark, [f"{root}/raw/{day}/{kind}.csv"], kind) for kind in FIELDS}
    other = lambda: commits.commit(spark, root, "other", 0) and False  # noqa: E731  (commits while this run is at work)
    with pytest.raises(commits.CommitConflict, match="another run took commit 1"):
        publish_staged(spark, raw["funding"], raw["payouts"], root, day, ANY, fingerprint_check=other)
    assert tables.read_audit(spark, root).count() == 0 and commits.last_commit(spark, root) == 1
    publish_staged(spark, raw["funding"], raw["payouts"], root, day, ANY)
    assert commits.last_commit(spark, root) == 2


def test_an_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="csv"):
        tables.write_dataset(spark.range(1), str(tmp_path), "gold_funding", "csv")


def content(spark, root, manifest):
    found = {}
    for name in DATASETS:
        rows = tables.read_run(spark, root, name, manifest["run_id"], manifest["batch_date"])
        found[name] = sorted(map(str, rows.drop("written_at").collect()))
    return found


def test_a_later_day_is_added_to_the_published_run(spark, tmp_path):
    names = ["2026-10-01", "2026-10-02", "2026-10-03"]
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    for root in (step, whole):
        days(root, names, late=names[2:])
    read = [run(spark, step, day, ANY) for day in names]
    assert [m["days_read"] for m in read] == [[d] for d in names]
    full = run(spark, whole, names[2], ANY)
    assert full["days_read"] == names
    for kind in ("quality", "output_counts", "reconciliation"):
        assert read[2][kind] == full[kind]
    strip = lambda texts: [t.replace(step, "").replace(whole, "") for t in texts]
    a, b = content(spark, step, read[2]), content(spark, whole, full)
    assert {k: strip(v) for k, v in a.items()} == {k: strip(v) for k, v in b.items()}
    # what both runs recorded is the same, but for the run itself
    audits = [tables.read_audit(spark, r).filter(F.col("run_id") == m["run_id"]) for r, m in ((step, read[2]), (whole, full))]
    both = audits[0].unionByName(audits[1])
    assert ops.replay_differences(both, read[2]["run_id"], full["run_id"]).count() == 0


def test_a_changed_old_day_is_read_again(spark, tmp_path):
    root, names = str(tmp_path), ["2026-10-01", "2026-10-02"]
    days(root, names)
    run(spark, root, names[0], ANY)
    with open(os.path.join(root, "raw", names[0], "funding.csv"), "a") as handle:
        handle.write(",".join(funding_row("NEW", names[0])[c] for c in FUNDING_FIELDS) + "\n")
    again = run(spark, root, names[1], ANY)
    assert again["days_read"] == names and again["quality"]["funding"]["input"] == 11


def test_unchanged_files_keep_their_hash(spark, tmp_path, monkeypatch):
    root, names = str(tmp_path), ["2026-10-01", "2026-10-02"]
    days(root, names)
    first = run(spark, root, names[0], ANY)
    read = []
    plain = prints.fingerprints
    monkeypatch.setattr(prints, "fingerprints", lambda spark, paths: read.extend(paths) or plain(spark, paths))
    second = run(spark, root, names[1], ANY)
    assert len(read) == 2 and all(names[1] in path for path in read)
    assert first["inputs"].items() <= second["inputs"].items()


def test_replay_differences_of_each_kind(spark):
    document = {
        "inputs": {"d/funding": "a"}, "content": {"d/funding": "1:2"}, "metrics": {"funding": {"input": 1}, "payouts": {"input": 2}}, "output_counts": {"exceptions": 3},
        "reconciliation": {"MATCHED": 4}, "totals": {"paid": "5.00"}, "checksums": {"exceptions": "3:1.2.3.4"},
    }
    other = json.loads(json.dumps(document))
    other["inputs"]["d/funding"], other["content"]["d/funding"], other["metrics"]["funding"]["input"] = "b", "1:3", 9
    other["output_counts"], other["reconciliation"], other["totals"]["paid"] = {}, {"MATCHED": 3, "CONTRA": 1}, "5.01"
    rows = [(name, "2026-10-01", "SUCCEEDED", "", "", json.dumps(d)) for name, d in (("a", document), ("b", other), ("c", document))]
    rows.append(("d", "2026-10-01", "SUCCEEDED", "", "", "no document"))
    audit = spark.createDataFrame(rows, tables.AUDIT_SCHEMA)
    found = {(r["section"], r["name"]): (r["first"], r["second"]) for r in ops.replay_differences(audit, "a", "b").collect()}
    assert found == {
        ("inputs", "d/funding"): ("a", "b"), ("content", "d/funding"): ("1:2", "1:3"), ("metrics_funding", "input"): ("1", "9"),
        ("output_counts", "exceptions"): ("3", None), ("reconciliation", "MATCHED"): ("4", "3"), ("reconciliation", "CONTRA"): (None, "1"), ("totals", "paid"): ("5.00", "5.01"),
    }
    assert ops.replay_differences(audit, "a", "c").count() == 0
    assert ops.replay_differences(audit, "a", "d").count() == 8


def test_a_merged_snapshot_equals_the_rebuilt_one(spark):
    rnd = random.Random(7)
    rows = [(f"F{rnd.randrange(30)}", f"2026-10-{rnd.randrange(1, 6):02d}T00:00:00Z", str(rnd.randrange(5)), rnd.randrange(4)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "record_id string, updated_at string, amount string, day int")
    columns = ("record_id", "updated_at", "amount")
    snapshot = latest(frame.filter("day = 2"), "record_id", columns, columns=columns)
    for day in (0, 3, 1):  # late days too
        snapshot = merged(snapshot, latest(frame.filter(F.col("day") == day), "record_id", columns, columns=columns), "record_id", columns)
    whole = latest(frame, "record_id", columns, columns=columns)
    assert sorted(map(tuple, snapshot.collect())) == sorted(map(tuple, whole.collect()))


def test_multiset_digests_add_up(spark):
    frame = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("", "a"), ("1:a", "-")], "x string, y string")
    assert frame.select(row_digest(["x", "y"])).distinct().count() == 4
    hashed = frame.select("y", *limbs(row_digest(["x", "y"])))
    whole = hashed.agg(*limb_sums()).select(as_text()).first()[0]
    parts = hashed.groupBy("y").agg(*limb_sums()).agg(*limb_sums()).select(as_text()).first()[0]
    turned = hashed.repartition(3).agg(*limb_sums()).select(as_text()).first()[0]
    assert whole == parts == turned != hashed.distinct().agg(*limb_sums()).select(as_text()).first()[0]


def test_changed_rows_from_the_days_down(spark):
    cells = [dict(funding_row(f"F{i}", f"2026-10-0{1 + i % 3}"), batch_date=f"2026-10-0{1 + i % 3}") for i in range(60)]
    make = lambda rows: spark.createDataFrame([tuple(r[c] for c in (*FUNDING_FIELDS, "batch_date")) for r in rows], ", ".join(f"{c} string" for c in (*FUNDING_FIELDS, "batch_date")))
    changed = [dict(c) for c in cells if c["record_id"] != "F4"] + [dict(cells[0])]  # one gone, one doubled
    changed[7]["penalty"] = "6"
    before, after = make(cells), make(changed)
    trees = [prints.hash_tree(x, "funding") for x in (before, after)]
    assert {r["batch_date"] for r in prints.changed_days(*trees).collect()} == {c["batch_date"] for c in (cells[4], cells[0], changed[7])}
    rows = prints.changed_rows(before, after, prints.changed_buckets(*trees), "funding").collect()
    assert sorted((r["key"], r["change"], r["copies"]) for r in rows) == sorted(
        [("F4", "removed", 1), ("F0", "added", 1), (changed[7]["record_id"], "added", 1), (changed[7]["record_id"], "removed", 1)]
    )
    assert prints.changed_buckets(trees[0], trees[0]).count() == 0
    assert tag(before, "funding").filter(F.col(ERRORS) != "").count() == 0
