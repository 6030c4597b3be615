"""Hot keys: one record with most payouts, one original referenced by hundreds of reversals.

Results are compared with a brute-force evaluation of the rules (rank every payout, pair the
n-th positive with the n-th negative), and the plan must pre-aggregate before every shuffle.
"""

import hashlib
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators.reconcile import contra_pairs, reconcile
from ledgerline.operators.versions import latest

EXPECTED = "record_id string, vendor_id string, currency string, event_date string, net_payable decimal(20,2)"
PAYOUTS = (
    "payout_id string, record_id string, vendor_id string, currency string, event_date string, "
    "amount string, reversal_of string"
)


def hot_payouts():
    rows = [(f"A{i:05d}", "10") for i in range(1000)]
    rows += [(f"B{i:05d}", "-10") for i in range(1200)]
    rows += [(f"C{i:05d}", "5") for i in range(300)]
    payouts = [(p, "H", "V", "INR", "2026-10-01", a, None) for p, a in rows]
    payouts += [(f"R{i:05d}", "H", "V", "INR", "2026-10-01", "-10", "A00000") for i in range(500)]
    payouts += [(f"Q{i}", f"K{i}", "V", "INR", "2026-10-01", "7", None) for i in range(50)]  # cold keys
    return payouts


def brute_force(payouts, keys=("H", "V", "INR")):
    """Reference rules evaluated row by row, for the hot record only."""
    mine = [p for p in payouts if p[1] == keys[0]]
    referenced = Counter(p[6] for p in payouts if p[6])
    invalid = 0
    for p in mine:
        if p[6]:
            original = next((q for q in payouts if q[0] == p[6]), None)
            ok = (
                original is not None
                and referenced[p[6]] == 1
                and not original[6]
                and Decimal(p[5]) == -Decimal(original[5])
                and Decimal(p[5]) != 0
            )
            invalid += not ok
    eligible = [p for p in mine if not p[6] and p[0] not in referenced and Decimal(p[5]) != 0]
    pair_ids = []
    for amount in sorted({abs(Decimal(p[5])) for p in eligible}):
        pos = sorted(p[0] for p in eligible if Decimal(p[5]) == amount)
        neg = sorted(p[0] for p in eligible if Decimal(p[5]) == -amount)
        for n in range(1, min(len(pos), len(neg)) + 1):
            text = f"{'|'.join(keys)}|{amount:.2f}|{n}"
            pair_ids.append(hashlib.sha256(text.encode()).hexdigest())
    paid = sum(Decimal(p[5]) for p in mine)
    return invalid, sorted(pair_ids), paid


def test_hot_record_and_hot_reversal_target(spark):
    payouts_rows = hot_payouts()
    payouts = spark.createDataFrame(payouts_rows, PAYOUTS).repartition(6)
    expected = spark.createDataFrame(
        [("H", "V", "INR", "2026-09-30", Decimal("0.00"))] + [(f"K{i}", "V", "INR", "2026-10-01", Decimal("7.00")) for i in range(50)],
        EXPECTED,
    )
    result = reconcile(expected, payouts, cross_date=True)
    hot = result.filter(F.col("record_id") == "H").first()
    invalid, pair_ids, paid = brute_force(payouts_rows)
    assert hot.invalid_reversal_count == invalid == 500
    assert hot.contra_pair_count == len(pair_ids) == 999
    assert hot.paid_amount == paid == Decimal("-5500.00")
    assert hot.payout_count == 3000 and hot.reversal_count == 500
    assert hot.status == "INVALID_REVERSAL"
    assert result.filter(F.col("status") == "MATCHED").count() == 50

    # The ranks cut into ranges of any length and spread over tasks: the same pairs.
    for size in (100, 10_000):
        pairs = contra_pairs(payouts, cross_date=True, pairs_per_row=size).filter(F.col("record_id") == "H")
        rows = pairs.collect()
        assert sorted(r.pair_rank for r in rows) == list(range(1, 1000))
        assert sorted(r.contra_pair_id for r in rows) == pair_ids
        if size == 100:
            assert pairs.rdd.glom().map(len).filter(lambda n: n > 0).count() > 1

    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan  # map-side combine before the shuffles
    assert "Window" not in plan  # no row ranking over a hot partition


def test_latest_with_one_hot_key(spark):
    rows = [(f"{i:06d}", "HOT", f"2026-10-01T{(i % 24):02d}:00:00Z") for i in range(4000)]
    rows += [(f"{i:06d}", f"K{i}", "2026-10-01T01:00:00Z") for i in range(2000)]
    df = spark.createDataFrame(rows, "payload string, record_id string, updated_at string").repartition(6)
    out = latest(df, "record_id", hash_columns=["payload", "record_id", "updated_at"])
    assert out.count() == 2001
    hot = out.filter(F.col("record_id") == "HOT").first()
    assert hot.updated_at == "2026-10-01T23:00:00Z"
    ties = [r for r in rows if r[1] == "HOT" and r[2] == "2026-10-01T23:00:00Z"]
    digests = {hashlib.sha256("|".join(r).encode()).hexdigest(): r for r in ties}
    assert hot.payload == digests[max(digests)][0]
    assert "partial_max" in out._jdf.queryExecution().executedPlan().toString()


def test_join_on_the_key_of_latest_needs_no_second_shuffle(spark):
    rows = [(f"{i % 3}", f"K{i % 40}", "2026-10-01T01:00:00Z") for i in range(200)]
    df = spark.createDataFrame(rows, "payload string, record_id string, updated_at string").repartition(6)
    columns = ["payload", "record_id", "updated_at"]
    picked = latest(df, "record_id", hash_columns=columns)
    assert picked.columns == columns and picked.count() == 40
    grouped = picked.groupBy("record_id").agg(F.count("payload").alias("n"))
    assert grouped.filter("n = 1").count() == 40
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
