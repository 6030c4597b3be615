"""Quality metrics (A9) and publication gates (D8).

Metrics and gates are small DataFrames built from aggregates (one row per source / per gate), so
no per-partition ``count()`` action runs; ``enforce`` only collects the handful of gate rows.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.contracts import MAX_EXCEPTION_RATIO, MAX_QUARANTINE_RATIO, MIN_FUNDING_RECORDS
from ledgerline.operators.measures import identity_violated_sum, identity_violation_count
from ledgerline.operators.validation import ERRORS


class QualityFailure(RuntimeError):
    """At least one gate did not pass, so the run stays unpublished."""


@dataclass(frozen=True)
class QualityPolicy:
    """Limits of the publication gates."""

    max_quarantine_ratio: float = MAX_QUARANTINE_RATIO
    max_exception_ratio: float = MAX_EXCEPTION_RATIO
    min_funding_records: int = MIN_FUNDING_RECORDS

    def __post_init__(self):
        shares = {"max_quarantine_ratio": self.max_quarantine_ratio, "max_exception_ratio": self.max_exception_ratio}
        wrong = [f"{name}={value} (0 to 1)" for name, value in shares.items() if value < 0 or value > 1]
        if self.min_funding_records <= 0:
            wrong.append(f"min_funding_records={self.min_funding_records} (1 or more)")
        if wrong:
            raise ValueError("limits out of range: " + ", ".join(wrong))

    def as_dict(self) -> dict:
        return asdict(self)


def quality_metrics(tagged: dict[str, DataFrame], silver: dict[str, DataFrame]) -> DataFrame:
    """Per source: input, valid (latest versions), quarantined, duplicate_versions.

    ``tagged`` holds every raw row with ``quality_errors``; ``silver`` the latest valid rows.
    """
    parts = []
    for kind in tagged:
        good = F.col(ERRORS) == ""
        parts.append(
            tagged[kind].select(
                F.lit(kind).alias("source"),
                F.lit(1).alias("input"),
                F.when(good, 1).otherwise(0).alias("good"),
                F.when(good, 0).otherwise(1).alias("quarantined"),
                F.lit(0).alias("valid"),
            )
        )
        parts.append(
            silver[kind].select(
                F.lit(kind).alias("source"),
                F.lit(0).alias("input"),
                F.lit(0).alias("good"),
                F.lit(0).alias("quarantined"),
                F.lit(1).alias("valid"),
            )
        )
    sums = reduce(DataFrame.unionByName, parts).groupBy("source").agg(
        F.sum("input").alias("input"),
        F.sum("valid").alias("valid"),
        F.sum("quarantined").alias("quarantined"),
        F.sum("good").alias("good"),
    )
    return sums.select(
        "source",
        "input",
        "valid",
        "quarantined",
        (F.col("good") - F.col("valid")).alias("duplicate_versions"),
    )


def _gate(frame: DataFrame, name, observed, limit: float, passed) -> DataFrame:
    return frame.select(
        (name if not isinstance(name, str) else F.lit(name)).alias("gate"),
        observed.cast("double").alias("observed"),
        F.lit(float(limit)).alias("limit"),
        passed.alias("passed"),
    )


def quality_gates(
    metrics: DataFrame,
    gold_funding: DataFrame,
    reconciliation: DataFrame,
    policy: QualityPolicy | None = None,
) -> DataFrame:
    """Gate table (gate, observed, limit, passed), one row per check."""
    policy = policy or QualityPolicy()
    m = metrics
    conservation = F.col("input") - F.col("valid") - F.col("quarantined") - F.col("duplicate_versions")
    ratio = F.col("quarantined") / F.greatest(F.col("input"), F.lit(1))
    funding_valid = m.filter(F.col("source") == "funding").agg(F.coalesce(F.sum("valid"), F.lit(0)).alias("v"))
    broken = identity_violation_count(gold_funding).withColumnRenamed("violations", "n")
    totals = reconciliation.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("status") != "MATCHED", 1).otherwise(0)), F.lit(0)).alias("exceptions"),
    )
    exception_ratio = F.col("exceptions") / F.greatest(F.col("total"), F.lit(1))
    gates = [
        _gate(m, F.concat(F.col("source"), F.lit("_count_conservation")), conservation, 0, conservation == 0),
        _gate(
            m,
            F.concat(F.col("source"), F.lit("_quarantine_ratio")),
            ratio,
            policy.max_quarantine_ratio,
            ratio <= policy.max_quarantine_ratio,
        ),
        _gate(funding_valid, "min_funding_records", F.col("v"), policy.min_funding_records, F.col("v") >= policy.min_funding_records),
        _gate(broken, "funding_arithmetic_identity", F.col("n"), 0, F.col("n") == 0),
        _gate(totals, "exception_ratio", exception_ratio, policy.max_exception_ratio, exception_ratio <= policy.max_exception_ratio),
    ]
    return reduce(DataFrame.unionByName, gates)


def ledger_counts(
    tagged: dict[str, DataFrame], silver: dict[str, DataFrame], gold_funding: DataFrame | None = None, reconciliation: DataFrame | None = None
) -> DataFrame:
    """(name, n): every count that metrics, gates and output counts are made of, in one pass. Each frame is
    aggregated once; what it counts is told apart by conditions, and the sums are unpivoted in the end. Without the gold
    frames it has the counts of the metrics alone."""
    frames = {}
    for kind in tagged:
        good = F.col(ERRORS) == ""
        frames[f"{kind} raw"] = tagged[kind].agg(F.count(F.lit(1)).alias(f"{kind}.input"), F.count_if(good).alias(f"{kind}.good"))
        if kind != "funding" or gold_funding is None:  # the latest funding rows are those of gold_funding
            frames[f"{kind} silver"] = silver[kind].agg(F.count(F.lit(1)).alias(f"{kind}.valid"))
    if gold_funding is not None:
        frames["gold"] = gold_funding.agg(F.count(F.lit(1)).alias("funding.valid"), identity_violated_sum().alias("funding.broken"))
    if reconciliation is not None:
        by_vendor_day = reconciliation.groupBy("event_date", "vendor_id", "currency", "status").agg(F.count(F.lit(1)).alias("rows"))
        month = F.struct(F.date_format(F.col("event_date").try_cast("date"), "yyyy-MM"), "vendor_id", "currency", "status")
        frames["ledger"] = by_vendor_day.groupBy(month.alias("month")).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("days"), F.max("status").alias("status")).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("ledger.rows"),
            F.coalesce(F.sum(F.when(F.col("status") != "MATCHED", F.col("rows"))), F.lit(0)).alias("ledger.exceptions"),
            F.coalesce(F.sum("days"), F.lit(0)).alias("ledger.vendor_days"),
            F.count(F.lit(1)).alias("ledger.vendor_months"),
        )
    parts = [f.select(F.explode(F.create_map(*(x for c in f.columns for x in (F.lit(c), F.col(f"`{c}`").cast("bigint"))))).alias("name", "n")) for f in frames.values()]
    return reduce(DataFrame.unionByName, parts)


def _counted(counts: DataFrame) -> DataFrame:
    """The counts as one row of a map."""
    return counts.agg(F.map_from_entries(F.collect_list(F.struct("name", "n"))).alias("c"))


def _unpivoted(counts: DataFrame, rows: list) -> DataFrame:
    return _counted(counts).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def metrics_of(counts: DataFrame, kinds: tuple[str, ...] = ("funding", "payouts")) -> DataFrame:
    """Quality metrics (A9) from ``ledger_counts``."""
    n = lambda name: F.col("c")[name]
    rows = [
        F.struct(
            F.lit(k).alias("source"),
            n(f"{k}.input").alias("input"),
            n(f"{k}.valid").alias("valid"),
            (n(f"{k}.input") - n(f"{k}.good")).alias("quarantined"),
            (n(f"{k}.good") - n(f"{k}.valid")).alias("duplicate_versions"),
        )
        for k in kinds
    ]
    return _unpivoted(counts, rows)


def gates_of(counts: DataFrame, policy: QualityPolicy | None = None, kinds: tuple[str, ...] = ("funding", "payouts")) -> DataFrame:
    """The gate table (D8) from ``ledger_counts``."""
    policy = policy or QualityPolicy()
    n = lambda name: F.col("c")[name]
    checks = []
    for k in kinds:
        quarantined, duplicates = n(f"{k}.input") - n(f"{k}.good"), n(f"{k}.good") - n(f"{k}.valid")
        lost = n(f"{k}.input") - n(f"{k}.valid") - quarantined - duplicates
        ratio = quarantined / F.greatest(n(f"{k}.input"), F.lit(1))
        checks.append((f"{k}_count_conservation", lost, 0, lost == 0))
        checks.append((f"{k}_quarantine_ratio", ratio, policy.max_quarantine_ratio, ratio <= policy.max_quarantine_ratio))
    valid, broken = n("funding.valid"), n("funding.broken")
    ratio = n("ledger.exceptions") / F.greatest(n("ledger.rows"), F.lit(1))
    checks.append(("min_funding_records", valid, policy.min_funding_records, valid >= policy.min_funding_records))
    checks.append(("funding_arithmetic_identity", broken, 0, broken == 0))
    checks.append(("exception_ratio", ratio, policy.max_exception_ratio, ratio <= policy.max_exception_ratio))
    rows = [
        F.struct(F.lit(g).alias("gate"), o.cast("double").alias("observed"), F.lit(float(x)).alias("limit"), p.alias("passed")) for g, o, x, p in checks
    ]
    return _unpivoted(counts, rows)


def output_counts_of(counts: DataFrame) -> DataFrame:
    """Rows of every dataset (A10) from ``ledger_counts``."""
    n = lambda name: F.col("c")[name]
    thrown = sum((n(f"{k}.input") - n(f"{k}.good") for k in ("funding", "payouts")), F.lit(0))
    sizes = {
        "silver_funding": n("funding.valid"),
        "silver_payouts": n("payouts.valid"),
        "gold_funding": n("funding.valid"),
        "gold_reconciliation": n("ledger.rows"),
        "gold_vendor_summary": n("ledger.vendor_days"),
        "gold_month_end": n("ledger.vendor_months"),
        "exceptions": n("ledger.exceptions"),
        "quarantine": thrown,
    }
    return _unpivoted(counts, [F.struct(F.lit(name).alias("dataset"), size.cast("bigint").alias("rows")) for name, size in sizes.items()])


def enforce(gates: DataFrame) -> dict:
    """Raise ``QualityFailure`` if any gate failed; otherwise return the observed values."""
    rows = gates.collect()  # one row per gate: a fixed, small number
    observed = {r["gate"]: r["observed"] for r in rows}
    failed = [r for r in rows if not r["passed"]]
    if failed:
        described = "; ".join(f"{r['gate']} {r['observed']:.4f} exceeds {r['limit']}" for r in failed)
        if any(r["gate"].endswith("_quarantine_ratio") for r in failed):
            described = "quarantine ratio: " + described
        raise QualityFailure(described)
    return {"checks": "PASSED", "observed": observed, "exception_ratio": observed.get("exception_ratio", 0.0)}


def gate_alerts(gates: DataFrame, metrics: DataFrame) -> DataFrame:
    """Alert rows implied by a gate table: ERROR per failed gate; one WARNING when anything was
    quarantined or the exception ratio is above zero (S9)."""
    errors = gates.filter(~F.col("passed")).select(
        F.lit("ERROR").alias("severity"),
        F.lit("QUALITY_GATE_FAILED").alias("category"),
        F.col("gate").alias("subject"),
        F.col("observed"),
    )
    signals = (
        metrics.select(F.col("quarantined").cast("bigint").alias("q"), F.lit(0.0).alias("r"))
        .unionByName(
            gates.filter(F.col("gate") == "exception_ratio").select(F.lit(0).cast("bigint").alias("q"), F.col("observed").alias("r"))
        )
        .agg(F.coalesce(F.sum("q"), F.lit(0)).alias("q"), F.coalesce(F.max("r"), F.lit(0.0)).alias("r"))
    )
    warning = (
        signals.filter((F.col("q") > 0) | (F.col("r") > 0))
        .select(
            F.lit("WARNING").alias("severity"),
            F.lit("QUALITY_EXCEPTIONS").alias("category"),
            F.lit("quality").alias("subject"),
            F.col("r").alias("observed"),
        )
    )
    return errors.unionByName(warning)
