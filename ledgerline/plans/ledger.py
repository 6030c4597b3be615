"""The as-of ledger (D7): raw drops -> silver -> gold -> reconciliation -> summaries.

``Ledger`` holds the lazy frames of one as-of ledger; the publishing job (``plans.staged``) writes
them stage by stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.contracts import FIELDS, FUNDING_FIELDS, KEY
from ledgerline.operators.measures import funding_measures
from ledgerline.operators.quality import quality_metrics
from ledgerline.operators.reconcile import exceptions
from ledgerline.operators.summaries import month_end_summary, vendor_summary
from ledgerline.operators.validation import ERRORS, picked, quarantine
from ledgerline.operators.versions import content_digest, latest

#: What a ledger needs of a record's latest funding: the reconciliation's expected side, and the payout drops.
DUE = ("record_id", "vendor_id", "order_id", "event_date", "currency", "net_payable")
#: What a reconciliation needs of a payout's latest version.
SETTLED = ("payout_id", "record_id", "vendor_id", "currency", "event_date", "amount", "reversal_of")
#: What the funding identity is checked by.
IDENTITY = ("eligible_sales", "total_deductions", "total_credits")


def silver(tagged: DataFrame, kind: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Latest valid version of each record: contract text columns + source_file, or the named ``columns``, which alone are
    shuffled then. Which version is the latest always depends on the whole row."""
    return latest(
        tagged,
        KEY[kind],
        hash_columns=FIELDS[kind],
        where=F.col(ERRORS) == "",
        columns=columns or [*FIELDS[kind], "source_file"],
    )


def due_funding(tagged: DataFrame, columns: tuple[str, ...] = DUE) -> DataFrame:
    """The named columns of gold_funding, from tagged funding. The measures are made before the latest rows are taken, so that
    only these columns are shuffled, sorted and spilled; rejected rows have no quantity there, and so no measures."""
    good = F.col(ERRORS) == ""
    hashed = tagged.withColumns({"_digest": content_digest(FUNDING_FIELDS), "quantity": F.when(good, F.col("quantity"))})
    made = funding_measures(hashed).select(*columns, "updated_at", "_digest", ERRORS)
    return latest(made, KEY["funding"], where=good, columns=columns, digest="_digest")


def rejected(tagged: DataFrame, kind: str) -> DataFrame:
    return quarantine(picked(tagged, False), kind)


def as_of(raw: DataFrame, as_of_date: str | None) -> DataFrame:
    """Keep drops whose partition date is on or before ``as_of_date`` (ISO text order)."""
    if as_of_date is None:
        return raw
    return raw.filter(F.col("batch_date") <= F.lit(as_of_date))


def drop_inventory(funding_raw: DataFrame, payouts_raw: DataFrame, as_of_date: str) -> DataFrame:
    """The as-of selection of daily drops (S1): per drop date on or before ``as_of_date``, the rows
    of each source and whether the day is complete (both sources present).

    One union and one ``groupBy(batch_date)`` with map-side combine; the date filter is pushed
    into both branches."""
    funding = funding_raw.select("batch_date", F.lit(1).alias("f"), F.lit(0).alias("p"))
    payouts = payouts_raw.select("batch_date", F.lit(0).alias("f"), F.lit(1).alias("p"))
    days = as_of(funding.unionByName(payouts), as_of_date).groupBy("batch_date").agg(
        F.sum("f").alias("funding_rows"), F.sum("p").alias("payout_rows")
    )
    return days.withColumn("complete", (F.col("funding_rows") > 0) & (F.col("payout_rows") > 0))


@dataclass
class Ledger:
    tagged: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    gold_funding: DataFrame
    reconciliation: DataFrame
    due: DataFrame  # gold_funding's columns DUE and IDENTITY if asked for
    settled: DataFrame  # silver_payouts' columns SETTLED
    cross_date: bool = True

    def datasets(self) -> dict[str, DataFrame]:
        return {
            "silver_funding": self.silver["funding"],
            "silver_payouts": self.silver["payouts"],
            "gold_funding": self.gold_funding,
            "gold_reconciliation": self.reconciliation,
            "gold_vendor_summary": vendor_summary(self.reconciliation),
            "gold_month_end": month_end_summary(self.reconciliation),
            "exceptions": exceptions(self.reconciliation),
            "quarantine": rejected(self.tagged["funding"], "funding").unionByName(
                rejected(self.tagged["payouts"], "payouts")
            ),
        }

    def metrics(self) -> DataFrame:
        return quality_metrics(self.tagged, self.silver)
