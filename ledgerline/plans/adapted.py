"""The ledger over the driver's tables: lineitem -> funding drops -> gold -> payout drops -> ledger.

Payout drops are derived from the *latest* gold funding, so the funding half of the plan is
built once and feeds both the payout adapter and the expected side of the reconciliation;
Spark reuses the shared exchange (``ReusedExchange``) instead of recomputing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.measures import funding_measures
from ledgerline.operators.reconcile import reconcile
from ledgerline.operators.validation import tag
from ledgerline.plans.ledger import DUE, SETTLED, Ledger, as_of, due_funding, silver
from ledgerline.sources.adapter import funding_drops, payout_drops

LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)


def raw_funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funding_drops(lineitem(spark, sf_dir))


def gold_from_raw(funding_raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    tagged = tag(funding_raw, "funding")
    silver_funding = silver(tagged, "funding")
    return tagged, silver_funding, funding_measures(silver_funding)


def due_from_raw(funding_raw: DataFrame) -> DataFrame:
    """The latest funding's columns that payouts and the reconciliation are made from."""
    return due_funding(tag(funding_raw, "funding"))


def adapted_ledger(
    spark: SparkSession, sf_dir: str, as_of_date: str | None = None, cross_date: bool = True, columns: tuple[str, ...] = DUE
) -> Ledger:
    """The full ledger over ``lineitem``-derived drops (as of ``as_of_date`` if given). ``columns`` are those of ``due``."""
    tagged_f, silver_f, gold = gold_from_raw(as_of(raw_funding(spark, sf_dir), as_of_date))
    due = due_funding(tagged_f, columns)
    tagged_p = tag(as_of(payout_drops(due), as_of_date), "payouts")
    settled = silver(tagged_p, "payouts", SETTLED)
    return Ledger(
        {"funding": tagged_f, "payouts": tagged_p},
        {"funding": silver_f, "payouts": silver(tagged_p, "payouts")},
        gold,
        reconcile(due, settled, cross_date=cross_date),
        due,
        settled,
        cross_date,
    )
