"""Raw funding and payout drops derived from the driver's `lineitem` table.

The ledger consumes daily text drops (see ``csv_drops``). The test tables have no such drops, so
this adapter derives them with plain projections: each lineitem becomes a funding record version
dropped on its ship date, and payouts are derived from the latest gold funding with one scenario
per record (missing, mismatch, reversal, contra, split, late, double reversal, orphan). Bad rows
are injected by rule so that quarantine is exercised. Everything is a narrow projection or an
``explode``; no shuffle is added here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contracts import FUNDING_FIELDS, MONEY, PAYOUT_FIELDS, RATE

# ---------------------------------------------------------------------------
# Fixed values of the adapter (scenario rules; the oracle SQL uses the same ones)
# ---------------------------------------------------------------------------
BAD_QUANTITY_PARTKEY_MOD = 97  # quantity -1 -> invalid_quantity / invalid_integer_quantity
ADJUSTMENT_PARTKEY_MOD = 13  # adjustment -2.50
BAD_CURRENCY_ORDERKEY_MOD = 89  # payouts in 'USD' -> unsupported_currency
SCENARIO_MOD = 20  # scenario k = (l_orderkey * 7 + l_linenumber) % 20
ORPHAN_ORDERKEY_MOD = 5  # k = 7 and l_orderkey % 5 = 0 adds an orphan payout
FUNDING_TIME = "T01:00:00Z"
PAYOUT_TIME = "T02:00:00Z"
MISMATCH_EXTRA = "3"
# ---------------------------------------------------------------------------


def _text(c: Column) -> Column:
    return c.cast("string")


def funding_drops(lineitem: DataFrame) -> DataFrame:
    """Raw funding text rows + ``batch_date`` and ``source_file`` (one drop per ship date)."""
    day = F.date_format(F.col("l_shipdate"), "yyyy-MM-dd")
    partkey = F.col("l_partkey")
    columns = {
        "record_id": F.concat(F.lit("F"), _text(F.col("l_orderkey")), F.lit("-"), _text(F.col("l_linenumber"))),
        "vendor_id": F.concat(F.lit("V"), F.lpad(_text(F.col("l_suppkey")), 6, "0")),
        "order_id": F.concat(F.lit("O"), _text(F.col("l_orderkey"))),
        "event_date": day,
        "updated_at": F.concat(day, F.lit(FUNDING_TIME)),
        "currency": F.lit("INR"),
        "quantity": F.when(partkey % BAD_QUANTITY_PARTKEY_MOD == 0, F.lit("-1")).otherwise(
            _text(F.col("l_quantity").cast("int"))
        ),
        "unit_price": _text(F.col("l_extendedprice").cast(MONEY)),
        "discount_rate": _text(F.col("l_discount").cast(RATE)),
        "return_rate": F.when(F.col("l_returnflag") == "R", F.lit("0.05")).otherwise(F.lit("0")),
        "commission_rate": F.lit("0.12"),
        "tax_rate": _text(F.col("l_tax").cast(RATE)),
        "withholding_rate": F.lit("0.01"),
        "logistics_per_unit": F.lit("15"),
        "marketing_rate": F.lit("0.02"),
        "rebate_rate": F.lit("0.03"),
        "penalty": F.when(F.col("l_linestatus") == "F", F.lit("5")).otherwise(F.lit("0")),
        "adjustment": F.when(partkey % ADJUSTMENT_PARTKEY_MOD == 0, F.lit("-2.50")).otherwise(F.lit("0")),
    }
    return lineitem.select(
        *[columns[name].alias(name) for name in FUNDING_FIELDS],
        day.alias("batch_date"),
        F.concat(F.lit("raw/"), day, F.lit("/funding.csv")).alias("source_file"),
    )


def payout_drops(gold_funding: DataFrame) -> DataFrame:
    """Raw payout text rows + ``batch_date`` and ``source_file``, derived from gold funding."""
    rid = F.col("record_id")
    orderkey = F.substring(F.col("order_id"), 2, 40).cast("bigint")
    linenumber = F.substring_index(rid, "-", -1).cast("bigint")
    k = (orderkey * 7 + linenumber) % SCENARIO_MOD
    day = F.col("event_date")
    next_day = F.date_format(F.date_add(day.try_cast("date"), 1), "yyyy-MM-dd")
    amount = F.col("net_payable")
    half = F.round(amount * F.lit(0.5).cast("decimal(2,1)"), 2).cast(MONEY)

    def payout(prefix: str, value: Column, when_day: Column, reversal: Column | None = None, record: Column | None = None):
        return F.struct(
            F.concat(F.lit(prefix), rid).alias("payout_id"),
            (record if record is not None else rid).alias("record_id"),
            _text(value.cast(MONEY)).alias("amount"),
            when_day.alias("event_date"),
            (reversal if reversal is not None else F.lit(None).cast("string")).alias("reversal_of"),
        )

    p = payout("P", amount, day)
    scenarios = (
        F.when(k == 0, F.array())
        .when(k == 1, F.array(payout("P", amount + F.lit(MISMATCH_EXTRA).cast(MONEY), day)))
        .when(k == 2, F.array(p, payout("R", -amount, next_day, F.concat(F.lit("P"), rid))))
        .when(k == 3, F.array(p, payout("R", -amount, next_day)))
        .when(k == 4, F.array(payout("P", half, day), payout("S", amount - half, day)))
        .when(k == 5, F.array(payout("P", amount, next_day)))
        .when(
            k == 6,
            F.array(
                p,
                payout("R", -amount, day, F.concat(F.lit("P"), rid)),
                payout("X", -amount, day, F.concat(F.lit("P"), rid)),
            ),
        )
        .when(
            (k == 7) & (orderkey % ORPHAN_ORDERKEY_MOD == 0),
            F.array(p, payout("O", amount, day, record=F.concat(F.lit("UNKNOWN-"), rid))),
        )
        .otherwise(F.array(p))
    )
    currency = F.when(orderkey % BAD_CURRENCY_ORDERKEY_MOD == 0, F.lit("USD")).otherwise(F.col("currency"))
    # A column of its own: a generator that is too large for one compiled method would interpret the expression row by row.
    made = gold_funding.select("vendor_id", currency.alias("currency"), scenarios.alias("payouts"))
    exploded = made.select("vendor_id", "currency", F.explode("payouts").alias("p"))
    columns = {
        "payout_id": F.col("p.payout_id"),
        "record_id": F.col("p.record_id"),
        "vendor_id": F.col("vendor_id"),
        "event_date": F.col("p.event_date"),
        "currency": F.col("currency"),
        "amount": F.col("p.amount"),
        "reversal_of": F.col("p.reversal_of"),
        "updated_at": F.concat(F.col("p.event_date"), F.lit(PAYOUT_TIME)),
    }
    return exploded.select(
        *[columns[name].alias(name) for name in PAYOUT_FIELDS],
        F.col("p.event_date").alias("batch_date"),
        F.concat(F.lit("raw/"), F.col("p.event_date"), F.lit("/payouts.csv")).alias("source_file"),
    )
