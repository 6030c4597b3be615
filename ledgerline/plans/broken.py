"""Drops that break every rule of the contract, for the quarantine and gate queries.

The rules are fixed by the numbers in the rows' own ids: one field of a row is replaced. They only change text, so
every row stays in the drop it came in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule number, field, text. The oracle SQL states the same rules.
FUNDING_RULES = (
    (0, "record_id", ""),
    (1, "vendor_id", " "),
    (2, "order_id", ""),
    (3, "event_date", ""),
    (4, "updated_at", ""),
    (5, "currency", ""),
    (6, "currency", "USD"),
    (7, "event_date", "2020-02-30"),
    (8, "updated_at", "soon"),
    (9, "quantity", "2.5"),
    (10, "quantity", "-3"),
    (11, "unit_price", "-1"),
    (12, "logistics_per_unit", "x"),
    (13, "penalty", None),
    (14, "discount_rate", "1.5"),
    (15, "return_rate", "-0.1"),
    (16, "commission_rate", "0.1234567"),
    (17, "tax_rate", "x"),
    (18, "withholding_rate", None),
    (19, "marketing_rate", "2"),
    (20, "rebate_rate", ""),
    (21, "adjustment", "none"),
    (22, "unit_price", "1.005"),
    (23, "logistics_per_unit", "0.001"),
    (24, "penalty", "2000000000000"),
    (25, "adjustment", "0.005"),
)
PAYOUT_RULES = (
    (30, "payout_id", ""),
    (31, "record_id", " "),
    (32, "vendor_id", ""),
    (33, "event_date", ""),
    (34, "updated_at", ""),
    (35, "currency", ""),
    (36, "currency", "USD"),
    (37, "event_date", "2020-02-30"),
    (38, "updated_at", "soon"),
    (39, "amount", "none"),
    (40, "amount", "1.005"),
)
RULES_OF = 60  # a row's order number modulo this is its rule number
CORRECTED_OF = 7  # payouts of every seventh order have a second version


def _replaced(rows: DataFrame, number: Column, rules) -> DataFrame:
    changes: dict[str, Column] = {}
    for rule, field, text in rules:
        changes[field] = F.when(number == rule, F.lit(text).cast("string")).otherwise(changes.get(field, F.col(field)))
    return rows.withColumns(changes)


def broken_funding(funding: DataFrame) -> DataFrame:
    return _replaced(funding, F.substring("order_id", 2, 40).cast("bigint") % RULES_OF, FUNDING_RULES)


def broken_payouts(payouts: DataFrame) -> DataFrame:
    """Also adds corrected versions: an hour later, another amount."""
    order = F.regexp_extract("payout_id", r"F(\d+)-", 1).cast("bigint")
    corrected = payouts.filter(order % CORRECTED_OF == 0)
    corrected = corrected.withColumns({"updated_at": F.concat("event_date", F.lit("T03:00:00Z")), "amount": F.lit("1.00")})
    return _replaced(payouts.unionByName(corrected), order % RULES_OF, PAYOUT_RULES)
