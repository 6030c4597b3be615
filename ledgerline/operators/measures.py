"""Funding measures (D2): 35 decimal measures from a validated funding row.

Inputs are typed first (rates decimal(12,6), money decimal(20,2), quantity int); each measure is
then rounded HALF_UP to cents, and later measures use the rounded earlier ones. Rows of usual size
(``WITHIN``) are computed in whole cents as 64-bit integers, which fit there; all other rows, and rows
with a null, by the decimal formulas, which make one struct that is null in the rows of usual size. So a
row passes through two projections, whatever the depth of the formulas.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.contracts import FUNDING_MONEY_FIELDS, POLICY_VERSION, RATE_FIELDS
from ledgerline.functions.casts import int_quantity, money, rate
from ledgerline.functions.money import (
    amount_sql,
    per_unit_sql,
    percent_sql,
    round_money_sql,
    whole_per_unit_sql,
    whole_percent_sql,
)

# ---------------------------------------------------------------------------
# The accounting policy (measure name, formula over the typed inputs and the
# measures before it). Order matters: a formula may only use measures listed above it. ``per_unit`` is an amount
# for one piece, ``percent`` a share of an amount.
# ---------------------------------------------------------------------------
MEASURES = (
    ("gross_sales", "unit_price * quantity"),
    ("discount_amount", "gross_sales * discount_rate"),
    ("net_sales", "gross_sales - discount_amount"),
    ("return_amount", "net_sales * return_rate"),
    ("eligible_sales", "net_sales - return_amount"),
    ("commission_amount", "eligible_sales * commission_rate"),
    ("commission_tax", "commission_amount * tax_rate"),
    ("withholding_amount", "eligible_sales * withholding_rate"),
    ("logistics_fee", "quantity * logistics_per_unit"),
    ("marketing_fee", "eligible_sales * marketing_rate"),
    ("rebate_amount", "eligible_sales * rebate_rate"),
    ("penalty_amount", "penalty"),
    ("adjustment_amount", "adjustment"),
    (
        "net_payable",
        "eligible_sales - commission_amount - commission_tax - withholding_amount - logistics_fee"
        " - marketing_fee + rebate_amount - penalty_amount + adjustment_amount",
    ),
    (
        "total_deductions",
        "commission_amount + commission_tax + withholding_amount + logistics_fee + marketing_fee + penalty_amount",
    ),
    ("total_credits", "rebate_amount + adjustment_amount"),
    ("revenue_per_unit", "per_unit(gross_sales)"),
    ("discount_per_unit", "per_unit(discount_amount)"),
    ("eligible_per_unit", "per_unit(eligible_sales)"),
    ("commission_per_unit", "per_unit(commission_amount)"),
    ("tax_per_unit", "per_unit(commission_tax)"),
    ("withholding_per_unit", "per_unit(withholding_amount)"),
    ("payable_per_unit", "per_unit(net_payable)"),
    ("discount_pct", "percent(discount_amount, gross_sales)"),
    ("returns_pct", "percent(return_amount, net_sales)"),
    ("commission_pct", "percent(commission_amount, eligible_sales)"),
    ("tax_pct", "percent(commission_tax, commission_amount)"),
    ("withholding_pct", "percent(withholding_amount, eligible_sales)"),
    ("funding_margin", "eligible_sales - commission_amount - marketing_fee + rebate_amount"),
    ("pre_tax_payable", "net_payable + commission_tax + withholding_amount"),
    ("pre_adjustment_payable", "net_payable - adjustment_amount"),
    ("cash_deductions", "commission_tax + withholding_amount"),
    ("commercial_deductions", "commission_amount + logistics_fee + marketing_fee + penalty_amount"),
    ("funded_revenue", "eligible_sales + rebate_amount"),
    ("effective_deduction_pct", "percent((eligible_sales - net_payable), eligible_sales)"),
)
# ---------------------------------------------------------------------------

MEASURE_NAMES = tuple(name for name, _ in MEASURES)

#: Rows whose every product below fits into 64 bits: amounts up to 10^12 cents, times 10^6 for a rate or 20,000 for a share.
_MOST = "10000000000.00"
WITHIN = " and ".join(
    (
        "quantity between 1 and 100000",
        "unit_price between 0 and 1000000000.00",
        "logistics_per_unit between 0 and 1000000000.00",
        f"penalty between 0 and {_MOST}",
        f"adjustment between -{_MOST} and {_MOST}",
        *(f"{name} between 0 and 1" for name in RATE_FIELDS),
        f"unit_price * quantity <= {_MOST}",
        f"logistics_per_unit * quantity <= {_MOST}",
    )
)


def _whole(name: str) -> str:
    return f"_{name}__whole"


def _quotient(formula: str) -> tuple[str, list[str]] | None:
    found = re.fullmatch(r"(per_unit|percent)\((.*)\)", formula)
    return (found[1], found[2].split(", ")) if found else None


def decimal_formula(formula: str) -> str:
    quotient = _quotient(formula)
    return {"per_unit": per_unit_sql, "percent": percent_sql}[quotient[0]](*quotient[1]) if quotient else formula


def whole_formula(formula: str) -> str:
    """The formula over whole cents, whole quantities and millionths, in cents."""
    quotient = _quotient(formula)
    if quotient:
        formula = {"per_unit": whole_per_unit_sql, "percent": whole_percent_sql}[quotient[0]](*quotient[1])
    elif formula.split()[-1] in RATE_FIELDS:
        formula = f"({formula} + 500000L) div 1000000L"  # amounts that rates are taken of are not negative
    names = {*FUNDING_MONEY_FIELDS, *RATE_FIELDS, "quantity", *MEASURE_NAMES}
    return re.sub(r"\b[a-z_]+\b", lambda m: _whole(m[0]) if m[0] in names else m[0], formula)


def typed_funding(df: DataFrame) -> DataFrame:
    """Cast the validated text columns to their gold types, keeping column order."""
    typed = {name: rate(name) for name in RATE_FIELDS}
    typed.update({name: money(name) for name in FUNDING_MONEY_FIELDS})
    typed["quantity"] = int_quantity("quantity")
    return df.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns])


def _inputs(formula: str) -> list[str]:
    return [name for name in re.findall(r"\b[a-z_]+\b", formula) if name in MEASURE_NAMES]


#: Measures that other formulas use.
_USED = {name for _, formula in MEASURES for name in _inputs(formula)}


def _whole_inlined() -> dict[str, str]:
    """The whole formulas of the used measures over the inputs alone, so that one projection makes them all: its common
    parts are computed once, and no row is copied from measure to measure."""
    made: dict[str, str] = {}
    for name, formula in MEASURES:
        if name in _USED:
            made[name] = re.sub(r"\b_([a-z_]+)__whole\b", lambda m: f"({made[m[1]]})" if m[1] in made else m[0], whole_formula(formula))
    return made


def _decimals() -> str:
    """A struct of the money inputs and all measures by the decimal formulas, one array element's step for each level of
    formulas. Lambdas are interpreted, but only rows that are not ``_within`` come here."""
    fields = ["quantity", *FUNDING_MONEY_FIELDS, *RATE_FIELDS]
    struct, rest = "named_struct(" + ", ".join(f"'{c}', `{c}`" for c in fields) + ")", list(MEASURES)
    while rest:
        level = [(name, formula) for name, formula in rest if all(c in fields for c in _inputs(formula))]
        known = re.compile(r"\b(" + "|".join(fields) + r")\b")
        new = [f"'{name}', {round_money_sql(known.sub(r'x.\1', decimal_formula(formula)))}" for name, formula in level]
        struct = f"transform(array({struct}), x -> named_struct({', '.join([f"'{c}', x.{c}" for c in fields] + new)}))[0]"
        fields += [name for name, _ in level]
        rest = [pair for pair in rest if pair not in level]
    return struct


def funding_measures(df: DataFrame) -> DataFrame:
    """gold_funding: typed contract columns (+ any extra columns), 35 measures, policy_version."""
    typed = typed_funding(df).withColumn("_within", F.expr(f"coalesce({WITHIN}, false)"))
    inputs = {name: f"cast({name} * 100 as bigint)" for name in FUNDING_MONEY_FIELDS}
    inputs |= {name: f"cast({name} * 1000000 as bigint)" for name in RATE_FIELDS} | {"quantity": "cast(quantity as bigint)"}
    kept = [f"`{c}`" for c in df.columns if c not in FUNDING_MONEY_FIELDS]
    wide = f"if(_within, null, {_decimals()}) as _wide"
    halves = typed.selectExpr(*kept, wide, *[f"if(_within, {value}, null) as {_whole(name)}" for name, value in inputs.items()])
    made = halves.selectExpr("*", *[f"{formula} as {_whole(name)}" for name, formula in _whole_inlined().items()])
    cents = {name: _whole(name) for name in (*FUNDING_MONEY_FIELDS, *_USED)}
    cents = {name: f"({whole_formula(formula)})" for name, formula in MEASURES} | cents
    amounts = {name: f"coalesce({amount_sql(value)}, _wide.{name}) as {name}" for name, value in cents.items()}
    out = [amounts.get(c, f"`{c}`") for c in (*df.columns, *MEASURE_NAMES)]
    return made.selectExpr(*out).withColumn("policy_version", F.lit(POLICY_VERSION))


def identity_broken():
    """True when net_payable is NULL or differs from eligible_sales - total_deductions + total_credits."""
    return F.coalesce(
        F.col("net_payable") != F.col("eligible_sales") - F.col("total_deductions") + F.col("total_credits"),
        F.lit(True),
    )


def identity_violated_sum():
    """Aggregate: rows breaking the funding identity.

    A conditional sum rather than ``filter().count()``: a filter would be pushed down through the
    staged measure projections and inline the whole formula chain into one huge predicate.
    """
    return F.coalesce(F.sum(F.when(identity_broken(), 1).otherwise(0)), F.lit(0))


def identity_violation_count(gold: DataFrame) -> DataFrame:
    """One row: number of rows breaking the funding identity."""
    return gold.agg(identity_violated_sum().alias("violations"))
