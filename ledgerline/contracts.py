"""Ledger contract: column names and order, types, policy constants.

Everything in the block below is a fixed value of the funding/payout contract.
Results only agree with the original ledger when these are unchanged.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (contract; must not be reordered or renamed)
# ---------------------------------------------------------------------------
FUNDING_FIELDS = (
    "record_id",
    "vendor_id",
    "order_id",
    "event_date",
    "updated_at",
    "currency",
    "quantity",
    "unit_price",
    "discount_rate",
    "return_rate",
    "commission_rate",
    "tax_rate",
    "withholding_rate",
    "logistics_per_unit",
    "marketing_rate",
    "rebate_rate",
    "penalty",
    "adjustment",
)
PAYOUT_FIELDS = (
    "payout_id",
    "record_id",
    "vendor_id",
    "event_date",
    "currency",
    "amount",
    "reversal_of",
    "updated_at",
)
FUNDING_REQUIRED = ("record_id", "vendor_id", "order_id", "event_date", "updated_at", "currency")
PAYOUT_REQUIRED = ("payout_id", "record_id", "vendor_id", "event_date", "updated_at", "currency")
# Non-negative amounts checked in this order; quantity has minimum 1, the others 0.
FUNDING_NON_NEGATIVE = ("quantity", "unit_price", "logistics_per_unit", "penalty")
RATE_FIELDS = (
    "discount_rate",
    "return_rate",
    "commission_rate",
    "tax_rate",
    "withholding_rate",
    "marketing_rate",
    "rebate_rate",
)
FUNDING_MONEY_FIELDS = ("unit_price", "logistics_per_unit", "penalty", "adjustment")
PAYOUT_MONEY_FIELDS = ("amount",)
CURRENCY = "INR"
POLICY_VERSION = "synthetic-v1"
MONEY = "decimal(20,2)"
RATE = "decimal(12,6)"
MONEY_PROBE = "decimal(20,6)"
PRECISE_PROBE = "decimal(38,18)"
MAX_QUANTITY = 100000
MONEY_LIMIT = "1000000000000"
DEFAULT_TOLERANCE = "0.01"
STATUSES = (
    "INVALID_REVERSAL",
    "ORPHAN_PAYOUT",
    "MISSING_PAYOUT",
    "REVERSED",
    "CONTRA",
    "MATCHED",
    "AMOUNT_MISMATCH",
)
DATASETS = (
    "silver_funding",
    "silver_payouts",
    "gold_funding",
    "gold_reconciliation",
    "gold_contra_pairs",
    "gold_vendor_summary",
    "gold_month_end",
    "exceptions",
    "quarantine",
)
# Reader bounds.
MAX_PAGE = 100000
MAX_PAGE_SIZE = 100
MAX_SEARCH = 200
MAX_ID = 200
SEARCH_COLUMNS = ("record_id", "payout_id", "vendor_id", "quality_errors", "raw_record")
PAGE_ORDER = ("accounting_month", "record_id", "payout_id", "vendor_id", "status")
# Quality policy defaults.
MAX_QUARANTINE_RATIO = 0.05
MAX_EXCEPTION_RATIO = 0.50
MIN_FUNDING_RECORDS = 1
FRESHNESS_MAX_AGE_HOURS = 36
RETENTION_DAYS = 30
# ---------------------------------------------------------------------------

KEY = {"funding": "record_id", "payouts": "payout_id"}
FIELDS = {"funding": FUNDING_FIELDS, "payouts": PAYOUT_FIELDS}
REQUIRED = {"funding": FUNDING_REQUIRED, "payouts": PAYOUT_REQUIRED}
MONEY_FIELDS = {"funding": FUNDING_MONEY_FIELDS, "payouts": PAYOUT_MONEY_FIELDS}


def contract_schema(kind: str):
    """All-string StructType of a raw source, in contract order."""
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType([StructField(name, StringType(), True) for name in FIELDS[kind]])


def check_kind(kind: str) -> str:
    if kind not in FIELDS:
        raise ValueError(f"unknown source kind {kind!r}; expected 'funding' or 'payouts'")
    return kind
