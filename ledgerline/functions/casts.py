"""Casts that never raise.

Spark 4 evaluates casts in ANSI mode, where a malformed value aborts the job. The ledger treats
bad input as a quarantine reason instead, so every cast of raw text goes through ``try_cast``.
Integer quantities follow the non-ANSI rule that '3.0' is the integer 3: the text is read as a
decimal first and then truncated to int; exponent notation is not an integer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.contracts import MONEY, MONEY_PROBE, RATE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_or_null(c: str | Column, decimal_type: str) -> Column:
    return _col(c).try_cast(decimal_type)


def money(c: str | Column) -> Column:
    return decimal_or_null(c, MONEY)


def rate(c: str | Column) -> Column:
    return decimal_or_null(c, RATE)


def int_quantity(c: str | Column) -> Column:
    """Text -> int the way a non-ANSI cast does it: '3.0' -> 3, '2.5' -> 2, '1e2' -> NULL."""
    text = _col(c)
    return F.when(~text.rlike("[eE]"), text.try_cast(MONEY_PROBE).try_cast("int"))


def timestamp_or_null(c: str | Column) -> Column:
    return _col(c).try_cast("timestamp")


def blank(c: str | Column) -> Column:
    """NULL or only whitespace."""
    text = _col(c)
    return text.isNull() | (F.trim(text) == "")
