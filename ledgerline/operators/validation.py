"""Contract validation (P1, P2) and the quarantine projection (P3).

One projection computes every reason for a row; reasons are joined with '|' in a fixed order and
an empty string means the row is valid. The partition (batch) date is a column, so one scan over
many daily drops is validated in a single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contracts import (
    CURRENCY,
    FIELDS,
    FUNDING_NON_NEGATIVE,
    MAX_QUANTITY,
    MONEY,
    MONEY_FIELDS,
    MONEY_LIMIT,
    MONEY_PROBE,
    PRECISE_PROBE,
    RATE,
    RATE_FIELDS,
    REQUIRED,
    check_kind,
)
from ledgerline.functions.casts import blank, int_quantity

ERRORS = "quality_errors"
#: The amount of each kind that may be negative: any number of the money type will do.
SIGNED = {"funding": "adjustment", "payouts": "amount"}


def _reason(condition: Column, label: str) -> Column:
    # A NULL condition emits nothing, like a false one.
    return F.when(condition, F.lit(label))


def _probe(name: str, suffix: str) -> str:
    return f"_{name}__{suffix}"


def probes(kind: str) -> dict[str, Column]:
    """Every raw-text cast the rules need, each computed once per row."""
    check_kind(kind)
    out = {
        _probe("event_date", "date"): F.col("event_date").try_cast("date"),
        _probe("updated_at", "ts"): F.col("updated_at").try_cast("timestamp"),
    }
    if kind == "funding":
        for name in FUNDING_NON_NEGATIVE:
            out[_probe(name, "p6")] = F.col(name).try_cast(MONEY_PROBE)
        for name in RATE_FIELDS:
            out[_probe(name, "p18")] = F.col(name).try_cast(PRECISE_PROBE)
    out[_probe(SIGNED[kind], "money")] = F.col(SIGNED[kind]).try_cast(MONEY)
    for name in MONEY_FIELDS[kind]:
        out[_probe(name, "p18")] = F.col(name).try_cast(PRECISE_PROBE)
    return out


def _finer_than(precise: Column, decimal_type: str) -> Column:
    """Whether a value has digits behind the type's scale, or none in its range. Read from the value, not from the text
    again: a text between two values of the type is none of them either way."""
    value = precise.try_cast(decimal_type)
    return value.isNull() | (precise != value)


def reasons(kind: str, batch_date: Column | str) -> list[Column]:
    """Ordered reason expressions for one source kind, over the ``probes`` columns."""
    check_kind(kind)
    batch = F.lit(batch_date) if isinstance(batch_date, str) else batch_date
    p = lambda name, suffix: F.col(_probe(name, suffix))
    out = [_reason(blank(name), f"missing_{name}") for name in REQUIRED[kind]]
    out.append(_reason(F.col("currency") != CURRENCY, "unsupported_currency"))
    out.append(_reason(p("event_date", "date").isNull() | (F.col("event_date") != batch), "invalid_batch_date"))
    out.append(_reason(p("updated_at", "ts").isNull(), "invalid_updated_at"))
    if kind == "funding":
        for name in FUNDING_NON_NEGATIVE:
            value = p(name, "p6")
            minimum = 1 if name == "quantity" else 0
            out.append(_reason(value.isNull() | (value < minimum), f"invalid_{name}"))
        # Non-ANSI integer reading: '3.0' is 3, exponent notation is not an integer.
        whole = F.when(~F.col("quantity").rlike("[eE]"), p("quantity", "p6").try_cast("int"))
        out.append(
            _reason(
                whole.isNull() | (p("quantity", "p6") != whole) | (whole > MAX_QUANTITY),
                "invalid_integer_quantity",
            )
        )
        for name in RATE_FIELDS:
            precise = p(name, "p18")
            out.append(_reason(_finer_than(precise, RATE) | (precise < 0) | (precise > 1), f"invalid_{name}"))
    out.append(_reason(p(SIGNED[kind], "money").isNull(), f"invalid_{SIGNED[kind]}"))
    limit = F.lit(MONEY_LIMIT).cast(MONEY)
    for name in MONEY_FIELDS[kind]:
        precise = p(name, "p18")
        out.append(_reason(_finer_than(precise, MONEY) | (F.abs(precise) > limit), f"invalid_money_precision_or_range_{name}"))
    return out


def tag(df: DataFrame, kind: str, batch_date: Column | str = "batch_date") -> DataFrame:
    """Add ``quality_errors`` ('' when valid). ``batch_date`` is a column name or a literal date."""
    batch = F.col(batch_date) if isinstance(batch_date, str) and batch_date in df.columns else batch_date
    probe = probes(kind)
    probed = df.select("*", *[c.alias(name) for name, c in probe.items()])
    return probed.withColumn(ERRORS, F.concat_ws("|", *reasons(kind, batch))).drop(*probe)


def validate(df: DataFrame, kind: str, batch_date: Column | str = "batch_date") -> tuple[DataFrame, DataFrame]:
    """Split a raw source into (valid rows without the reason column, rejected rows with it)."""
    tagged = tag(df, kind, batch_date)
    return picked(tagged, True).drop(ERRORS), picked(tagged, False)


def picked(tagged: DataFrame, good: bool) -> DataFrame:
    """The valid or the rejected rows of a tagged frame.

    A plain filter would be pushed below the projection of the casts, and every cast evaluated as often as the reasons
    name it. Rows come out of a generator instead, so each cast runs once; ``outer``, because for an inner generator
    Catalyst infers that same filter."""
    wanted = F.col(ERRORS) == "" if good else F.col(ERRORS) != ""
    row = F.struct(F.lit(True).alias("_wanted"), *[F.col(c) for c in tagged.columns])
    return tagged.select(F.inline_outer(F.when(wanted, F.array(row)))).filter("_wanted").drop("_wanted")


def quarantine(rejected: DataFrame, kind: str) -> DataFrame:
    """Rejected rows as (source_type, quality_errors, source_file, raw_record JSON of the contract)."""
    check_kind(kind)
    source_file = F.col("source_file") if "source_file" in rejected.columns else F.lit(None).cast("string")
    return rejected.select(
        F.lit(kind).alias("source_type"),
        F.col(ERRORS),
        source_file.alias("source_file"),
        F.to_json(F.struct(*[F.col(c) for c in FIELDS[kind]])).alias("raw_record"),
    )


def reason_counts(tagged: DataFrame) -> DataFrame:
    """Rows per individual reason over a tagged frame (a row with two reasons counts twice). Valid rows, which have one
    empty reason, leave behind the generator for the same cause as in ``picked``."""
    return (
        tagged.select(F.explode_outer(F.split(F.col(ERRORS), r"\|")).alias("reason"))
        .filter(F.col("reason") != "")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
