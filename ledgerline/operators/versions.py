"""Latest-version selection (D1).

The newest ``updated_at`` wins; equal timestamps fall back to the larger SHA-256 of the row's
contract text, so a replay picks the same winner. Instead of ranking every row in a window
(which sends all versions of a key to one task and cannot pre-aggregate), this is a ``max`` over
a struct ``(timestamp, digest, row)`` in ``groupBy(key)``: Spark combines map-side, so even a key
holding a third of all rows leaves each map task as one partial row before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.casts import timestamp_or_null


#: Digest bytes that are shuffled to break ties. A digest is noise that no codec shrinks, and was the largest part of a shuffled
#: row. Two different rows of one record and time agree in these 128 bits with a chance of 2^-128.
TIE_BYTES = 16


def content_digest(columns: list[str] | tuple[str, ...]) -> Column:
    """SHA-256 hex of the '|'-joined text of the given columns (NULL as empty text)."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def latest(
    df: DataFrame,
    key: str,
    hash_columns: list[str] | tuple[str, ...] | None = None,
    where: Column | None = None,
    columns: list[str] | tuple[str, ...] | None = None,
    digest: str | None = None,
) -> DataFrame:
    """One row per ``key``: latest ``updated_at``, ties broken by ``content_digest`` (descending), which the column
    ``digest`` holds if it is named.

    ``where`` restricts the candidates inside the aggregate (``max`` ignores NULLs) instead of a
    filter in front of it; Catalyst would push such a filter below the projections that compute
    it and evaluate the expression twice. ``columns`` selects the output columns (default all);
    only they, the timestamp and the digest's first ``TIE_BYTES`` are shuffled, as bytes, which order
    like their hex text. The key comes from the grouping, so a join on it needs no second shuffle.
    """
    out = list(columns) if columns is not None else list(df.columns)
    hashed = list(hash_columns) if hash_columns is not None else [c for c in out if c != "source_file"]
    candidate = F.struct(
        timestamp_or_null("updated_at").alias("ts"),
        F.substring(F.unhex(F.col(digest) if digest else content_digest(hashed)), 1, TIE_BYTES).alias("digest"),
        F.struct(F.lit(True).alias("_there"), *[F.col(c) for c in out if c != key]).alias("row"),
    )
    if where is not None:
        candidate = F.when(where, candidate)
    best = F.max(candidate).alias("_best")
    picked = df.groupBy(F.col(key).alias("_key")).agg(best)
    if where is not None:
        picked = picked.filter(F.col("_best").isNotNull())
    return picked.select(*[(F.col("_key") if c == key else F.col("_best.row").getField(c)).alias(c) for c in out])


def merged(previous: DataFrame, fresh: DataFrame, key: str, hash_columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The snapshot ``previous`` brought forward by ``fresh``, the latest rows of new drops: what ``latest`` over all
    drops would give, whatever order drops come in. Only keys of ``fresh`` are ranked again, so late rows lose
    against newer ones; all other rows pass through without a shuffle or a sort."""
    touched = fresh.select(key)
    known = previous.join(touched, key, "left_semi").select(*previous.columns)
    ranked = latest(known.unionByName(fresh.select(*previous.columns)), key, hash_columns=hash_columns)
    return previous.join(touched, key, "left_anti").select(*previous.columns).unionByName(ranked)
