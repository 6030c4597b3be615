"""Row digests and sums of them.

A multiset digest is four sums, modulo 2^64, of the quarters of the rows' SHA-256. It does not depend on row order or
partitioning, repeated rows count, partial sums combine in any order, and digests of disjoint sets add up.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMBS = ("limb1", "limb2", "limb3", "limb4")
_WIDTH = "decimal(20,0)"


def row_digest(columns: Iterable[str]) -> Column:
    """SHA-256 (hex) of the columns' texts. Each text carries its length and null is ``-``, so different rows
    have different inputs."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.sha2(F.concat(F.lit(""), *(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def _modulo(value: Column) -> Column:
    return (value % F.lit(str(1 << 64)).cast(_WIDTH)).cast(_WIDTH)


def limbs(digest: Column) -> list[Column]:
    """The quarters of a digest as unsigned numbers."""
    return [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, 10).cast(_WIDTH).alias(name) for i, name in enumerate(LIMBS)]


def words(digest: Column) -> dict[str, Column]:
    """The quarters of a digest as 64-bit integers (two's complement), by the limbs' names: for the sums of single rows,
    which in decimals cost more than the digest itself. Cut as bytes, because a text is cut by counting its characters."""
    quarter = lambda i: F.substring(digest.cast("binary"), 1 + 16 * i, 16).cast("string")
    return {name: F.conv(quarter(i), 16, -10).cast("bigint") for i, name in enumerate(LIMBS)}


def with_limbs(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` with the limbs of its rows' digests. The digest names every text twice; those of columns of other types are
    made once, by a projection of their own."""
    columns = list(columns)
    texts = {c: f"_{c}__text" for c, kind in df.dtypes if c in columns and kind != "string"}
    made = df.select("*", *[F.col(f"`{c}`").cast("string").alias(text) for c, text in texts.items()])
    return made.select(*[f"`{c}`" for c in df.columns], *limbs(row_digest(texts.get(c, c) for c in columns)))


def limb_sums() -> list[Column]:
    """Aggregates: the multiset digest of rows or of partial digests."""
    return [_modulo(F.sum(name)).alias(name) for name in LIMBS]


def word_sums(words: dict[str, Column]) -> list[Column]:
    """``limb_sums`` of rows by their ``words``. Each word is added up in three parts of 22, 21 and 21 bits, so that no sum of
    fewer than 2^41 rows leaves 64 bits; only the sums are put together as decimals. As the aggregates of one projection
    they make a row's digest once, and need no column of it."""
    mask, whole = F.lit((1 << 21) - 1).cast("bigint"), F.lit(str(1 << 64)).cast(_WIDTH)
    sums = []
    for name, word in words.items():
        parts = (F.shiftright(word, 42), F.shiftright(word, 21).bitwiseAND(mask), word.bitwiseAND(mask))
        high, middle, low = (F.sum(part).cast("decimal(19,0)") for part in parts)
        total = high * F.lit(str(1 << 42)).cast("decimal(13,0)") + middle * F.lit(str(1 << 21)).cast("decimal(7,0)") + low
        sums.append(F.pmod(total, whole).cast(_WIDTH).alias(name))
    return sums


def as_text() -> Column:
    return F.concat_ws(".", *(F.col(name).cast("string") for name in LIMBS))
