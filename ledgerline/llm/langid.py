"""Operator 3: language identification by compression.

For each language a raw-content zstandard dictionary is filled with text of that language. A text
is lower-cased, everything but its letters becomes a single space, it is cut into blocks, each block is compressed with every dictionary, and the language whose sizes
add up to least wins: the dictionary that shares most substrings with the text saves most. A text
whose best two sizes are within ``margin`` of each other is ``rejected`` (a narrow margin): its
``lang_pred`` stays the best guess, so that a caller can choose.

Defined cases: null text, or text without any letter: ``und`` with score 0, not rejected; equal
sizes go to the language with more training rows, then to the smaller name; no training rows at
all: every text is ``und``. Repeated rows are predicted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import common

UNDETERMINED = "und"
FOLDS = 5
#: The fit reads at most this many texts of a language, so it is bounded: each of FIT_BUCKETS ranges of text hashes offers
#: its least hash, and of these the least are taken.
FIT_DOCS = 400
FIT_BUCKETS = 4096
#: Bytes of a dictionary and of a text's block; the level of compression.
DICT_BYTES = 96 * 1024
BLOCK_BYTES = 4096
LEVEL = 3
#: A best size within this share of the second best is a narrow margin.
MARGIN = 0.01
_LETTER = regex.compile(r"\p{L}")
_REST = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-cased words: marks, digits and line ends say nothing about the language."""
    return _REST.sub(" ", text).lower()


def dictionary(texts: list[str], size: int = DICT_BYTES) -> bytes:
    """Text for one language: the words of the sample, the most frequent ones last (zstandard finds
    the nearest matches cheapest), preceded by running text as far as it fits."""
    counts: dict[str, int] = {}
    texts = [letters(t) for t in texts]
    for text in texts:
        for word in text.split():
            counts[word] = counts.get(word, 0) + 1
    ranked = sorted(counts, key=lambda w: (-counts[w], w))
    words, used = [], 0
    for word in ranked:
        if used > size // 2:
            break
        words.append(word)
        used += len(word.encode()) + 1
    tail = (" " + " ".join(reversed(words)) + " ").encode()
    running = " ".join(texts).encode()
    return running[: max(0, size - len(tail))] + tail


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> list[tuple[str, int, bytes]]:
    """(language, training rows, dictionary) of ``docs`` (text, lang). The number of languages is
    that of the label set; each brings at most ``fit_docs`` texts to the driver."""
    rows = docs.filter("text is not null and lang is not null")
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Hashes first, and only the chosen texts travel. A language brings a row a bucket and task before its buckets
    # are dealt, and FIT_BUCKETS rows to the ranking, whatever share of the rows it holds.
    buckets = rows.groupBy("lang", F.pmod("h", F.lit(FIT_BUCKETS)).alias("bucket")).agg(F.min("h").alias("h"))
    least = Window.partitionBy("lang").orderBy(F.xxhash64("h"))
    chosen = buckets.select("lang", "h").withColumn("place", F.row_number().over(least))
    chosen = chosen.filter(F.col("place") <= fit_docs).drop("place")
    picked = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {lang: [] for lang in totals}
    for r in picked.orderBy("lang", "h").collect():
        texts[r["lang"]].append(r["text"])
    return [(lang, totals[lang], dictionary(texts[lang])) for lang in sorted(totals)]


class Classifier:
    def __init__(self, models: list[tuple[str, int, bytes]], block: int = BLOCK_BYTES, level: int = LEVEL):
        import zstandard as zstd

        self.block = block
        ordered = sorted(models, key=lambda m: (-m[1], m[0]))  # ties go to the first
        self.langs = [m[0] for m in ordered]
        params = zstd.ZstdCompressionParameters.from_level(
            level, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        self.coders = []
        for _, _, content in ordered:
            held = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=params)
            self.coders.append(zstd.ZstdCompressor(dict_data=held, compression_params=params))

    def sizes(self, text: str) -> list[int]:
        data = letters(text).encode("utf-8", "surrogatepass")
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.coders]

    def predict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        if not text or not self.langs or not _LETTER.search(text):
            return UNDETERMINED, 0.0, False
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        gap = (second - sizes[best]) / max(1, second)
        # Each byte saved is evidence; the score tends to 1 as the gap leaves the margin behind.
        return self.langs[best], 0.5 + 0.5 * gap / (gap + margin), gap < margin


def predict(docs: DataFrame, models: list[tuple[str, int, bytes]], margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of ``docs`` (doc_id, text)."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)  # languages x DICT_BYTES, bounded
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            found = [classifier.predict(t, margin) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), *(list(c) for c in zip(*found, strict=True))]
            arrays = [pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    needed = docs.select(F.col("doc_id").cast("long"), "text")
    return needed.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    docs = common.table(spark, sf_dir, "documents")
    models = fit(docs.filter(common.in_training("doc_id", FOLDS)).select("text", "lang"))
    held_out = ~common.in_training("doc_id", FOLDS)
    return predict(docs, models).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
