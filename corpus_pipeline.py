"""A training-data pipeline: five operators in a row over ``documents``.

Each stage gets what its predecessor kept and returns the columns of documents; the last one
returns the token ids. Scratch tables of a stage are deleted when the next one begins, because
its result is written by then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common, decontamination, sentencepiece_codec, simhash, substring_dedup, toxicity

_LEFT: list[str] = []


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.delete(spark, _LEFT)
        _LEFT.clear()
        mark = common.scratch_mark()
        found = work(spark, docs, sf_dir)
        _LEFT.extend(common.scratch_since(mark))
        return found

    run.__name__ = work.__name__
    run.__doc__ = work.__doc__
    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5. The machine learns from the labels' training rows."""
    labels = common.table(spark, sf_dir, "labels").filter(common.in_training("doc_id", toxicity.FOLDS))
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"))
    return toxicity.score(docs, model, docs.columns).filter("score < 0.5").select("row.*")


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.one_of_each(docs)


@_stage
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows. A text that loses none stays as it is; the
    others' words are joined by single spaces. A document that loses all keeps an empty text."""
    found = substring_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars"))}
    return found.select(*(changed.get(c, F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


@_stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks. Only the leaking texts go: other texts of the same
    (or also of no) id stay. The leaking documents' keys are written first, so where they are few
    Spark moves no text."""
    benchmark = common.table(spark, sf_dir, "benchmark")
    hits = decontamination.leaks(docs, benchmark).select("doc_id", "text_hash").distinct()
    hits = common.materialize(hits, "leaking-documents")
    leaking = docs["doc_id"].cast("long").eqNullSafe(hits["doc_id"]) & (F.xxhash64(docs["text"]) == hits["text_hash"])
    return docs.join(hits, leaking, "left_anti")


@_stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece_ids, n_pieces, ids_crc32, and whether decoding gives the text back."""
    found = sentencepiece_codec.decode(sentencepiece_codec.encode(docs))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return found.select("doc_id", "piece_ids", "n_pieces", "ids_crc32", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("decontamination", drop_leaks),
    ("sentencepiece", tokenize),
]

#: The string kernel, SimHash and piece ids are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and reread."""
    docs = common.table(spark, sf_dir, "documents")
    for name, work in STAGES:
        found = work(spark, docs, sf_dir)
        path = common.scratch_path(spark, f"pipeline-{name}")
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
