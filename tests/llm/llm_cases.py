"""Inputs that every operator must take, and small frames."""

from pyspark.sql import types as T

LONG = "wort " * 30_000
ODD_TEXTS = [None, "", " ", "\n\t ", "a", "!!! 123", "x" * 5_000, LONG, "\U0001f600 é 日本"]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        # Names that the operators use inside.
        T.StructField("doc", T.StringType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("fp", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("start", T.StringType()),
    ]
)


def docs_frame(spark, rows):
    """doc_id and text, with more columns of clashing names."""
    return spark.createDataFrame([(i, t, "d", 1, 2, 0.5, None) for i, t in rows], SCHEMA)
