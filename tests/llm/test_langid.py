"""Operator 3: held-out accuracy and the defined cases."""

from llm_cases import ODD_TEXTS, docs_frame
from pyspark.sql import functions as F

from ledgerline.llm import langid

SMALL = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = langid.op3_langid(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id")
    row = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.avg(F.when(F.col("held_out"), (F.col("lang") == F.col("lang_pred")).cast("int"))).alias("held"),
        F.min("score").alias("low"),
        F.max("score").alias("high"),
    ).first()
    assert row["n"] == docs.count() and 0 <= row["low"] and row["high"] <= 1
    assert row["right"] > 0.9 and row["held"] > 0.85


def test_smallest_size_wins_and_narrow_margins_are_rejected():
    models = [("aa", 5, langid.dictionary(["apple orange lemon " * 20])), ("bb", 9, langid.dictionary(["tisch stuhl lampe " * 20]))]
    classifier = langid.Classifier(models)
    assert classifier.predict("orange lemon apple orange", 0.01)[0] == "aa"
    assert classifier.predict("lampe stuhl tisch, LAMPE!", 0.01)[0] == "bb"
    lang, score, rejected = classifier.predict("zq", 0.01)
    assert (lang, rejected) == ("bb", True) and score == 0.5  # a tie: more training rows
    sizes = classifier.sizes("stuhl lampe " * 2000)  # beyond one block
    assert sizes[classifier.langs.index("bb")] < sizes[classifier.langs.index("aa")]


def test_odd_rows(spark):
    rows = [*enumerate(ODD_TEXTS), (3, "again"), (None, "no id")]
    models = [("aa", 5, langid.dictionary(["apple orange lemon " * 20]))]
    got = langid.predict(docs_frame(spark, rows), models).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i in (0, 1, 2, 3, 5):
        if i != 3:
            assert by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0
    assert by_id[6]["lang_pred"] == by_id[None]["lang_pred"] == "aa"
    assert {r["lang_pred"] for r in langid.predict(docs_frame(spark, rows), []).collect()} == {"und"}
    assert langid.predict(docs_frame(spark, []), models).count() == 0
    empty = spark.createDataFrame([], "text string, lang string")
    assert langid.fit(empty) == []


def test_short_and_repeated_texts_are_learnt(spark):
    rows = [("kurz ja", "de")] * 500 + [(f"short no {i}", "en") for i in range(3)] + [("", "xx"), (None, "yy"), ("x", None)]
    models = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert [(lang, n) for lang, n, _ in models] == [("de", 500), ("en", 3), ("xx", 1)]
    assert langid.Classifier(models[:2]).predict("kurz ja", 0.01)[0] == "de"
    many = spark.range(20_000).selectExpr("concat('text number ', id) AS text", "'en' AS lang")
    assert 0 < len(langid.fit(many, fit_docs=50)[0][2]) < 50 * 40
