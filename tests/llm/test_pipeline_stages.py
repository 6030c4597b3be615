"""corpus_pipeline: stage by stage against brute force, and odd tables."""

import zlib

import numpy as np
import pytest
from llm_cases import ODD_TEXTS

import corpus_pipeline
from ledgerline.llm import decontamination, sentencepiece_codec, substring_dedup, toxicity

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows of documents and of each stage's result."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for name, work in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        work(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "sentencepiece":
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_toxic_documents_go(spark, steps):
    scores = {r["doc_id"]: r["score"] for r in toxicity.op2_toxicity(spark, SMALL).collect()}
    assert ids(steps[1]) == {d for d, s in scores.items() if s < 0.5}


def test_one_document_of_each_component_stays(steps):
    from test_simhash import plain_components, plain_print

    rows = sorted(steps[1], key=lambda r: r["doc_id"])
    label = plain_components([plain_print(r["text"]) for r in rows])
    assert ids(steps[2]) == {rows[i]["doc_id"] for i in set(label)}
    before = {r["doc_id"]: r for r in rows}
    assert all(before[r["doc_id"]] == r for r in steps[2])


def test_repeated_words_go(steps):
    from test_substring_dedup import plain

    rows = [(r["doc_id"], r["text"]) for r in steps[2]]
    want = {}
    for (d, text), (words, gone) in zip(rows, plain(rows, substring_dedup.WINDOW), strict=True):
        want[d] = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode() if any(gone) else text
    assert {r["doc_id"]: r["text"] for r in steps[3]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[3] if r["text"] != dict(rows)[r["doc_id"]])


def test_leaking_documents_go(spark, steps):
    from test_decontamination import plain_distance

    split = lambda t: [w for w in map(decontamination.word, (t or "").split()) if w]
    items = [split(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    gone = ids(steps[3]) - ids(steps[4])
    for r in steps[3]:
        line, words = split(r["text"]), set(split(r["text"]))
        leak = False
        for item in items:
            allowed = int(len(item) * decontamination.SHARE)
            if sum(w in words for w in item) >= len(item) - allowed:
                leak |= plain_distance(item, line) <= allowed
        assert leak == (r["doc_id"] in gone)


def test_clean_texts_of_a_leaking_id_stay(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").filter("length(text) > 40").orderBy("item_id").first()["text"]
    rows = [(None, f"before {item} after"), (None, "clean words without an id"), (None, None)]
    rows += [(9, item), (9, "clean words of a repeated id"), (9, "clean words of a repeated id"), (10, "others")]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.STAGES[3][1](spark, frame, SMALL).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted((r for r in rows if item not in (r[1] or "")), key=str)


def test_token_ids(steps):
    codec = sentencepiece_codec.Codec(*sentencepiece_codec.build(sentencepiece_codec.default_model()))
    texts = {r["doc_id"]: r["text"] for r in steps[4]}
    assert ids(steps[5]) == set(texts)
    for r in steps[5]:
        found = np.array(r["piece_ids"], "<u4")
        assert len(found) == r["n_pieces"] and zlib.crc32(found.tobytes()) == r["ids_crc32"]
        assert r["round_trip"] == (codec.decode(found) == (texts[r["doc_id"]] or ""))


def test_run_equals_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in got} == {r["doc_id"]: r["ids_crc32"] for r in steps[5]}


def test_odd_tables(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD_TEXTS)] + [(3, "again and again", "en", "s", 5)] * 2
    rows += [(None, "no id here at all", None, "s", 1)]
    for given in (rows, []):
        for _, work in corpus_pipeline.STAGES:
            found = work(spark, spark.createDataFrame(given, kind), SMALL)
            assert found.count() <= len(given)
