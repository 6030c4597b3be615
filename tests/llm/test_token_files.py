"""Operator 9 against whole-text encoding, and the file format's zero-copy access."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD_TEXTS, docs_frame

from ledgerline.llm import common, token_files

TEXTS = [*ODD_TEXTS, "It's a test, ISN'T it?", "naïve Straße ÉCOLE", "<|endoftext|> x", "a b c\x1cd", "é 1234 !!$$"]


def whole(text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(token_files.default_tokenizer()).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 1], "<u4")


@pytest.mark.parametrize("file_ids", [1, 50, 10**6])
def test_ids_match_whole_text_encoding(spark, file_ids):
    docs = docs_frame(spark, list(enumerate(TEXTS)))
    path = common.scratch_path(spark, "t9")
    token_files.write_token_files(docs, path, seq_len=8, file_ids=file_ids)
    got = token_files.with_starts(token_files.read_documents(spark, path)).collect()
    start, expected = 0, {}
    for i, text in enumerate(TEXTS):
        ids = whole(text)
        expected[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == expected


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = docs_frame(spark, [(None, "b"), (2, "x y"), (2, "x y"), (1, None)])
    path = common.scratch_path(spark, "t9")
    token_files.write_token_files(docs, path)
    got = token_files.with_starts(token_files.read_documents(spark, path)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2]
    assert [r["start"] for r in got] == [0, 2, 3, 6]
    path = common.scratch_path(spark, "t9")
    token_files.write_token_files(docs_frame(spark, []), path)
    assert token_files.read_documents(spark, path).count() == 0


def test_sequences_are_views_of_the_file():
    ids = np.arange(10, dtype=np.uint16)
    blob = token_files.stream_file(ids, [7, 9], [4, 6], 4, {"part": 0, "seq": 0})
    assert blob[-1] == 0
    buffer = pa.py_buffer(blob)
    file = token_files.TokenFile(buffer)
    assert len(file) == 3 and file.sequence(1).tolist() == [4, 5, 6, 7]
    assert file.mask(2).to_pylist() == [True, True, False, False]
    for address in (file.sequence(2).__array_interface__["data"][0], file.mask(2).buffers()[1].address):
        assert 0 < address - buffer.address < len(blob)  # no copy


def test_equal_ids_spread_over_files(spark):
    docs = docs_frame(spark, [(7, "x y")] * 300 + [(None, "same")] * 300)
    path = common.scratch_path(spark, "t9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it joins ranges as small as these
    token_files.write_token_files(docs.repartition(4), path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    documents = common.materialize(token_files.read_documents(spark, path), "t9")
    assert documents.count() == 600 and documents.select("part").distinct().count() > 2
    got = token_files.with_starts(documents).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 300 + [7] * 300
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
