"""Operator 1 against a plain search, the library and round trips."""

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_frame

from ledgerline.llm import sentencepiece_codec as S

PLAIN = ["", "a", " a", "  a b  ", "the quick  brown\nfox", "日本 語\n x", "é \U0001f600!!", "   ", "tab\there", "x" * 300]


@pytest.fixture(scope="module")
def codec():
    return S.Codec(*S.build(S.default_model()))


def search(codec, text):
    """Best cut of a whole text, one character at a time."""
    v = codec.vocabulary
    known = {v.pieces[i]: int(i) for i in v.normal}
    line = S.MARK + text.replace(" ", S.MARK) if text else ""
    best, back = [0.0] + [-np.inf] * len(line), [None] * (len(line) + 1)
    for i in range(len(line)):
        edges = [(line[i:j], known[line[i:j]]) for j in range(i + 1, min(len(line), i + 20) + 1) if line[i:j] in known]
        if line[i] not in known:
            edges.append((line[i], None))
        for piece, ident in edges:
            score = best[i] + (codec.unknown if ident is None else v.scores[ident])
            if score > best[i + len(piece)] + 1e-9:
                best[i + len(piece)], back[i + len(piece)] = score, (i, piece, ident)
    return best[-1]


def total(codec, ids):
    """Score of ids; a character's byte pieces count as one unknown."""
    v, out, k = codec.vocabulary, 0.0, 0
    of_byte = {int(i): b for b, i in enumerate(v.byte_ids) if i >= 0}
    while k < len(ids):
        if ids[k] in of_byte:
            head = of_byte[ids[k]]
            k += 1 + (head >= 0xC0) + (head >= 0xE0) + (head >= 0xF0)
            out += codec.unknown
        else:
            out += v.scores[ids[k]]
            k += 1
    return out


def test_best_score_and_round_trip(codec):
    for text, coded in zip(PLAIN, codec.encode(PLAIN), strict=True):
        ids = np.frombuffer(coded, "<i4")
        assert total(codec, ids.tolist()) == pytest.approx(search(codec, text))
        assert codec.decode(ids) == text


def test_same_ids_as_the_library(codec):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = pb.ModelProto()
    with open(S.default_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # Unigram, with our scores
    for i in codec.vocabulary.normal:
        model.pieces[int(i)].score = float(codec.vocabulary.scores[i])
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    for text, coded in zip(PLAIN, codec.encode(PLAIN), strict=True):
        assert np.frombuffer(coded, "<i4").tolist() == library.encode(text)


def test_unknown_ids_and_broken_bytes(codec):
    byte = int(codec.vocabulary.byte_ids[0xE9])
    assert codec.decode(np.array([byte])) == "�"
    assert codec.decode(np.array([10**6])) == "�"


def test_odd_rows(spark):
    rows = [*enumerate(ODD_TEXTS), (3, "again"), (3, "again"), (None, "no id")]
    found = S.decode(S.encode(docs_frame(spark, rows))).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded"]) for r in found) == sorted(
        (i is None, i or 0, t or "") for i, t in rows
    )
    assert S.decode(S.encode(docs_frame(spark, []))).count() == 0
