"""Operator 8: counts and base by brute force, a proper distribution, better than the base."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_frame
from pyspark.sql import functions as F

from ledgerline.llm import maxent_lm as M

SMALL = "/root/testdata/sf0.01"


def tokens(text):
    return [*M.words(text or ""), M.END]


def test_query_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "KNOWN", 500)  # so that the join matters
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    counts = Counter(t for d, x in docs if not held[d] for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in M.op8_lm_scoring(spark, SMALL).collect()}
    gain = {True: 0.0, False: 0.0}
    for d, x in docs:
        row, mine = got[d], tokens(x)
        assert row["held_out"] == held[d] and row["n_tokens"] == len(mine) and row["train_tokens"] == total
        assert row["n_known"] == sum(counts[t] > 0 for t in mine)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in mine)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        gain[held[d]] += row["score"] - row["base_score"]
    assert gain[True] > 0 and gain[False] > 0


def model(spark, rows):
    docs = docs_frame(spark, rows)
    counts = M.word_counts(docs)
    base = M.unigrams(counts)
    return docs, counts, base, M.train(docs, base)


def test_probabilities_sum_to_one(spark):
    rows = [(i, f"alpha beta gamma w{i}ing delta alpha w{i % 3}") for i in range(130)]  # one class has over MEMBERS words
    docs, counts, base, weights = model(spark, rows)
    assert len(base.member) >= M.OTHERS and len(base.known) - len(base.top) > len(base.member)
    known = [bytes(r["word"]) for r in counts.collect()]
    for context in ("", "alpha", "beta gamma", "nobody knows this"):
        texts = [f"{context} {w.decode()}" for w in known if w != M.END] + [f"{context} neverseen"]
        got = M.score(docs_frame(spark, list(enumerate(texts))), counts, base, weights).collect()
        whole = {r["doc_id"]: r["score"] for r in got}
        reader = M.Reader(base)
        total = 0.0
        for i, text in enumerate(texts):  # the last word's share: take the others and the end away
            names, word, _, classes, used = reader.read([text])
            logs = M.class_logs(weights, base, used)
            c = {bytes(r["word"]): r["c"] for r in counts.collect()} if i == 0 else c
            kind = lambda k: classes[k] if names[word[k]] in c else M.UNSEEN
            at, *inner = reader.members(names, word, np.zeros(len(word), np.int64), classes)
            more = dict(zip(at.tolist(), M.member_gains(weights, base, *inner), strict=True))
            each = [
                (logs[k, kind(k)] - base.class_log[kind(k)] + (more.get(k, 0) if names[word[k]] in c else 0)) / np.log(10)
                + math.log10((c.get(names[word[k]], 0) + 0.1) / base.norm)
                for k in range(len(word))
            ]
            assert sum(each) == pytest.approx(whole[i], abs=1e-4)
            total += 10 ** each[-2]
            if i == 0:
                names, word, _, classes, used = reader.read([context])
                logs = M.class_logs(weights, base, used)
                total += 10 ** ((logs[-1, 0] - base.class_log[0]) / np.log(10) + math.log10((c[M.END] + 0.1) / base.norm))
        assert total == pytest.approx(1, abs=1e-3)


def test_gradient_steps_lower_the_loss(spark):
    rows = [(i, "red green blue " * 20) for i in range(30)]
    docs, counts, base, weights = model(spark, rows)
    got = M.score(docs, counts, base, weights).first()
    assert got["score"] > got["base_score"] + 5


def test_a_small_task_trains_every_feature(spark):
    """All tokens fit one mini-batch, and every (token, feature) gradient is applied."""
    rows = [(i, f"red green blue w{i % 5}") for i in range(20)]
    docs, _, base, weights = model(spark, rows)
    _, _, _, _, used = M.Reader(base).read([t for _, t in rows])
    for f in range(used.shape[1]):
        assert np.abs(weights[np.unique(used[:, f])]).sum(axis=1).all(), f


def test_members_of_one_class_are_told_apart(spark):
    """Two words of equal last letters, each after another word: the second factor learns which one comes."""
    rare = " ".join(f"common{i % 10} filler{i}" for i in range(45))
    rows = [(i, f"{rare} left upperend right lowerend " * 400) for i in range(40)]
    docs, counts, base, weights = model(spark, rows)
    assert b"upperend" not in base.top and M.suffix_class(b"upperend") == M.suffix_class(b"lowerend")
    texts = ["left upperend", "left lowerend", "right lowerend", "right upperend"]
    reader = M.Reader(base)
    names, word, home, classes, _ = reader.read(texts)
    at, kind, place, used = reader.members(names, word, home, classes)
    gains = dict(zip(at.tolist(), M.member_gains(weights, base, kind, place, used), strict=True))
    ends = [gains[i] for i in range(len(word)) if names[word[i]] in (b"upperend", b"lowerend")]
    assert ends[0] > ends[1] + 0.5 and ends[2] > ends[3] + 0.5, ends


def test_row_sums():
    rng = np.random.default_rng(3)
    for n, size in ((1, 5), (500, 3), (500, 5000), (8192, 65)):
        rows, slope = rng.integers(900, 900 + size, n), rng.random((n, 4), dtype=np.float32)
        used, got = M.row_sums(rows, slope)
        assert used.tolist() == sorted(set(rows.tolist()))
        for r, line in zip(used, got, strict=True):
            assert line == pytest.approx(slope[rows == r].sum(axis=0), rel=1e-4)


def test_texts_are_split_without_an_object_a_word(spark, monkeypatch):
    """Reading and counting give what ``words`` gives, ends included, without calling it."""
    plain = M.words
    every = "".join(f"A{chr(i)}b" for i in range(0x250)) + "\u0085x\u2003y\ufeffz"
    texts = ["", " ", "\n\t one  TWO\x1cthree\r", "one", "x\x00y İ É ß\x0b\x0cEND\n", "\ud800 lone", every, "a" * 70_000, *filter(None, ODD_TEXTS)]
    counts = M.word_counts(docs_frame(spark, [(i, "b a B") for i in range(3)]))
    monkeypatch.setattr(M, "words", None)
    names, word, home, _, _ = M.Reader(M.unigrams(counts)).read(texts)
    for i, text in enumerate(texts):
        assert [names[k] for k in word[home == i]] == [*plain(text), M.END], text[:50]
    flat, sizes = M.split(texts)
    assert flat.to_pylist() == [w for t in texts for w in plain(t)] and sizes.tolist() == [len(plain(t)) for t in texts]
    assert M.split([])[1].tolist() == M.split([""])[0].to_pylist() == []


@pytest.mark.parametrize("few", [1, 10**9])
def test_words_are_counted_in_parts(spark, monkeypatch, few):
    """Each batch's words are folded into the counts, which are handed on at once or held to the end."""
    monkeypatch.setattr(M, "COUNT_BYTES", 1)
    monkeypatch.setattr(M, "COUNT_WORDS", few)
    rows = [(i, f"One w{i % 7} two two  ") for i in range(1300)] + [(None, None)]
    got = {bytes(r["word"]): r["c"] for r in M.word_counts(docs_frame(spark, rows).coalesce(1)).collect()}
    assert got == Counter(t for _, x in rows for t in tokens(x))


def test_odd_rows(spark):
    rows = [*enumerate(ODD_TEXTS), (3, "again"), (3, "again"), (None, "no id")]
    docs, counts, base, weights = model(spark, rows)
    got = M.score(docs, counts, base, weights).collect()
    assert len(got) == len(rows)
    assert sorted(r["n_tokens"] for r in got) == sorted(len(tokens(t)) for _, t in rows)
    assert all(r["n_known"] == r["n_tokens"] and math.isfinite(r["score"]) for r in got)
    empty = docs_frame(spark, [])
    nothing = M.unigrams(M.word_counts(empty))
    bare = M.score(docs, M.word_counts(empty), nothing, M.train(empty, nothing)).agg(F.sum("n_known"), F.sum("score"), F.sum("base_score"))
    assert tuple(bare.first()) == (0, 0.0, 0.0)
    assert M.score(empty, counts, base, weights).count() == 0
