"""Operator 10 against a plain scan of all windows."""

import random

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_frame

from ledgerline.llm import substring_dedup as S


def plain(rows, window):
    """{row: removed marks}; a null id is smaller than all others."""
    place = [S.NULL_DOC if i is None else i for i, _ in rows]
    split = [(t or "").encode().split() for _, t in rows]
    first = {}
    for d, words in zip(place, split, strict=True):
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first[key] = min(first.get(key, (d, p)), (d, p))
    out = []
    for d, words in zip(place, split, strict=True):
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < (d, p):
                gone[p : p + window] = [True] * window
        out.append((words, gone))
    return out


def random_rows(seed, window):
    rnd = random.Random(seed)
    letters = rnd.choice([2, 3, 10, 500])
    rows = []
    for i in rnd.sample(range(100), rnd.randint(1, 12)):
        words = [f"w{rnd.randrange(letters)}" for _ in range(rnd.randint(0, 90))]
        if rows and rnd.random() < 0.6:
            other = rnd.choice(rows)[1].split()
            a = rnd.randrange(len(other) + 1)
            words[len(words) // 2 : len(words) // 2] = other[a : a + rnd.randint(window, 3 * window)]
        if rnd.random() < 0.3:
            words[3:3] = ["same"] * rnd.randint(1, 3 * window)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("window", [3, 4, 7, 20])
def test_windows_against_plain_scan(window):
    for seed in range(40):
        rows = random_rows(seed, window)
        split = [t.encode().split() for _, t in rows]
        held = {}
        for part in range(3):  # as three tasks would cut them
            mine = [i for i in range(len(rows)) if i % 3 == part and len(split[i]) >= window]
            ids = np.array([rows[i][0] for i in mine], np.int64)
            for bucket, blob in S.chunk_rows(ids, [split[i] for i in mine], window, 4):
                held.setdefault(bucket, []).append(S.unpack(blob))
        gone = {i: [False] * len(w) for (i, _), w in zip(rows, split, strict=True)}
        for parts in held.values():
            for d, s, n in zip(*S.repeats(*(np.concatenate(x) for x in zip(*parts, strict=True))), strict=True):
                gone[d][s : s + n + window - 1] = [True] * (n + window - 1)
        assert [gone[i] for i, _ in rows] == [g for _, g in plain(rows, window)]


def test_equal_substrings_share_interior_borders():
    rng = np.random.default_rng(2)
    shared = rng.integers(1, 2**60, 40).astype(np.uint64)
    lines = [np.concatenate([rng.integers(1, 2**60, k).astype(np.uint64), shared, rng.integers(1, 2**60, 9).astype(np.uint64)]) for k in (5, 12)]
    inner = []
    for line, begin in zip(lines, (5, 12), strict=True):
        at, lo, hi, key = S.borders(line, 2)
        inside = (lo >= begin) & (hi <= begin + 40)
        inner.append(list(zip((at[inside] - begin).tolist(), key[inside].tolist(), strict=True)))
    assert inner[0] == inner[1] and len(inner[0]) >= 10


def test_frame_with_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [*enumerate(ODD_TEXTS), (40, text), (None, text), (41, "x  y\n" + text), (50, text), (50, text)]
    got = S.remove_repeats(docs_frame(spark, rows)).select("row.*", "n_words", "n_removed", "kept").collect()
    assert len(got) == len(rows) and set(docs_frame(spark, []).columns) < set(got[0].asDict())
    expected = []
    for (i, t), (words, gone) in zip(rows, plain(rows, S.WINDOW), strict=True):
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        expected.append((i, t, len(words), sum(gone), kept))
    assert sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == sorted(expected, key=str)
    assert S.remove_repeats(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_null_and_repeated_ids_lose_only_their_own_words(spark, parts):
    line = lambda w, n: " ".join(f"{w}{i}" for i in range(n))
    shared = line("s", 25)
    rows = [(None, shared), (None, line("u", 60)), (None, f"{shared} {line('v', 30)}"), (None, f"{line('x', 9)} {shared}")]
    rows += [(7, f"{shared} {line('w', 30)}"), (7, line("y", 70)), (7, f"{shared} {line('z', 5)}"), (7, line("y", 70))]
    frame = docs_frame(spark, rows)
    mark = {r["text"]: r["h"] for r in frame.selectExpr("text", "xxhash64(text) as h").collect()}
    places = [(S.NULL_DOC if i is None else i, mark[t]) for i, t in rows]
    ranked = [(sorted(set(places)).index(p), t) for p, (_, t) in zip(places, rows, strict=True)]
    want = []
    for (i, _), (words, gone) in zip(rows, plain(ranked, S.WINDOW), strict=True):
        want.append((i, sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()))
    got = S.remove_repeats(frame.repartition(parts)).select("row.doc_id", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sorted(n for _, n, _ in want) == [0, 0, 0, 0, 25, 25, 25, 25]


def test_known_repeats_spread_over_the_buckets():
    passage = [f"s{i}".encode() for i in range(25)]
    docs = [[*passage, *(f"t{d}_{i}".encode() for i in range(5))] for d in range(400)] + [[b"same"] * 20_000]
    held = np.zeros(10, np.int64)
    for bucket, blob in S.chunk_rows(np.arange(len(docs)), docs, 20, 10):
        held[bucket] += (S.unpack(blob)[3] >= 128).sum()
    assert held.sum() > 15_000 and held.max() < 0.4 * held.sum()


def test_buckets_grow_with_the_text(spark, monkeypatch):
    frame = docs_frame(spark, [(i, "w " * 500) for i in range(90)] + [(None, None)])
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert S.bucket_count(frame) == least == S.bucket_count(docs_frame(spark, []))
    monkeypatch.setattr(S, "BUCKET_BYTES", 1_000)
    assert S.bucket_count(frame) == 90
    got = S.remove_repeats(frame).selectExpr("sum(n_removed)").first()[0]
    assert got == 90 * 500 - 1  # the window from the second word on repeats the first one
