"""Operator 7: recall against brute force, and the defined cases."""

import math

import numpy as np

from ledgerline.llm import ann


def brute(ids, x, query, own, top):
    scores = x @ query
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own]
    return [int(ids[i]) for i in order[:top]]


def recall(spark, x, ids, top=20):
    frame = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(frame, frame.filter("vec_id % 20 = 0"), top).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    where = {int(i): k for k, i in enumerate(ids)}
    for i in ids[ids % 20 == 0]:
        want = brute(ids, x, x[where[int(i)]], i, top)
        rows = sorted(got[int(i)])
        assert [r[0] for r in rows] == list(range(1, len(want) + 1))
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        assert all(abs(s - float(x[where[v]] @ x[where[int(i)]])) < 1e-9 for _, v, s in rows)
        hit, total = hit + len({v for _, v, _ in rows} & set(want)), total + len(want)
    return hit / total


def test_recall_on_random_and_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 64))
    assert recall(spark, x / np.linalg.norm(x, axis=1, keepdims=True), np.arange(3000)) >= 0.9
    centers = rng.standard_normal((30, 32))
    y = centers[rng.integers(0, 30, 2000)] + 0.2 * rng.standard_normal((2000, 32))
    assert recall(spark, y * rng.uniform(0.5, 2, (2000, 1)), np.arange(2000)) >= 0.9  # norms differ


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in rows], float)
    assert recall(spark, x, np.array([r["vec_id"] for r in rows])) >= 0.9


def test_blocks_and_chunks_agree(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "CHUNK", 7)
    x = np.random.default_rng(4).standard_normal((400, 16))
    assert recall(spark, x, np.arange(400)) >= 0.9


def test_odd_vectors(spark):
    rows = [
        (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [math.nan, 1.0]),
        (7, [None, 1.0]), (8, [math.inf, 0.0]), (9, [1.0, 2.0, 3.0]), (40, [1.0, 2.0, 3.0]), (60, [5.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame([(i, v, "b", 1) for i, v in rows], "vec_id long, embedding array<double>, block string, dim int")
    got = ann.nearest(frame, frame.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(20, 1), (20, 2), (20, 2), (40, 9)]
    twice = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (3, [2.0, 1.0])]  # the middle rows are equal
    frame = spark.createDataFrame(twice, "vec_id long, embedding array<double>")
    got = ann.nearest(frame, frame.filter("vec_id = 20")).orderBy("query_id", "rank", "vec_id", "score").collect()
    by_rank = [sorted((r["vec_id"], r["score"]) for r in got if r["rank"] == k) for k in (1, 2, 3)]
    assert by_rank == [[(3, 1.0), (3, 1.0), (3, 2.0)], [(20, 0.0), (20, 1.0), (20, 1.0)], [(20, 0.0)] * 3]
    assert ann.nearest(frame.limit(0), frame.limit(0)).count() == 0
