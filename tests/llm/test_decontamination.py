"""Operator 4: exact distances, planted leaks, and the defined cases."""

import random

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_frame

from ledgerline.llm import decontamination as D


def plain_distance(item, line):
    """Edits between ``item`` and the nearest run of ``line``."""
    before = [0] * (len(line) + 1)
    for i, a in enumerate(item):
        row = [i + 1]
        for j, b in enumerate(line):
            row.append(min(before[j] + (a != b), before[j + 1] + 1, row[j] + 1))
        before = row
    return min(before)


def text(rnd, n, words=400):
    return [f"w{rnd.randrange(words)}" for _ in range(n)]


def test_edit_distance():
    rng = np.random.default_rng(1)
    for _ in range(50):
        item, line = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 25))
        got, _ = D.edit_distances(item, line[None, :])
        assert got[0] == plain_distance(item.tolist(), line.tolist())


def test_planted_leaks_and_nothing_else(spark):
    rnd = random.Random(4)
    items = {i: text(rnd, rnd.randint(15, 50)) for i in range(30)}
    rows, planted = [], {}
    for d in range(300):
        body = text(rnd, rnd.randint(0, 200))
        if d % 3 == 0:
            i = rnd.randrange(30)
            copy = list(items[i])
            for _ in range(rnd.randint(0, len(copy) // 10)):
                at = rnd.randrange(len(copy))
                copy[at : at + 1] = rnd.choice([[], ["new"], [copy[at], "new"]])
            at = rnd.randrange(len(body) + 1)
            body[at:at] = [w.upper() + rnd.choice(["", ",", "."]) for w in copy]
            planted[d] = i
        rows.append((d, " ".join(body)))
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items.items()], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in D.leaks(docs_frame(spark, rows), bench).collect()}
    missed = [d for d, i in planted.items() if (d, i) not in got]
    assert len(missed) <= 0.02 * len(planted)
    split = {d: [w for w in map(D.word, t.split()) if w] for d, t in rows}
    for (d, i), edits in got.items():
        assert edits == plain_distance(items[i], split[d]) <= D.SHARE * len(items[i])


def test_the_recall_is_required(monkeypatch):
    rnd = random.Random(9)
    for size, words in ((40, 60), (20, 10), (60, 3)):
        items = [(i, " ".join(text(rnd, size, words))) for i in range(50)]
        assert D.Index(items, D.SHARE, D.RECALL).measured >= D.RECALL
    plain, slow = D.Repetition.candidates, []

    def few(self, symbols, lengths):  # a walk finds copies of one length in six
        found = plain(self, symbols, lengths)
        slow.append(self) if self not in slow else None
        return found if (len(symbols) + len(slow)) % 6 == 0 else tuple(x[:0] for x in found)

    monkeypatch.setattr(D, "MOST_REPETITIONS", 5)
    monkeypatch.setattr(D.Repetition, "candidates", few)
    index = D.Index(items, D.SHARE, D.RECALL)
    assert index.measured >= D.RECALL and len(index.repetitions) > D.MOST_REPETITIONS
    monkeypatch.setattr(D.Repetition, "candidates", lambda *given: tuple(x[:0] for x in plain(*given)))
    with pytest.raises(RuntimeError, match="asked for"):
        D.Index(items, D.SHARE, D.RECALL)


def test_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta"
    rows = [*enumerate(ODD_TEXTS), (20, f"x {item} y"), (20, f"x {item} y"), (None, item.upper()), (21, "!!! alpha")]
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "!!"), (None, "alpha beta gamma delta")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"], r["edits"]) for r in D.leaks(docs_frame(spark, rows), bench).collect()]
    want = [(d, i, 0) for d in (20, 20, None) for i in (1, 1, None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert D.leaks(docs_frame(spark, []), bench).count() == 0
    assert D.leaks(docs_frame(spark, rows), bench.filter("item_id = 99")).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(D, "ITEM_BLOCK", 2)
    rnd = random.Random(6)
    items = [(i, " ".join(text(rnd, 20))) for i in range(7)]
    got = D.leaks(docs_frame(spark, [(100 + i, t) for i, t in items]), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"] - 100, r["item_id"]) for r in got.collect()} == {(i, i) for i in range(7)}
