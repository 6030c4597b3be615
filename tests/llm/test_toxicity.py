"""Operator 2: the kernel against its definition, gapped insults, held-out accuracy, defined cases."""

from itertools import combinations

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_frame
from pyspark.sql import functions as F

from ledgerline.llm import toxicity

SMALL = "/root/testdata/sf0.01"


def plain_kernel(a, b, order, decay):
    def spans(word):
        for places in combinations(range(len(word)), order):
            yield "".join(word[i] for i in places), decay ** (places[-1] - places[0] + 1)

    return sum(x * y for u, x in spans(a) for v, y in spans(b) if u == v)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_kernel_is_the_sum_over_subsequences(order):
    rng = np.random.default_rng(order)
    left = ["".join(rng.choice(list("abcd"), rng.integers(1, 8))) for _ in range(30)]
    right = ["".join(rng.choice(list("abcd"), rng.integers(1, 8))) for _ in range(30)]
    got = toxicity.kernel(toxicity.letters(left)[0], toxicity.letters(right)[0], order, 0.6)
    want = [plain_kernel(a, b, order, 0.6) for a, b in zip(left, right, strict=True)]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-7)


def test_units_see_through_marks_and_gaps():
    table = toxicity.Units()
    table.read(["You M.O.R.O.N and st-up-id 1d1ot5 id1ot 12 !!", "a w o r t h l e s s one"])
    assert {"moron", "stupid", "idiot", "aworthless"} <= set(table.held)
    assert "" not in table.held
    table = toxicity.Units()
    at, home = table.read(["x" * 5_000, "a b " * 5_000])
    assert max(map(len, table.held)) <= toxicity.LONG and set(home.tolist()) == {0, 1}


def test_inserted_letters_stay_near():
    marks = toxicity.Landmarks(["idiot", "worthless"])
    names = ["idiot", "idxiot", "idiiot", "worthxless", "table"]
    who, which, value = marks.values(names)
    near = {(names[a], marks.names[b]): v for a, b, v in zip(who, which, value, strict=True)}
    assert near["idiot", "idiot"] == pytest.approx(1, rel=1e-3)
    assert near["idxiot", "idiot"] > 0.2 and near["worthxless", "worthless"] > 0.2
    assert ("table", "idiot") not in near


def test_held_out_accuracy_and_obfuscated_insults(spark):
    found = toxicity.op2_toxicity(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p"), F.count(F.lit(1)).alias("n"))
    share = {r["toxic"]: r["p"] for r in rows.collect()}
    assert share[1] > 0.7 and share[0] < 0.03
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.fit(docs, labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    clean = "the thing was on the whole of that and it is in by with to for"
    bad = [clean, f"{clean} i.d.i.o.t", f"{clean} w o r t h l e s s", f"{clean} m0r0n"]
    got = toxicity.score(docs_frame(spark, list(enumerate(bad))), model, ["doc_id"]).select("row.doc_id", "score")
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    assert scores[0] < 0.2 and all(scores[i] > 3 * scores[0] for i in (1, 2, 3))


def test_odd_rows_and_missing_classes(spark):
    rows = [*enumerate(ODD_TEXTS), (3, "again idiot"), (None, "no id")]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] + [(3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    for given, constant in ((labels, None), (labels.filter("toxic = 0"), 0.0), (labels.filter("toxic = 1"), 1.0), (labels.limit(0), 0.0)):
        model = toxicity.fit(docs, given)
        scored = toxicity.score(docs, model, docs.columns)
        got = scored.select("row.*", F.col("score").alias("found")).collect()
        assert len(got) == len(rows) and got[0].asDict().keys() == {*docs.columns, "found"}
        assert all(0 <= r["found"] <= 1 for r in got)
        if constant is not None:
            assert {r["found"] for r in got} == {constant}
    empty = docs_frame(spark, [])
    assert toxicity.score(empty, toxicity.fit(empty, labels), ["doc_id"]).count() == 0


def test_the_fit_is_bounded_in_rows(spark, monkeypatch):
    from ledgerline.llm import common

    seen, plain = [], common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, name: seen.append(plain(df, name)) or seen[-1])
    rows = [(1, f"text {i % 9}") for i in range(2000)] + [(i, "you idiot" if i % 2 else "good day") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, fit_rows=10)
    toxicity.fit(docs, labels, fit_rows=39)
    assert [s.count() for s in seen] == [10, 39]
