"""Operator 12: the manifest against a plain tree, at several widths, and the defined cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle as M

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, tree int, step int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"] if row["n_chars"] is None else row["n_chars"] + more, row["text"]]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    trees = [plain_levels([plain_leaf(r) for r in groups[g]]) for g in langs]
    top = plain_levels([t[-1][0] for t in trees])
    found = []
    for t, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node, siblings = plain_leaf(r, int(bad)), []
            for levels, place in ((trees[t], i), (top, t)):
                for level in levels[:-1]:
                    pair = level[place - place % 2 : place - place % 2 + 2]
                    siblings += [x for k, x in enumerate(pair) if k != place % 2]
                    node = digest(*(node if k == place % 2 else x for k, x in enumerate(pair)))
                    place //= 2
            found.append((r["doc_id"], plain_leaf(r), trees[t][-1][0], top[-1][0], digest(*siblings), node, node == top[-1][0]))
    return found


def key(row):
    return tuple((x is not None, x) for x in row)


def narrow(monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "RUN", 1 << levels)


@pytest.mark.parametrize("levels", [8, 2])
def test_the_query_against_a_plain_tree(spark, monkeypatch, levels):
    narrow(monkeypatch, levels)
    want = plain_manifest(spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = [tuple(r) for r in M.op12_merkle(spark, SF).collect()]
    assert sorted(got) == sorted(want)
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(spark, monkeypatch):
    narrow(monkeypatch, 1)  # many passes on few rows
    rows = [
        (1, None, None, None, None), (None, "s", None, 3, "abc"), (None, "s", "en", 3, "abc"), (None, "s", "en", 3, "abc"), (7, "", "", 0, ""), (7, "é", "é", 9, "日本"),
        (3, "-", "en", 5, "x" * 200_000), (3, "-", "en", 5, "y"), (-4, "a", "en", 1, "a"), (14, "a", "en", None, "a"), (14, "a", "en", None, "a"),
    ]
    rows += [(i, "s", "de", i, str(i)) for i in range(13)]
    frame = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    bad = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, M.leaf(n_chars=F.col("n_chars") + 1))
    got = sorted((tuple(r) for r in M.manifest(frame, bad).collect()), key=key)
    assert got == sorted(plain_manifest(frame.collect()), key=key)
    for few in (0, 1):
        part = frame.limit(few)
        assert sorted(tuple(r) for r in M.manifest(part, bad).collect()) == sorted(plain_manifest(part.collect()))


def test_one_group_and_many_groups(spark, monkeypatch):
    narrow(monkeypatch, 2)
    for groups in (1, 40):
        frame = spark.range(90).selectExpr("id AS doc_id", "'s' AS source", f"concat('l', id % {groups}) AS lang", "id AS n_chars", "cast(id AS string) AS text")
        got = [tuple(r) for r in M.manifest(frame, F.lit(None).cast("binary")).collect()]
        want = [(*r[:5], r[3], True) for r in plain_manifest(frame.collect())]
        assert sorted(got) == sorted(want)
