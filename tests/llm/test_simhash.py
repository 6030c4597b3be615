"""Operator 6 against all pairs."""

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_frame

from ledgerline.llm import simhash
from ledgerline.llm.components import local_components


def plain_print(text):
    import re

    import xxhash

    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes):
    label = list(range(len(codes)))
    for _ in codes:
        for i, a in enumerate(codes):
            for j, b in enumerate(codes):
                if (a ^ b).bit_count() <= 3:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_fingerprints():
    for text in [*ODD_TEXTS, "A b C", "a B c d a b c d", "Ünder DEN linden\x0bzwei drei"]:
        assert simhash.fingerprint(text or "") == plain_print(text)


@pytest.mark.parametrize("spread", [2, 6, 40])
def test_index_finds_all_links(spread):
    rng = np.random.default_rng(spread)
    seeds = rng.integers(0, 2**63, 15, dtype=np.uint64)
    codes = np.unique(
        [s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, spread), replace=False))) for s in seeds for _ in range(12)]
    )
    u, v = simhash.gray_links(codes, np.zeros(len(codes), np.int64), 3)
    
    assert local_components(len(codes), u, v).tolist() == plain_components([int(c) for c in codes])


@pytest.mark.parametrize("group", [50_000, 3])
def test_links_across_blocks(spark, group):
    rng = np.random.default_rng(5)
    near = [int(rng.integers(0, 2**63))]
    for _ in range(40):  # a chain, and strays
        near.append(near[-1] ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)))
    codes = sorted({*near, *(int(x) for x in rng.integers(0, 2**63, 40))})
    frame = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "fp long")
    signed = {int(np.uint64(c).astype(np.int64)): i for i, c in enumerate(codes)}
    found = simhash.links(frame, group=group).collect()
    u = np.array([signed[r["u"]] for r in found], int)
    v = np.array([signed[r["v"]] for r in found], int)
    assert local_components(len(codes), u, v).tolist() == plain_components(codes)


def test_components_of_odd_rows(spark):
    body = "one two three four five six seven eight nine ten"
    rows = [(9, body), (4, body.upper()), (7, body), (7, body), (None, body), (5, None), (2, ""), (8, "other words entirely here")]
    rows += [(20 + i, t) for i, t in enumerate(ODD_TEXTS[6:])]
    got = simhash.near_duplicates(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r["component_id"] for r in got}
    assert by_id[9] == by_id[7] == by_id[None] == 4 and by_id[5] == by_id[2] == 2 and by_id[8] == 8
    assert simhash.near_duplicates(docs_frame(spark, [])).count() == 0


def test_one_of_each(spark):
    body = "one two three four five six seven eight nine ten"
    rows = [(9, body), (4, body), (4, body), (None, body), (8, "other words entirely here"), (8, "quite different text stands here")]
    rows += [(None, "nobody knows this id"), (None, "nobody knows this id")]
    kept = simhash.one_of_each(docs_frame(spark, rows))
    assert kept.columns == docs_frame(spark, []).columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([rows[1], rows[4], rows[5], rows[6]], key=str)
