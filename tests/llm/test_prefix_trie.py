"""Operator 13: the trie against plain prefixes, rebuilt and as given, and the defined cases."""

import hashlib
import random
import re
import zlib

import pytest

from ledgerline.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, pos int, node string, least long"


def plain_sequences(rows):
    convs = {}
    for r in rows:
        if r["conv_id"] is not None:
            convs.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    digest = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(*t[1:])))
    return {c: [t[1:] for t in turns] for c, turns in convs.items()}


def plain_rebuilt(sequences):
    found = {}
    for c, own in sequences.items():
        h, head = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        found[c] = sequences.get(head, [])[:h] + own[h:]
    return found


def plain_trie(sequences):
    nodes, children = {}, {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums, found = {}, []
    for node in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [sums[k] for k in children.get(node, [])]
        sums[node] = (sum(s[0] for s in below) or int(not below), (len(nodes[node]) - 1) * words + sum(s[1] for s in below))
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(sequences[c]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        row = (min(members), len(node), parent, len(members), len(children.get(node, [])), *sums[node], hashlib.sha256(ends.encode()).hexdigest())
        found.append(row)
    return sorted(found, key=key)


def key(row):
    return tuple((x is not None, x) for x in row)


def both(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], SCHEMA)
    turns, ranges = P.numbered_turns(frame)
    counts = ranges.groupBy("conv_id").sum("n").toDF("conv_id", "n_turns")
    given = sorted((tuple(r) for r in P.trie(P.placed(turns, ranges), counts).collect()), key=key)
    rebuilt = sorted((tuple(r) for r in P.trie(*P.with_shared_heads(turns, ranges)).collect()), key=key)
    return given, rebuilt


def check(spark, rows):
    plain = plain_sequences([dict(zip(("conv_id", "turn", "role", "text"), r, strict=True)) for r in rows])
    assert both(spark, rows) == (plain_trie(plain), plain_trie(plain_rebuilt(plain)))


@pytest.mark.parametrize("block, bits", [(4, 10), (2, 1), (1, 0)])
def test_random_conversations(spark, monkeypatch, block, bits):
    monkeypatch.setattr(P, "BLOCK", block)
    monkeypatch.setattr(P, "RUN_BITS", bits)
    monkeypatch.setattr(P, "PIECE_BITS", bits)
    rnd = random.Random(block)
    rows = []
    for c in rnd.sample(range(0, 400), 90):
        length = rnd.choice([0, 1, 2, 3, 5, 8, 13])
        rows += [(c, t, "user" if t % 2 == 0 else "bot", rnd.choice(["a b", "a  b\n", "c"]) if rnd.random() < 0.9 else f"own {c}") for t in range(length)]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (0, None, "u", "first"), (0, 0, None, None), (0, 0, "", ""), (0, 5, "é 日", "x " * 50_000), (1, 1, "u", "tie b"), (1, 1, "u", "tie a"), (1, 1, "u", "tie a"),
        (None, 0, "u", "nobody"), (None, None, None, None), (2, 3, "u", "    x"), (-7, 0, "u", "first"), (-20, 0, "u", "head"), (-20, 1, "u", "head"), (23, 0, "u", ""),
    ]
    check(spark, rows)
    check(spark, [])
    check(spark, [(5, 0, "u", "t")] * 3)


def test_copies_and_one_long_conversation(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(0, 6000, 3) for t in range(3)]  # equal copies, in several pieces
    rows += [(100_000, t, "u", f"turn {t}" if t < 40 else f"{t}") for t in range(6000)]
    check(spark, rows)


def test_the_query_against_plain_prefixes(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    got = sorted((tuple(r) for r in P.op13_prefix_trie(spark, sf_dir).collect()), key=key)
    assert got == plain_trie(plain_rebuilt(plain_sequences(rows)))
