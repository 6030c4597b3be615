"""Operator 6: SimHash near-duplicates through a Gray-order hierarchical index.

A document's fingerprint has the bits that are set in over half of its shingles' hashes. Two
fingerprints link at ``max_bits`` or fewer differing bits; the operator returns each document's
component under these links.

Search. Links of at most 3 bits leave one of four 16-bit blocks unchanged, so every distinct
fingerprint is dealt to one group for each block, by the block's value. A block value shared by
more than ``GROUP`` fingerprints is dealt once more by the four parts of the other 48 bits; the
list of such values has at most 4 x 65,536 rows whatever the input. Inside a task all groups form
one index: codes are sorted by group and Gray rank, so that neighbours share most bits. Each node
over ``FANOUT`` children keeps the bits that all its codes share, as mask and pattern. A search
descends pairs of nodes, adds the differences in the bits that become shared at each level, and
drops a whole pair of nodes once the sum exceeds ``max_bits``. What reaches the leaves is compared
in full. Each task reduces its links to a spanning forest before it returns them, so a dense group
returns at most one link for each code.

Defined cases: null or wordless text has fingerprint 0, linked like any other; a null ``doc_id``
joins its component but is never its id (a component of only such rows has a null id); repeated
rows and equal texts share a fingerprint and so a component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common
from ledgerline.llm.components import connected_components, local_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
FANOUT = 4
#: A block value with more fingerprints than this is dealt again by a second block.
GROUP = 50_000
#: Codes searched at a time by a task, and pairs of nodes expanded at a time.
CHUNK = 200_000
PAIRS = 1_000_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint as a signed long) for every row of ``docs``."""
    common.prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in common.texts(batch)], np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    needed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return needed.mapInArrow(common.tidy(run), "doc_id long, text_hash long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order: the binary number whose Gray code it is."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def gray_links(codes: np.ndarray, groups: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as index pairs, of all links within each group of ``codes``."""
    order = np.lexsort((gray_rank(codes), groups))
    code, group = codes[order], groups[order]
    n = len(code)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([first, [n]]))

    # Levels of the index from the leaves up; a node never spans two groups.
    masks, patterns, children = [np.full(n, ~np.uint64(0))], [code], []
    both, some, heads, counts = code, code, first, sizes
    while counts.max() > 1:
        upper = -(-counts // FANOUT)
        begins = np.concatenate([[0], np.cumsum(upper)])
        local = np.arange(begins[-1]) - np.repeat(begins[:-1], upper)
        start = np.repeat(heads, upper) + FANOUT * local
        stop = np.minimum(start + FANOUT, np.repeat(heads + counts, upper))
        children.append((start, stop))
        both, some = np.bitwise_and.reduceat(both, start), np.bitwise_or.reduceat(some, start)
        masks.append(~(both ^ some))
        patterns.append(both & masks[-1])
        heads, counts = begins[:-1], upper

    roots = np.arange(len(heads))[sizes > 1]
    zero = np.zeros(len(roots), np.int64)
    work = [(len(children), heads[roots], heads[roots], zero, np.zeros(len(roots), np.uint64))]
    left, right, held = none, none, []
    while work:
        level, a, b, acc, known = work.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            work += [(level, *(x[:half] for x in (a, b, acc, known))), (level, *(x[half:] for x in (a, b, acc, known)))]
            continue
        shared = masks[level][a] & masks[level][b]
        fresh = (patterns[level][a] ^ patterns[level][b]) & shared & ~known
        acc = acc + np.bitwise_count(fresh)
        keep = acc <= max_bits  # whole groups of codes go here
        a, b, acc, shared = a[keep], b[keep], acc[keep], shared[keep]
        if not len(a):
            continue
        if level == 0:
            held.append((a, b))
            if sum(len(x) for x, _ in held) > 4 * PAIRS:
                left, right = _forest(n, [(left, right), *held])
                held = []
            continue
        start, stop = children[level - 1]
        pieces = []
        for i in range(FANOUT):
            for j in range(FANOUT):
                x, y = start[a] + i, start[b] + j
                fits = (x < stop[a]) & (y < stop[b]) & ((a != b) | (x < y) | ((x == y) & (level > 1)))
                pieces.append((x[fits], y[fits], acc[fits], shared[fits]))
        work.append((level - 1, *(np.concatenate(p) for p in zip(*pieces, strict=True))))
    left, right = _forest(n, [(left, right), *held])
    return order[left], order[right]


def _forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    label = local_components(n, np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
    child = np.flatnonzero(label != np.arange(n))
    return child, label[child]


def _bits(column: str, high: int, low: int) -> str:
    """SQL for bits ``low`` to ``high`` (exclusive) of a long."""
    return f"(shiftrightunsigned({column}, {low}) & {(1 << (high - low)) - 1}L)"


def links(fps: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """(u, v) over distinct fingerprints ``fps`` (fp): links within ``max_bits`` bits that connect
    the same fingerprints as all such links do."""
    cuts = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    blocks = ", ".join(
        f"struct({i} as j, {_bits('fp', cuts[i + 1], cuts[i])} as value)" for i in range(max_bits + 1)
    )
    dealt = fps.selectExpr("fp", f"inline(array({blocks}))")
    # At most (max_bits + 1) x 2^(64 / (max_bits + 1)) rows: bounded by the code, not by the data.
    hot = dealt.groupBy("j", "value").count().filter(F.col("count") > group).select("j", "value", F.lit(True).alias("hot"))
    # The other bits, moved together: the block is rotated out, so they are bits 0 to 64 - width.
    widths = "array(" + ", ".join(f"{cuts[i + 1] - cuts[i]}" for i in range(max_bits + 1)) + ")"
    lows = "array(" + ", ".join(str(c) for c in cuts[:-1]) + ")"
    parts = max_bits + 1
    dealt = dealt.join(F.broadcast(hot), ["j", "value"], "left").selectExpr(
        "fp",
        "j",
        "value",
        "hot",
        f"element_at({widths}, j + 1) as width",
        f"shiftrightunsigned(fp, element_at({lows}, j + 1) + element_at({widths}, j + 1)) as above",
        f"element_at({lows}, j + 1) as low",
    )
    rest = (
        "(case when low + width < 64 then shiftleft(above, low) else 0L end)"
        " | (case when low > 0 then fp & (shiftleft(1L, low) - 1L) else 0L end)"
    )
    sub = f"(64 - width + {parts - 1}) div {parts}"  # width of each part of the other bits
    dealt = dealt.selectExpr("fp", "j", "value", "hot", f"{rest} as rest", f"cast({sub} as int) as sub")
    again = ", ".join(
        f"struct({i} as k, shiftrightunsigned(rest, {i} * sub) & (shiftleft(1L, sub) - 1L) as part)" for i in range(parts)
    )
    dealt = dealt.selectExpr(
        "fp", "j", "value", f"inline(case when hot then array({again}) else array(struct(-1 as k, 0L as part)) end)"
    )
    keys = ["j", "value", "k", "part"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(code: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
            u, v = gray_links(code.view(np.uint64), group, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(code[u]), pa.array(code[v])], names=["u", "v"])

        codes, rows, size = [], [], 0
        for batch in batches:
            codes.append(batch.column("fp").to_numpy())
            rows.append(np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys], axis=1))
            size += len(codes[-1])
            if size >= CHUNK:
                code, key = np.concatenate(codes), np.concatenate(rows)
                new = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
                cut = np.flatnonzero(new)[-1]  # the last group may go on in the next batch
                if cut:
                    yield found(code[:cut], np.cumsum(new)[:cut])
                codes, rows, size = [code[cut:]], [key[cut:]], len(code) - cut
        if size:
            code, key = np.concatenate(codes), np.concatenate(rows)
            yield found(code, np.cumsum(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])))

    return dealt.mapInArrow(common.tidy(run), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp (long), root (the component's smallest fp) and component_id (its
    smallest doc_id) for every row of ``docs``."""
    prints = common.materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(nodes.select("fp"), max_bits)).withColumnRenamed("u", "fp")
    linked = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = linked.join(roots.select("root").distinct(), "root", "left_semi")
    smallest = smallest.groupBy("root").agg(F.min("first").alias("least"))
    least = F.coalesce("least", "first").alias("component_id")
    classes = linked.join(smallest, "root", "left").select("fp", "root", least)
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without their near-duplicates: of each component the document of
    smallest doc_id stays (of one id, the text of least hash; of rows without any id, likewise).
    What goes is written first, so where it is small Spark moves no text."""
    classes = common.materialize(near_duplicates(docs, shingle, max_bits), "classes")
    place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), F.col("text_hash").alias("h"))
    rows = classes.select("doc_id", "text_hash", "root", place.alias("place"))
    first = rows.groupBy("root").agg(F.min("place").alias("first"))
    gone = rows.join(first, "root").filter("place <> first").select("doc_id", "text_hash").distinct()
    gone = common.materialize(gone, "near-duplicates")
    again = classes.groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", "text_hash")
    again = common.materialize(again, "repeated-rows")

    def keyed(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        hit = rows["doc_id"].cast("long").eqNullSafe(keys["doc_id"]) & (F.xxhash64(rows["text"]) == keys["text_hash"])
        return rows.join(keys, hit, how)

    kept = keyed(gone, "left_anti", docs)
    twice = keyed(again, "left_semi", kept).dropDuplicates(["doc_id", "text"])
    return keyed(again, "left_anti", kept).unionByName(twice)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
