"""Operator 10: repeated substrings by recompression.

A window is ``window`` consecutive words of one document. A word is removed if a window covers it
whose words also start earlier (a smaller ``doc_id``, of equal ids a text of smaller hash, or the
same text further left).

Recompression names runs of equal words, then, round by round, the pairs of neighbouring symbols
whose first symbol falls in the left half of the alphabet and whose second falls in the right
half; the halves are drawn anew for each round by a hash. A name is a 64-bit hash of what it stands
for, so all tasks give a run or a pair the same name without asking each other. Each symbol also
carries the stretch of words that its existence depends on. Where equal words fill that stretch,
the same symbol arises, so equal substrings agree on their interior symbols. The number of rounds
is the largest for which every window of distinct neighbours holds such a symbol border.

Every window picks, of the borders that depend on its own words alone, the one of least key; equal
windows pick the same border. Neighbouring windows with the same border form a segment. Segments
are dealt by their border's key, so equal windows meet in one task, which compares them by their
64-bit hashes (of the key and 40 more bits) in (doc_id, text hash, start) order; their words are not
compared again. A window without such a border (inside
long runs of one word) is dealt by its own hash.

Volume: a task first drops segments that repeat within its own chunk of documents, so a passage
shared by very many documents brings one segment a chunk to its key's bucket. The dropped ones need
no comparison any more: their ranges are dealt evenly, by document and place. There are as many
buckets as the session's shuffle partitions, and more where ``BUCKET_BYTES`` of text a bucket ask for
more. All segments of a chunk and bucket travel as one packed row. A document's removed ranges then join its text by ``doc_id`` and the
text's hash, so ranges touch only the text in which they were found.

Defined cases: null text has no words; a null ``doc_id`` counts as smaller than all others; rows of
equal or null ids with different texts are different documents; rows of equal ``doc_id`` and text
count as one document (neither is earlier); fewer words than a window: nothing is removed; an empty table gives no rows. Other columns
pass through unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

WINDOW = 20
#: Words that a task takes at a time; documents are never split.
CHUNK_WORDS = 500_000
#: Bytes of text whose segments a task compares, on average.
BUCKET_BYTES = 8_000_000
NULL_DOC = -(2**63)
_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_MOST = ~np.uint64(0)


def name(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit name for each pair (a, b)."""
    b = np.atleast_1d(b)  # arrays wrap around, scalars would warn
    z = a * _C1 + (b ^ (b >> np.uint64(31))) * _C2
    z ^= z >> np.uint64(29)
    z *= _C3
    z ^= z >> np.uint64(32)
    return z


def rounds_for(window: int) -> int:
    """A symbol of round r has up to 2^r words and depends on up to 2^r - 1 more on either side; so
    many rounds leave a border that a window holds whole."""
    r = 0
    while 3 * 2 ** (r + 1) - 2 <= window:
        r += 1
    return r


def word_hashes(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, each document followed by a gap of hash 0; the place of each first word."""
    import xxhash

    known: dict[bytes, int] = {}
    at: list[int] = []
    for words in docs:
        for w in words:
            if w not in known:
                known[w] = len(known) + 1
        at += map(known.__getitem__, words)
        at.append(0)
    table = np.array([0, *(xxhash.xxh3_64_intdigest(w) | 1 for w in known)], np.uint64)
    sizes = np.fromiter(map(len, docs), np.int64, len(docs)) + 1
    return table[np.array(at, np.int64)], np.cumsum(sizes) - sizes


def borders(hashes: np.ndarray, rounds: int) -> tuple[np.ndarray, ...]:
    """Borders between the symbols of the last round: place, first and last-plus-one word that it
    depends on, and its key. Gaps end every symbol."""
    n = len(hashes)
    gap = hashes == 0
    new = np.ones(n, bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | gap[1:] | gap[:-1]
    begin = np.flatnonzero(new)
    size = np.diff(np.concatenate([begin, [n]]))
    sym = name(hashes[begin], size.astype(np.uint64))
    low, high, hole = begin - 1, begin + size + 1, gap[begin]
    for r in range(rounds):
        side = (name(sym, np.uint64(r + 1)) >> np.uint64(17)) & np.uint64(1) == 1
        joins = np.zeros(len(sym), bool)  # with the next symbol
        joins[:-1] = ~side[:-1] & side[1:] & ~hole[:-1] & ~hole[1:]
        second = np.concatenate([[False], joins[:-1]])
        if r == rounds - 1:
            right = np.flatnonzero(~second[1:] & ~hole[1:] & ~hole[:-1]) + 1
            left = right - 1
            at, lo, hi = begin[right], low[left], high[right]
            inside = (lo >= 0) & (hi <= n)
            left, right, at, lo, hi = (x[inside] for x in (left, right, at, lo, hi))
            key = name(name(sym[left], sym[right]), name(hashes[lo], hashes[hi - 1]))
            return at, lo, hi, np.minimum(key, _MOST - np.uint64(1))
        head = np.flatnonzero(~second)
        pair = joins[head]
        tail = head + pair
        merged = np.where(pair, name(sym[head], sym[np.minimum(head + 1, len(sym) - 1)]), sym[head])
        before, after = np.maximum(head - 1, 0), np.minimum(tail + 1, len(sym) - 1)
        low, high = np.minimum(low[before], low[head]), np.maximum(high[after], high[tail])
        begin, sym, hole = begin[head], merged, hole[head]
    none = np.zeros(0, np.int64)
    return none, none, none, np.zeros(0, np.uint64)


def window_hashes(hashes: np.ndarray, window: int) -> np.ndarray:
    """A hash of the ``window`` words from each place on."""
    out, taken, power, span = None, 0, hashes, 1
    while span <= window:
        if window & span:
            out = power if out is None else name(out[: len(power) - taken], power[taken:])
            taken += span
        span *= 2
        if span <= window:
            power = name(power[: len(power) - span // 2], power[span // 2 :])
    return out[: len(hashes) - window + 1]


def segments(hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows and key of every segment, and the hash of every window."""
    n = len(hashes) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    whole = window_hashes(hashes, window)
    gaps = np.concatenate([[0], np.cumsum(hashes == 0)])
    fits = gaps[window:] == gaps[:n]
    at, lo, hi, key = borders(hashes, rounds_for(window))
    prior = np.full(len(hashes), _MOST)
    prior[at] = key
    left, right = np.full(len(hashes), 255, np.uint8), np.full(len(hashes), 255, np.uint8)
    left[at], right[at] = np.minimum(at - lo, 255), np.minimum(hi - at, 255)
    best, pick = np.full(n, _MOST), np.full(n, -1, np.int64)
    for offset in range(1, window):
        here = slice(offset, offset + n)
        won = (left[here] <= offset) & (right[here] <= window - offset) & (prior[here] < best)
        best[won] = prior[here][won]
        pick[won] = np.flatnonzero(won) + offset
    alone = fits & (pick < 0)
    best[alone] = whole[alone]
    pick[alone] = -2 - np.flatnonzero(alone)
    head = fits.copy()
    head[1:] &= ~fits[:-1] | (pick[1:] != pick[:-1])
    first = np.flatnonzero(head)
    stop = np.flatnonzero(fits & np.concatenate([head[1:] | ~fits[1:], [True]])) + 1
    return first, stop - first, best[first], whole


def changes(doc: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Marks of the places where another document (id, text hash) begins."""
    return np.concatenate([np.ones(min(1, len(doc)), bool), (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])


def pack(key: np.ndarray, doc: np.ndarray, mark: np.ndarray, start: np.ndarray, count: np.ndarray, hashes: np.ndarray) -> bytes:
    """``count`` 0 - 127: windows whose hashes follow; 128 more: windows already known as repeats.
    ``doc`` and ``mark`` (the text's hash) are kept once for the neighbouring segments of a document."""
    heads = np.flatnonzero(changes(doc, mark))
    held = np.diff(np.concatenate([heads, [len(doc)]]))
    sizes = np.array([len(key), len(hashes), len(heads)], "<i8")
    low, high = hashes.astype("<u4"), (hashes >> np.uint64(32)).astype("u1")
    owners = (doc[heads].astype("<i8"), mark[heads].astype("<i8"), held.astype("<u4"))
    parts = (sizes, *owners, key.astype("<u8"), start.astype("<i4"), count.astype("u1"), low, high)
    return b"".join(p.tobytes() for p in parts)


def _fields(blob: bytes | memoryview) -> list[np.ndarray]:
    s, w, d = np.frombuffer(blob, "<i8", 3).tolist()
    out, at = [], 24
    for kind, size in (("<i8", d), ("<i8", d), ("<u4", d), ("<u8", s), ("<i4", s), ("u1", s), ("<u4", w), ("u1", w)):
        out.append(np.frombuffer(blob, kind, size, at))
        at += out[-1].nbytes
    return out


def unpack(blob: bytes | memoryview) -> tuple[np.ndarray, ...]:
    """Key, doc, start and count of each segment, and the hashes of its windows."""
    doc, _, held, key, start, count, low, high = _fields(blob)
    return key, np.repeat(doc, held), start, count, low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def marks(blob: bytes | memoryview) -> np.ndarray:
    """The hash of each segment's text."""
    _, mark, held, *_ = _fields(blob)
    return np.repeat(mark, held)


def chunk_rows(
    ids: np.ndarray, docs: list[list[bytes]], window: int, buckets: int, hashed: np.ndarray | None = None
) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed segments) of a chunk of documents; ``hashed`` are the hashes of their texts
    (not needed where no id is repeated)."""
    hashed = np.zeros(len(ids), np.int64) if hashed is None else hashed
    order = np.lexsort((hashed, ids))
    ids, hashed, docs = ids[order], hashed[order], [docs[i] for i in order]
    owner = np.cumsum(changes(ids, hashed))
    hashes, begins = word_hashes(docs)
    first, count, key, whole = segments(hashes, window)
    if not len(first):
        return
    home = np.searchsorted(begins, first, side="right") - 1
    start, doc, mark, own = first - begins[home], ids[home], hashed[home], owner[home]
    # Segments that repeat here: all but the first one are known repeats, whatever other tasks hold.
    sums = np.concatenate([[np.uint64(0)], np.cumsum(name(whole, np.uint64(7)))])
    full = name(name(sums[first + count] - sums[first], count.astype(np.uint64)), key)
    _, earliest, same = np.unique(full, return_index=True, return_inverse=True)
    earliest = earliest[same]
    known = (own != own[earliest]) | (start != start[earliest])
    drop = ~known & (earliest != np.arange(len(first)))  # the same place of a repeated row
    spread = name((doc ^ mark).astype(np.uint64), (start // 1024).astype(np.uint64))
    bucket = ((np.where(known, spread, key) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    turn = np.lexsort((first, bucket))
    turn = turn[~drop[turn]]
    first, count, key, doc, mark, start, known, bucket = (x[turn] for x in (first, count, key, doc, mark, start, known, bucket))
    sent = np.where(known, 0, count)
    ends = np.cumsum(sent)
    windows = whole[np.repeat(first - (ends - sent), sent) + np.arange(ends[-1])]
    count = count + 128 * known
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
        held = windows[ends[a] - sent[a] : ends[b - 1]]
        yield int(bucket[a]), pack(key[a:b], doc[a:b], mark[a:b], start[a:b], count[a:b], held)


def repeats(key: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray, hashes: np.ndarray) -> tuple:
    """(doc, start, number of windows) of the repeated windows among unpacked segments."""
    known = count >= 128
    ready = (doc[known], start[known].astype(np.int64), (count[known] - 128).astype(np.int64))
    key, doc, start, count = key[~known], doc[~known], start[~known].astype(np.int64), count[~known].astype(np.int64)
    ends = np.cumsum(count)
    if not len(ends):
        return ready
    seg = np.lexsort((start, doc))
    size = count[seg]
    step = np.arange(ends[-1]) - np.repeat(np.cumsum(size) - size, size)
    row = np.repeat(seg, size)
    place = start[row] + step
    owner = doc[row]
    order = np.lexsort((place, owner)) if len(np.unique(key)) < len(key) else np.arange(len(row))
    ident = name(key[row], hashes[(ends - count)[row] + step])
    row, place, owner, ident = row[order], place[order], owner[order], ident[order]
    turn = np.argsort(ident, kind="stable")  # (doc, start) order within equal windows
    sorted_ident = ident[turn]
    head = np.flatnonzero(np.concatenate([[True], sorted_ident[1:] != sorted_ident[:-1]]))
    lead = np.repeat(turn[head], np.diff(np.concatenate([head, [len(turn)]])))
    later = (owner[turn] != owner[lead]) | (place[turn] != place[lead])
    hit = np.sort(turn[later])
    if not len(hit):
        return ready
    owner, place = owner[hit], place[hit]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] > place[:-1] + 1)])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(place)]]) - 1
    found = (owner[at], place[at], place[last] - place[at] + 1)
    return tuple(np.concatenate(x) for x in zip(ready, found, strict=True))


def bucket_count(docs: DataFrame) -> int:
    """Buckets that segments are dealt to, from the bytes of ``docs``' texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def repeated_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, mark, start, words): ranges of words of ``docs`` covered by windows that start earlier
    elsewhere. ``doc`` is doc_id, with NULL_DOC for null; ``mark`` is the text's hash."""
    spark = docs.sparkSession
    common.prepare(spark)
    parts = bucket_count(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        hashed: list[int] = []
        held: list[list[bytes]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            made = list(chunk_rows(np.array(ids, np.int64), held, window, parts, np.array(hashed, np.int64)))
            columns = [pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "blob"])

        for batch in batches:
            keys = (batch.column("doc").to_pylist(), batch.column("mark").to_pylist())
            for doc, mark, text in zip(*keys, common.texts(batch), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space
                if len(words) < window:
                    continue
                ids.append(doc)
                hashed.append(mark)
                held.append(words)
                size += len(words)
                if size >= CHUNK_WORDS:
                    yield rows()
                    ids, hashed, held, size = [], [], [], 0
        if ids:
            yield rows()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [blob.as_buffer() for batch in batches for blob in batch.column("blob")]
        if blobs:
            key, doc, start, count, hashes = (np.concatenate(x) for x in zip(*map(unpack, blobs), strict=True))
            mark = np.concatenate([marks(b) for b in blobs])
            blobs.clear()
            order = np.lexsort((mark, doc))
            new = changes(doc[order], mark[order])
            place = np.empty(len(doc), np.int64)  # documents by their rank in (doc_id, text hash) order
            place[order] = np.cumsum(new) - 1
            docs, texts = doc[order][new], mark[order][new]
            place, start, count = repeats(key, place, start, count, hashes)
            columns = [pa.array(x, pa.int64()) for x in (docs[place], texts[place], start, count + window - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "mark", "start", "words"])

    segs = docs.select(*_identity(), "text")
    dealt = segs.mapInArrow(common.tidy(cut), "bucket int, blob binary").repartitionById(parts, "bucket")
    return dealt.mapInArrow(common.tidy(match), "doc long, mark long, start long, words long")


def _identity() -> tuple[F.Column, F.Column]:
    """What tells documents apart, as doc and mark: the id, and the text's hash."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)).alias("doc"), F.xxhash64("text").alias("mark")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` as struct ``row``, and n_words, n_removed, kept (the words that stay,
    joined by single spaces)."""
    ranges = repeated_ranges(docs, window).groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "words")).alias("cuts"))
    rows = docs.select(*_identity(), F.col("text").alias("body"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    joined = rows.join(ranges, ["doc", "mark"], "left").select("row", "body", "cuts.start", "cuts.words")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_words, n_removed = [], [], []
            lists = (batch.column("start").to_pylist(), batch.column("words").to_pylist())
            for text, starts, lengths in zip(common.texts(batch, "body"), *lists, strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if starts:
                    edge = np.zeros(len(words) + 1, np.int64)
                    a = np.minimum(starts, len(words))
                    np.add.at(edge, a, 1)
                    np.add.at(edge, np.minimum(a + np.array(lengths), len(words)), -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    n_removed.append(int(len(words) - stays.sum()))
                    words = list(compress(words, stays.tolist()))
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            columns = [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.string())], names=["row", "n_words", "n_removed", "kept"])

    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(common.tidy(drop), f"row {kind}, n_words long, n_removed long, kept string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    found = remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
