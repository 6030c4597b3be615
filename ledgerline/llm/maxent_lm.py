"""Operator 8: language-model scores by a hashed maximum-entropy model.

Tokens are the words of the lower-cased (A-Z) text and one end. The softmax is factored by class:

    P(w | context) = P(class(w) | context) * P(member(w) | class(w), context) * p(w) / p(member(w))

``p`` is the smoothed unigram distribution of the training tokens (count + 0.1 over their sum).
Classes are the end, the ``TOP_WORDS`` most frequent words one by one, the other words by a hash of
their last letters, and one class for all words never seen. A class of last letters has ``MEMBERS``
members: its most frequent words one by one, and all its other words as the last member, inside which the
unigram shares hold. The other classes have one member. Both factors are softmaxes over sums of weight
rows, one row for each feature of the context, found by hashing. Features of the class: the last word,
the last two words, the word before the last (a skip), the classes of the last two, and the class
of the third last (a skip). Features of the member: the last two words, and the last word, each with the class.
Without weights the factors equal ``p(class)`` and ``p(member) / p(class)``, so the model starts at the
unigram base and its probabilities sum to one.

Training is distributed gradient descent. In each round every task starts from the shared weights,
makes sparse gradient steps over mini-batches of its own training documents (each step along all
features of every token), and returns its weights in blocks; Spark sums them, first in ``FANIN`` parts and then over these, and the mean by
tokens is the next round's start. The weights' size is a parameter. The counts grow with the
corpus and stay in Spark: each task gets the ``KNOWN`` most frequent words (a bounded table), and
all other words of a document are joined to the counts by word.

Defined cases: null text is empty (one token, the end); a null doc_id is held out; without training
rows no token is known and the score is the base; repeated rows are scored one by one; an empty
table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

FOLDS = 10
SMOOTH = 0.1
END = b"\n"  # no word holds white space
TOP_WORDS = 40
SUFFIX_CLASSES = 22
SUFFIX_BYTES = 3
CLASSES = 1 + TOP_WORDS + SUFFIX_CLASSES + 1
UNSEEN = CLASSES - 1
START = CLASSES  # the class before a text's first word, in features only
MEMBERS = CLASSES  # so one table holds the weight rows of both factors
OTHERS = MEMBERS - 1  # the member of all words of a class that are no member alone
KNOWN = 200_000
ROUNDS = 1
RATE = 0.25
BATCH = 8192
SLICE = 2048  # tokens whose energies are taken at a time: few enough for a core's cache
BLOCK_ROWS = 2048
FANIN = 16
FEW = 32
PAD = 16  # keeps the lines of a column from sharing a few places of the cache
FAR = 60  # e ** -FAR is far above the least float
CHUNK_WORDS = 1_000_000
COUNT_WORDS = 400_000
COUNT_BYTES = 16 << 20
PAIR_BITS = 13
WORD_ROWS, PAIR_ROWS = 4096, 1 << PAIR_BITS  # powers of two
_SIZES = (WORD_ROWS, PAIR_ROWS, WORD_ROWS, (CLASSES + 1) ** 2, CLASSES + 1)  # features of the class
_MEMBER_SIZES = (PAIR_ROWS, PAIR_ROWS)  # features of the member
_BASES = np.concatenate([[0], np.cumsum(_SIZES + _MEMBER_SIZES)])
ROWS = int(_BASES[-1])
_MIX = np.uint64(0x165667B19E3779F9)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only


def split(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """What ``words`` gives for each of ``texts``: all their words in one array, and the number of each text's."""
    coded = pa.array([text.encode("utf-8", "surrogatepass") for text in texts], pa.large_binary())
    found = pc.ascii_split_whitespace(pc.ascii_lower(coded.view(pa.large_string())))  # A-Z and ASCII space only
    sizes = np.diff(found.offsets.to_numpy())
    flat = found.flatten()
    full = pc.binary_length(flat).to_numpy() > 0  # white space at an end of a text leaves an empty string
    if not full.all():
        sizes = np.bincount(np.repeat(np.arange(len(texts)), sizes)[full], minlength=len(texts))
        flat = flat.filter(pa.array(full))
    return flat.view(pa.large_binary()), sizes


def word_counts(docs: DataFrame) -> DataFrame:
    """word (binary), c: occurrences of every token in ``docs`` (text), ends included."""
    common.prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        fresh: list[pa.Array] = []
        size = 0

        def fold() -> None:
            new = pa.chunked_array(fresh, pa.large_binary()).value_counts()
            found = new.field("values").to_numpy(zero_copy_only=False).tolist()
            for word, n in zip(found, new.field("counts").to_numpy().tolist(), strict=True):
                counts[word] = counts.get(word, 0) + n
            fresh.clear()

        def rows() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            fresh.append(split(common.texts(batch))[0])
            counts[END] = counts.get(END, 0) + batch.num_rows
            size += fresh[-1].nbytes
            if size > COUNT_BYTES:
                fold()
                size = 0
                if len(counts) > COUNT_WORDS:
                    yield rows()
                    counts.clear()
        fold()
        yield rows()

    counted = docs.select("text").mapInArrow(count, "word binary, n long")
    return counted.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Unigrams:
    """What tasks know of the counts: totals, the shares of classes and members, and the most frequent words."""

    tokens: int
    distinct: int
    top: dict[bytes, int]  # class of the most frequent words and of the end
    known: dict[bytes, int]  # count of the KNOWN most frequent words
    class_log: np.ndarray  # natural log of p(class)
    member: dict[bytes, int]  # place in its class of each word that is a member alone
    member_log: np.ndarray  # natural log of p(member) / p(class), for each class of last letters

    @property
    def norm(self) -> float:
        return self.tokens + SMOOTH * (self.distinct + 1)


def suffix_class(word: bytes) -> int:
    return 1 + TOP_WORDS + zlib.crc32(word[-SUFFIX_BYTES:]) % SUFFIX_CLASSES


def unigrams(counts: DataFrame) -> Unigrams:
    sizes = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ranked = counts.orderBy(F.desc("c"), "word").limit(KNOWN).collect()  # KNOWN words: bounded
    known = {bytes(r["word"]): r["c"] for r in ranked}
    frequent = [w for w in known if w != END][:TOP_WORDS]
    top = {END: 0} | {w: i + 1 for i, w in enumerate(frequent)}
    tail = F.when(F.octet_length("word") > SUFFIX_BYTES, F.expr(f"substring(word, -{SUFFIX_BYTES})")).otherwise(F.col("word"))
    others = counts.filter(~F.col("word").isin([bytearray(w) for w in top]))
    sums = others.groupBy((F.crc32(tail) % SUFFIX_CLASSES).alias("k")).agg((F.sum("c") + SMOOTH * F.count(F.lit(1))).alias("m"))
    mass = np.full(CLASSES, 1e-6)  # a class without words: hardly any
    for w, k in top.items():
        if w in known:
            mass[k] = known[w] + SMOOTH
    if END not in known:  # it is rare where texts are very long
        row = counts.filter(F.col("word") == F.lit(bytearray(END))).first()
        mass[0] = (row["c"] if row else 0) + SMOOTH
    for r in sums.collect():
        mass[1 + TOP_WORDS + r["k"]] = r["m"]
    mass[UNSEEN] = SMOOTH
    member: dict[bytes, int] = {}
    share, taken = np.full((SUFFIX_CLASSES, MEMBERS), 1e-6), [0] * SUFFIX_CLASSES  # a member without words: hardly any
    for w, c in known.items():  # most frequent first
        k = suffix_class(w) - 1 - TOP_WORDS
        if w not in top and taken[k] < OTHERS:
            member[w] = taken[k]
            share[k, taken[k]] = c + SMOOTH
            taken[k] += 1
    rest = mass[1 + TOP_WORDS : UNSEEN] - share[:, :OTHERS].sum(axis=1)
    share[:, OTHERS] = np.maximum(rest, 1e-6)
    member_log = np.log(share / share.sum(axis=1, keepdims=True))
    return Unigrams(sizes["n"], sizes["v"], top, known, np.log(mass / mass.sum()), member, member_log)


class Reader:
    """Documents as arrays: of each token its word, its class and its context's weight rows."""

    def __init__(self, base: Unigrams):
        self.base = base

    def read(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words, and for each token its word, its text, its class, its weight rows."""
        flat, sizes = split(texts)
        numbered = flat.dictionary_encode()
        names = [END, *numbered.dictionary.to_numpy(zero_copy_only=False).tolist()]
        home = np.repeat(np.arange(len(texts)), sizes + 1)
        inner = np.ones(len(home), bool)
        inner[np.cumsum(sizes + 1) - 1] = False
        word = np.zeros(len(home), np.int64)  # an end is 0
        word[inner] = numbered.indices.to_numpy() + 1
        top = self.base.top
        tails = [w[-SUFFIX_BYTES:] for w in names]
        suffix = {t: suffix_class(t) for t in set(tails)}
        kind = np.array([top[w] if w in top else suffix[t] for w, t in zip(names, tails, strict=True)], np.int64)
        code = np.fromiter(map(zlib.crc32, names), np.uint64, len(names))[word]
        classes = kind[word]
        back = [self._back(code, home, k, 1) for k in (1, 2)]
        kinds = [self._back(classes, home, k, START) for k in (1, 2, 3)]
        pair = back[0] * np.uint64(0x9E3779B97F4A7C15) ^ back[1] * np.uint64(0xC2B2AE3D27D4EB4F)
        rows = np.empty((len(_SIZES), len(word)), np.int64).T  # a feature's rows lie together
        rows[:, 0] = back[0] & np.uint64(WORD_ROWS - 1)
        rows[:, 1] = pair >> np.uint64(64 - PAIR_BITS)
        rows[:, 2] = back[1] & np.uint64(WORD_ROWS - 1)
        rows[:, 3] = kinds[0] * (CLASSES + 1) + kinds[1]
        rows[:, 4] = kinds[2]
        rows += _BASES[: len(_SIZES)]
        return names, word, home, classes, rows

    def members(self, names: list[bytes], word: np.ndarray, home: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of what ``read`` gave, the tokens whose class has members: their places, the words' classes (from 0), the
        words' members, and the weight rows."""
        at = np.flatnonzero((classes > TOP_WORDS) & (classes < UNSEEN))
        code = np.fromiter(map(zlib.crc32, names), np.uint64, len(names))[word]
        place = np.array([self.base.member.get(w, OTHERS) for w in names], np.int64)[word[at]]
        kind = classes[at] - 1 - TOP_WORDS
        last, before = (self._back(code, home, k, 1)[at] for k in (1, 2))
        single = (last + _MIX * kind.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        pair = (single ^ before * np.uint64(0xC2B2AE3D27D4EB4F)) * _MIX
        rows = np.empty((len(_MEMBER_SIZES), len(at)), np.int64).T
        rows[:, 0] = pair >> np.uint64(64 - PAIR_BITS)
        rows[:, 1] = single >> np.uint64(64 - PAIR_BITS)
        rows += _BASES[len(_SIZES) : -1]
        return at, kind, place, rows

    @staticmethod
    def _back(values: np.ndarray, home: np.ndarray, k: int, start: int) -> np.ndarray:
        """The value ``k`` tokens earlier in the same text, ``start`` before its first."""
        out = np.full_like(values, start)
        before = max(0, len(home) - k)
        np.copyto(out[k:], values[:before], where=home[k:] == home[:before])
        return out


def energies(weights: np.ndarray, prior: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log of a softmax in each token's context, up to a constant a token (that is small enough to take powers of).
    ``prior`` holds what the logs are without weights, for all tokens or for each of them."""
    z = np.take(weights, rows[:, 0], axis=0, mode="clip")
    more = np.empty_like(z)
    for f in range(1, rows.shape[1]):
        z += np.take(weights, rows[:, f], axis=0, mode="clip", out=more)
    z += prior.astype(np.float32, copy=False)
    top = z.max(initial=0)
    if z[:, 1].min(initial=top) > top - FAR:  # no token's largest is far below the batch's
        z -= top
    else:
        z -= z.max(axis=1, keepdims=True)
    return z


def totals(powers: np.ndarray) -> np.ndarray:
    """The sum of each row."""
    return powers @ np.ones(powers.shape[1], powers.dtype)


def class_logs(weights: np.ndarray, base: Unigrams, rows: np.ndarray) -> np.ndarray:
    """Natural log of P(class | context) of each token's context."""
    z = energies(weights, base.class_log, rows)
    z -= np.log(totals(np.exp(z)))[:, None]
    return z


def member_gains(weights: np.ndarray, base: Unigrams, kind: np.ndarray, place: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Natural log of P(member | class, context) over p(member) / p(class), of each of the tokens that ``Reader.members`` gave."""
    gains = np.empty(len(kind))
    logs = base.member_log.astype(np.float32)
    for i in range(0, len(kind), SLICE):
        part = slice(i, i + SLICE)
        prior = logs[kind[part]]
        z = energies(weights, prior, rows[part])
        mine = (np.arange(len(z)), place[part])
        own = z[mine] - prior[mine]
        gains[part] = own - np.log(totals(np.exp(z, out=z)))
    return gains


def row_sums(rows: np.ndarray, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows`` (of one feature, so few enough to sort as 16 bits), and each one's sum of ``slope``. Rows
    of up to FEW tokens are summed together, a token of each at a time, those of most tokens first, so that the rows
    still open are always the first ones; the others one by one, in one go where they are most."""
    order = np.argsort((rows - rows.min()).astype(np.uint16), kind="stable")  # a radix sort
    line = rows[order]
    heads = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    if len(heads) * FEW < len(line):
        apart = np.empty((len(line), slope.shape[1] + PAD), slope.dtype)[:, : slope.shape[1]]
        apart[:] = np.take(slope, order, axis=0, mode="clip")
        return line[heads], np.add.reduceat(apart, heads, axis=0)
    sizes = np.diff(heads, append=len(line))
    by = np.argsort(-sizes, kind="stable")
    first, many = heads[by], int(np.count_nonzero(sizes > FEW))
    found = np.empty((len(heads), slope.shape[1]), slope.dtype)
    for i, (h, n) in enumerate(zip(first[:many].tolist(), sizes[by[:many]].tolist(), strict=True)):
        np.add.reduce(np.take(slope, order[h : h + n], axis=0, mode="clip"), axis=0, out=found[i])
    few, more = found[many:], np.empty_like(found[many:])
    np.take(slope, order[first[many:]], axis=0, mode="clip", out=few)
    for k in range(1, FEW):
        left = int(np.count_nonzero(sizes > k)) - many
        if not left:
            break
        few[:left] += np.take(slope, order[first[many : many + left] + k], axis=0, mode="clip", out=more[:left])
    sums = np.empty_like(found)
    sums[by] = found
    return line[heads], sums


def descend(weights: np.ndarray, power: np.ndarray, prior: np.ndarray, rows: np.ndarray, right: np.ndarray) -> None:
    """One mini-batch step with per-row adaptive rates, on all rows that the batch uses. ``right`` are the classes, or
    the members, that the tokens have."""
    slope = np.empty((len(rows), weights.shape[1]), np.float32)
    for i in range(0, len(rows), SLICE):
        part = slice(i, i + SLICE)
        raised = energies(weights, prior if prior.ndim == 1 else prior[part], rows[part])
        np.exp(raised, out=raised)
        np.divide(raised, totals(raised)[:, None], out=slope[part])
    slope[np.arange(len(right)), right] -= 1
    for f in range(rows.shape[1]):
        used, grad = row_sums(rows[:, f], slope)
        force = power[used] + np.einsum("ij,ij->i", grad, grad)
        power[used] = force
        grad *= (-RATE / np.sqrt(force + 1))[:, None]
        grad += np.take(weights, used, axis=0, mode="clip")
        weights[used] = grad


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), common.texts(batch), strict=True):
            ids.append(doc)
            texts.append(text)
            size += len(text) // 6 + 1
            if size >= CHUNK_WORDS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def train(docs: DataFrame, base: Unigrams, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (ROWS x CLASSES) from all of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    weights = np.zeros((ROWS, CLASSES), np.float32)
    shared = spark.sparkContext.broadcast(base)

    for _ in range(rounds):
        begin = spark.sparkContext.broadcast(weights)

        def steps(batches: Iterator[pa.RecordBatch], begin=begin) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            own, power, seen = begin.value.copy(), np.zeros(ROWS, np.float32), 0
            reader = Reader(shared.value)
            class_log, member_log = (x.astype(np.float32) for x in (shared.value.class_log, shared.value.member_log))
            for _, texts in _chunks(batches):
                names, word, home, classes, rows = reader.read(texts)
                for i in range(0, len(classes), BATCH):
                    descend(own, power, class_log, rows[i : i + BATCH], classes[i : i + BATCH])
                _, kind, place, rows = reader.members(names, word, home, classes)
                for i in range(0, len(kind), BATCH):
                    descend(own, power, member_log[kind[i : i + BATCH]], rows[i : i + BATCH], place[i : i + BATCH])
                seen += len(classes)
            if seen:
                part = TaskContext.get().partitionId() % FANIN
                blocks = range(0, ROWS, BLOCK_ROWS)
                columns = [
                    pa.array([part] * len(blocks), pa.int32()),
                    pa.array([b // BLOCK_ROWS for b in blocks], pa.int32()),
                    pa.array([float(seen)] * len(blocks)),
                    pa.array([(own[b : b + BLOCK_ROWS] * np.float32(seen)).tobytes() for b in blocks], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "seen", "total"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], list] = {}
            for batch in batches:
                for r in batch.to_pylist():
                    held = sums.setdefault((r["part"], r["block"]), [0.0, 0.0])
                    held[0] += r["seen"]
                    held[1] = held[1] + np.frombuffer(r["total"], np.float32)
            if sums:
                columns = [
                    pa.array([k[0] for k in sums], pa.int32()),
                    pa.array([k[1] for k in sums], pa.int32()),
                    pa.array([v[0] for v in sums.values()]),
                    pa.array([v[1].astype(np.float32).tobytes() for v in sums.values()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "seen", "total"])

        kinds = "part int, block int, seen double, total binary"
        made = docs.select("doc_id", "text").mapInArrow(steps, kinds)
        made = made.repartition("part", "block").mapInArrow(add, kinds).withColumn("part", F.lit(0))
        made = made.repartition("block").mapInArrow(add, kinds).collect()  # one model: ROWS x CLASSES
        for r in made:
            block = np.frombuffer(r["total"], np.float32).reshape(-1, CLASSES) / np.float32(r["seen"])
            weights[r["block"] * BLOCK_ROWS : r["block"] * BLOCK_ROWS + len(block)] = block
    return weights


def score(docs: DataFrame, counts: DataFrame, base: Unigrams, weights: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10) for every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((base, weights))
    log10, norm = np.log(10.0), base.norm
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64()), ("seen", pa.float64()), ("unseen", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, weights = shared.value
        reader, row = Reader(base), TaskContext.get().partitionId() << 40
        for ids, texts in _chunks(batches):
            names, word, home, classes, rows = reader.read(texts)
            seen, unseen = np.zeros(len(word)), np.zeros(len(word))
            if base.tokens:
                for i in range(0, len(word), SLICE):
                    part = slice(i, i + SLICE)
                    z = energies(weights, base.class_log, rows[part])
                    mine = classes[part]
                    own, other = z[np.arange(len(mine)), mine], z[:, UNSEEN].copy()
                    total = np.log(totals(np.exp(z, out=z)))
                    seen[part] = (own - total - base.class_log[mine]) / log10
                    unseen[part] = (other - total - base.class_log[UNSEEN]) / log10
                at, kind, place, rows = reader.members(names, word, home, classes)
                seen[at] += member_gains(weights, base, kind, place, rows) / log10
            count = np.array([base.known.get(w, -1) for w in names])[word]
            sure = count >= 0
            docs_n = len(texts)
            flat = np.where(sure, np.log10((np.maximum(count, 0) + SMOOTH) / norm), 0.0)
            fixed = np.bincount(home, flat, minlength=docs_n).astype(float)
            gain = np.bincount(home[sure], seen[sure], minlength=docs_n).astype(float)
            n_sure = np.bincount(home[sure], minlength=docs_n)
            # The other words: once for each document, with what they add if seen and if unseen.
            lone = np.flatnonzero(~sure)
            pair = home[lone] * len(names) + word[lone]
            keys, inverse = np.unique(pair, return_inverse=True)
            owner, which = keys // max(1, len(names)), keys % max(1, len(names))
            items = pa.StructArray.from_arrays(
                [
                    pa.array([names[i] for i in which.tolist()], pa.binary()),
                    pa.array(np.bincount(inverse, minlength=len(keys)).astype(np.int64)),
                    pa.array(np.bincount(inverse, seen[lone], minlength=len(keys)).astype(float)),
                    pa.array(np.bincount(inverse, unseen[lone], minlength=len(keys)).astype(float)),
                ],
                fields=list(rare_type.value_type),
            )
            ends = np.searchsorted(owner, np.arange(docs_n + 1)).astype(np.int32)
            columns = [
                pa.array(row + np.arange(docs_n)),
                pa.array(ids, pa.int64()),
                pa.array(np.bincount(home, minlength=docs_n).astype(np.int64)),
                pa.array(n_sure.astype(np.int64)),
                pa.array(fixed),
                pa.array(gain),
                pa.ListArray.from_arrays(pa.array(ends), items),
            ]
            row += docs_n
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_tokens", "n_sure", "fixed", "gain", "rare"])

    kinds = (
        "row long, doc_id long, n_tokens long, n_sure long, fixed double, gain double, "
        "rare array<struct<word: binary, n: long, seen: double, unseen: double>>"
    )
    made = common.materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds), "lm-rows")
    rare = made.select("row", F.inline("rare")).join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_more"),
        F.sum(F.col("n") * F.log10((F.col("c") + SMOOTH) / norm)).alias("fixed_more"),
        F.sum(F.when(F.col("c") > 0, F.col("seen")).otherwise(F.col("unseen"))).alias("gain_more"),
    )
    joined = made.drop("rare").join(rare, "row", "left").na.fill(0, ["n_more", "fixed_more", "gain_more"])
    base_score = F.col("fixed") + F.col("fixed_more")
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_sure") + F.col("n_more")).alias("n_known"),
        base_score.alias("base_score"),
        (base_score + F.col("gain") + F.col("gain_more")).alias("score"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = common.table(spark, sf_dir, "documents")
    trained = common.in_training("doc_id", FOLDS)
    counts = common.materialize(word_counts(docs.filter(trained)), "word-counts")
    base = unigrams(counts)
    weights = train(docs.filter(trained), base)
    found = score(docs, counts, base, weights)
    return found.select(
        "doc_id",
        (~trained).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(base.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
