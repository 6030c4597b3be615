"""Operator 2: toxicity by a subsequence string-kernel machine with Nyström landmarks.

A text's units are its words, lower-cased, reduced to letters (so marks put between letters do not
hide a word), digits and signs that stand for a letter between letters read as that letter, and
runs of single letters joined to one unit. The kernel of two units sums, over all subsequences of
``ORDER`` letters that both hold, ``DECAY`` to the length of the two stretches that they span: gaps
and inserted letters lower it but do not end it. It is normalised and squared; a unit that shares
less than ``OVERLAP`` of a landmark's letters counts as 0.

Landmarks are the units whose document counts differ most between the classes, no two too alike. A text is mapped to
the mean and the largest kernel value of its units for each landmark, both turned by the inverse
square root of the landmarks' own kernel matrix (Nyström). A linear machine with squared hinge loss
is trained on these features, and a logistic curve over its margins gives the score.

The fit reads at most ``FIT_ROWS`` labelled rows (those of least hash), so landmarks, features and
machine are bounded. Scoring runs over whole texts; a task computes the kernel once for each
distinct unit of a chunk.

Defined cases: null text, and text without letters, has all features 0; several labels of a doc_id
count as toxic if one is; without training rows of both classes every text gets the share of the
one class that there is (0 without any); repeated rows are scored one by one; an empty table gives
no rows. Only doc_id, text and the labels' doc_id and toxic are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

FOLDS = 5
ORDER = 3
DECAY = 0.6
OVERLAP = 0.8
LANDMARKS = 96
FIT_ROWS = 16_000
#: Units from which landmarks are taken, and the kernel value above which two are alike.
CANDIDATES = 600
ALIKE = 0.5
COST = 0.02
#: A unit of more letters is read as overlapping stretches of so many.
LONG = 48
CHUNK_WORDS = 500_000
#: Units whose kernel values a task keeps; beyond it, it starts anew.
CACHE_UNITS = 200_000
_REST = re.compile(r"[\W\d_]+")
_STANDS = re.compile(r"(?<=[^\W\d_])[013457@$!](?=[^\W\d_])")
# Signs read as the letter that they resemble.
_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def unit(raw: str) -> str:
    low = raw.lower()
    if _STANDS.search(low):
        low = _STANDS.sub(lambda m: _LETTERS[m[0]], low)
    return _REST.sub("", low)


class Units:
    """The distinct units met so far, by number."""

    def __init__(self) -> None:
        self.held: list[str] = []
        self.words: dict[str, int] = {}
        self.names: dict[str, int] = {"": -1}
        self.singles: set[int] = set()
        self.long: dict[str, list[int]] = {}  # words whose unit is longer than LONG, in stretches

    def place(self, name: str) -> int:
        if name not in self.names:
            self.names[name] = len(self.held)
            if len(name) == 1:
                self.singles.add(len(self.held))
            self.held.append(name)
        return self.names[name]

    def stretches(self, name: str) -> list[int]:
        return [self.place(name[i : i + LONG]) for i in range(0, max(1, len(name) - LONG // 2), LONG // 2)]

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each occurrence of a unit its number and its text, in order of texts."""
        at: list[int] = []
        sizes = []
        for text in texts:
            words = text.split()
            for w in set(words).difference(self.words):
                name = unit(w)
                if len(name) > LONG:
                    self.long[w] = self.stretches(name)
                    name = ""
                self.words[w] = self.place(name)
            found = list(map(self.words.__getitem__, words))
            if not self.singles.isdisjoint(found):  # join single letters that stand side by side
                joined, run = [], ""
                for x in [*(x for x in found if x >= 0), -1]:
                    if x in self.singles:
                        run += self.held[x]
                        continue
                    if len(run) >= ORDER:
                        joined += self.stretches(run)
                    run = ""
                found += joined
            if self.long:
                found += [x for w in words if w in self.long for x in self.long[w]]
            at += found
            sizes.append(len(found))
        places, home = np.array(at, np.int64), np.repeat(np.arange(len(texts)), sizes)
        real = places >= 0
        return places[real], home[real]


def letters(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each name, 0 after its end; the lengths."""
    sizes = np.fromiter(map(len, names), np.int64, len(names))
    out = np.zeros((len(names), max(1, sizes.max(initial=0))), np.int32)
    flat = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out, sizes


def kernel(left: np.ndarray, right: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of each pair of rows of letters (0: no letter)."""
    n, a = left.shape
    b = right.shape[1]
    x, y = np.ascontiguousarray(left.T), np.ascontiguousarray(right.T)
    decay = np.float32(decay)
    # weight[i, j]: all shared subsequences of the letters before i and j, each weighted by the
    # stretch from its first letters to there. Pairs lie along the last axis.
    equal = [[decay * decay * ((x[i] == y[j]) & (x[i] != 0)) for j in range(b)] for i in range(a)]
    weight = np.ones((a + 1, b + 1, n), np.float32)
    for _ in range(order - 1):
        grown = np.zeros_like(weight)
        for i in range(a):
            line = np.zeros(n, np.float32)
            for j in range(b):
                line = decay * line + equal[i][j] * weight[i, j]
                grown[i + 1, j + 1] = decay * grown[i, j + 1] + line
        weight = grown
    total = np.zeros(n)
    for i in range(a):
        for j in range(b):
            total += equal[i][j] * weight[i, j]
    return total


@dataclass
class Landmarks:
    names: list[str]
    turn: np.ndarray | None = None  # inverse square root of their kernel matrix

    def __post_init__(self) -> None:
        self.codes, self.sizes = letters(self.names)
        alphabet = sorted(set("".join(self.names)))
        self.place = np.zeros(0x110000, np.int16)
        self.place[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.n_letters = len(alphabet) + 1
        self.bags = self._bags(self.codes, self.sizes)
        self.own = kernel(self.codes, self.codes)
        self.table: Units | None = None  # kept by a task from chunk to chunk

    def _bags(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(codes)), codes.shape[1])
        cell = row * self.n_letters + self.place[codes.ravel()]
        bags = np.bincount(cell, minlength=len(codes) * self.n_letters).reshape(len(codes), -1)
        bags[:, 0] = 0
        return np.minimum(bags, 255).astype(np.uint8)

    def values(self, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(name, landmark, squared normalised kernel) of the pairs that share enough letters."""
        out = [], [], []
        order = sorted(range(len(names)), key=lambda i: len(names[i]))
        for begin in range(0, len(order), 20_000):
            part = np.array(order[begin : begin + 20_000])
            codes, sizes = letters([names[i] for i in part])
            bags = self._bags(codes, sizes)
            own = np.full(len(part), -1.0)
            for k in range(len(self.names)):
                used = np.flatnonzero(self.bags[k])
                shared = np.minimum(bags[:, used], self.bags[k, used]).sum(axis=1)
                rows = np.flatnonzero(shared >= max(ORDER, OVERLAP * self.sizes[k]))
                for c in range(0, len(rows), 2048):
                    some = rows[c : c + 2048]
                    wide = int(sizes[some].max())
                    new = some[own[some] < 0]
                    if len(new):
                        own[new] = kernel(codes[new, :wide], codes[new, :wide])
                    target = np.broadcast_to(self.codes[k, : self.sizes[k]], (len(some), self.sizes[k]))
                    value = kernel(codes[some, :wide], target)
                    value = value * value / np.maximum(own[some] * self.own[k], 1e-30)
                    hit = value > 1e-4
                    out[0].append(part[some[hit]])
                    out[1].append(np.full(int(hit.sum()), k))
                    out[2].append(value[hit])
        if not out[0]:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in out)

    def features(self, texts: list[str]) -> np.ndarray:
        """Mean and largest kernel value for each landmark, turned by ``turn``."""
        m = len(self.names)
        if self.table is None or len(self.table.held) > CACHE_UNITS or len(self.table.words) > 2 * CACHE_UNITS:
            self.table, self.begins = Units(), np.zeros(1, np.int64)
            self.which, self.value = np.zeros(0, np.int64), np.zeros(0)
        before = len(self.table.held)
        at, home = self.table.read(texts)
        new = self.table.held[before:]
        if new:
            who, which, value = self.values(new)
            order = np.argsort(who, kind="stable")
            ends = self.begins[-1] + np.searchsorted(who[order], np.arange(1, len(new) + 1))
            self.begins = np.concatenate([self.begins, ends])
            self.which = np.concatenate([self.which, which[order]])
            self.value = np.concatenate([self.value, value[order]])
        begins, which, value = self.begins, self.which, self.value
        mean, most = np.zeros((len(texts), m)), np.zeros((len(texts), m))
        if len(at):
            size = np.diff(begins)[at]
            hit = size > 0
            at_hit, home_hit, size = at[hit], home[hit], size[hit]
            slot = np.repeat(begins[at_hit], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            cell = np.repeat(home_hit, size) * m + which[slot]
            mean = np.bincount(cell, value[slot], minlength=len(texts) * m).reshape(-1, m)
            np.maximum.at(most.reshape(-1), cell, value[slot])
            mean = mean / np.maximum(np.bincount(home, minlength=len(texts)), 1)[:, None]
        return np.hstack([mean @ self.turn, most @ self.turn])

    def forget(self) -> None:
        """Free what a task has kept: its worker may go on with other work."""
        self.table, self.which, self.value = None, np.zeros(0, np.int64), np.zeros(0)

    def whiten(self) -> None:
        m = len(self.names)
        who, which, value = self.values(self.names)
        matrix = np.zeros((m, m))
        matrix[who, which] = value
        matrix = (matrix + matrix.T) / 2
        roots, axes = np.linalg.eigh(matrix)
        self.turn = axes @ np.diag(1 / np.sqrt(np.maximum(roots, 0.05))) @ axes.T


@dataclass
class Machine:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the offset
    curve: tuple[float, float]

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.center) / self.scale
        margin = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margin + self.curve[1], -40, 40)))


def train(features: np.ndarray, toxic: np.ndarray, cost: float = COST) -> Machine:
    """Newton steps on the squared hinge loss, then a logistic curve over the margins."""
    center, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.hstack([(features - center) / scale, np.ones((len(features), 1))])
    y = np.where(toxic, 1.0, -1.0)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        xa = x[active]
        new = np.linalg.solve(ridge + 2 * cost * xa.T @ xa, 2 * cost * xa.T @ y[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    margin, t = x @ w, toxic.astype(float)
    z = np.stack([margin, np.ones_like(margin)], axis=1)
    c = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ c, -40, 40)))
        grad = z.T @ (p - t) + 1e-3 * c
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), grad)
        c = c - np.clip(step, -2, 2)
    return Machine(center, scale, w, (float(c[0]), float(c[1])))


def spread(ranked: list[str], count: int) -> list[str]:
    """The first ``count`` of ``ranked`` that are not too much alike: a landmark for each family of
    units, before there are many for one."""
    who, which, value = Landmarks(ranked).values(ranked)
    near: dict[int, set[int]] = {}
    for a, b in zip(who[value > ALIKE].tolist(), which[value > ALIKE].tolist(), strict=True):
        near.setdefault(a, set()).add(b)
    taken: list[int] = []
    for i in range(len(ranked)):
        if len(taken) < count and not near.get(i, set()).intersection(taken):
            taken.append(i)
    taken += [i for i in range(len(ranked)) if i not in set(taken)][: max(0, count - len(taken))]
    return [ranked[i] for i in sorted(taken)]


@dataclass
class Model:
    landmarks: Landmarks | None
    machine: Machine | None
    share: float  # of toxic rows, where there is nothing else to go by


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); at most ``fit_rows`` rows: a label id brings
    one text, of several that of least hash."""
    spark = docs.sparkSession
    common.prepare(spark)
    rows = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").groupBy("doc_id", "toxic")
    sample = sample.agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least")).select("doc_id", "least.text", "toxic")
    sample = common.materialize(sample.repartition(F.xxhash64("doc_id") % 64), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, toxic = common.texts(batch), np.array(batch.column("toxic").to_pylist()) > 0
            table = Units()
            at, home = table.read(texts)
            names = table.held
            pairs = np.unique(at * len(texts) + home) if len(at) else np.zeros(0, np.int64)
            who, bad = pairs // max(1, len(texts)), toxic[pairs % max(1, len(texts))]
            n, t = np.bincount(who, minlength=len(names)), np.bincount(who, bad, minlength=len(names))
            columns = [pa.array(names, pa.string()), pa.array(n, pa.int64()), pa.array(t.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "n", "t"])

    sizes = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, t = sizes["n"], sizes["t"]
    if t == 0 or t == n:
        return Model(None, None, t / n if n else 0.0)
    counted = sample.mapInArrow(common.tidy(count), "unit string, n long, t long").groupBy("unit").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    expected = F.col("n") * F.lit(t / n)
    gain = (F.col("t") - expected) / F.sqrt(expected + 1)
    top = counted.filter(F.length("unit") >= ORDER + 1).orderBy(gain.desc(), "unit").limit(CANDIDATES).collect()
    if not top:
        return Model(None, None, t / n)
    marks = Landmarks(spread([r["unit"] for r in top], landmarks))
    marks.whiten()
    shared = spark.sparkContext.broadcast(marks)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.features(common.texts(batch))
            columns = [pa.array(list(found), pa.list_(pa.float64())), batch.column("toxic").cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "toxic"])
        shared.value.forget()

    got = sample.mapInArrow(common.tidy(turn), "x array<double>, toxic long").toPandas()  # fit_rows x features
    return Model(marks, train(np.stack(got["x"].to_numpy()), got["toxic"].to_numpy() > 0), t / n)


def score(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` as struct ``row``, and the score of its text."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value

        def rows(held: list[pa.Array], texts: list[str]) -> pa.RecordBatch:
            found = np.full(len(texts), model.share)
            if model.machine:
                found = model.machine.scores(model.landmarks.features(texts))
            return pa.RecordBatch.from_arrays([pa.concat_arrays(held), pa.array(found)], names=["row", "score"])

        held: list[pa.Array] = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            some = common.texts(batch, "body")
            held.append(batch.column("row"))
            texts += some
            size += sum(t.count(" ") + 1 for t in some)
            if size >= CHUNK_WORDS:
                yield rows(held, texts)
                held, texts, size = [], [], 0
        if held:
            yield rows(held, texts)
        if model.landmarks:
            model.landmarks.forget()

    needed = docs.select(F.struct(*(docs[c] for c in carry)).alias("row"), F.col("text").alias("body"))
    kind = needed.schema["row"].dataType.simpleString()
    return needed.mapInArrow(common.tidy(run), f"row {kind}, score double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    train_rows = common.in_training("doc_id", FOLDS)
    model = fit(docs, labels.filter(train_rows).select("doc_id", "toxic"))
    found = score(docs, model, ["doc_id"]).select("row.doc_id", "score")
    return found.select(
        "doc_id", (~train_rows).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
