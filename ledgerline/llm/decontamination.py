"""Operator 4: benchmark decontamination by edit distance.

Texts are sequences of words (lower-cased, letters and digits only). An item leaks into a document
if some run of the document's words is within ``share`` of the item's length of it, in word edits.

Candidates. The CGK embedding walks a window of words: at step j it writes the word under its
pointer and moves on if a random bit for (j, word) says so, so that few edits change few of the
written words. Two walks that start at an item and at its edited copy fall back into step after
most edits. A repetition has its own random bits and samples a few steps; windows whose sampled
words equal those of an item are candidates. Item-sized windows start at every word of a document
and are read forwards and backwards, and an item enters at ``ANCHORS`` of its words, so an edit
near one end does not hide it. Sampled words are compared one by one as the walk reaches them (the
keys form a trie), so almost all windows stop after one or two steps. Repetitions are added until
items with random edits at the allowed share are found with the ``recall`` asked for; a benchmark
on which more repetitions no longer help raises.

Verification. A candidate's stretch is compared with the item by the exact edit distance between
the item and any run of words in it.

Items reach the tasks in blocks of at most ``ITEM_BLOCK``, one pass over the documents for each, so
what is broadcast is bounded whatever the benchmark's size. A document is searched whole by one
task: nothing is shuffled.

Defined cases: null and wordless texts hold no leak; wordless items are skipped; an item of fewer
than 1 / ``share`` words leaks only verbatim; several leaks of an item in a document give one row,
the nearest (then the first); equal items each give their row; repeated documents each give their
rows; empty tables give no rows. Only doc_id, text, item_id and item text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

SHARE = 0.2
RECALL = 0.98
ANCHORS = 4
ITEM_BLOCK = 20_000
#: Items and edited copies of each on which repetitions are measured; most repetitions in a row that
#: find none of the copies still missed.
TRIALS = 300
MOST_REPETITIONS = 12
CHUNK_WORDS = 500_000
_REST = re.compile(r"[\W_]+")
GAP = 0  # no item's word: a document's other words, and what lies outside it


def word(raw: str) -> str:
    return _REST.sub("", raw.lower())


class Words(dict):
    """Symbol of each raw word: 1 and up for the items' words, 0 for others, -1 for none."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, raw: str) -> int:
        if len(self) > 500_000:
            self.clear()
        plain = word(raw)
        self[raw] = found = self.vocabulary.get(plain, 0) if plain else -1
        return found

    def symbols(self, text: str) -> np.ndarray:
        found = np.array(list(map(self.__getitem__, text.split())), np.int32)
        return found[found >= 0]


class Repetition:
    """One walk: random bits for each symbol and step, sampled steps, and the items' keys as a trie."""

    def __init__(self, seed: int, items: list[np.ndarray], n_symbols: int):
        rng = np.random.default_rng(seed)
        self.backward = bool(seed % 2)
        self.steps = [int(rng.integers(0, 2)), int(rng.integers(2, 5)), int(rng.integers(5, 10)), int(rng.integers(10, 16))]
        self.bits = rng.integers(0, 2**63, n_symbols, dtype=np.int64)
        self.n_symbols = n_symbols
        children: list[dict[int, int]] = [{} for _ in self.steps]
        ends: dict[int, list[tuple[int, int]]] = {}
        nodes = 1
        for i, item in enumerate(items):
            line = item[::-1] if self.backward else item
            for start in sorted({len(line) * a // ANCHORS for a in range(ANCHORS)}):
                node, at, level = 0, start, 0
                for step in range(self.steps[-1] + 1):
                    if at >= len(line):
                        break  # the item ends here: its later samples are free
                    symbol = int(line[at])
                    if step == self.steps[level]:
                        key = node * n_symbols + symbol
                        if key not in children[level]:
                            children[level][key] = nodes
                            nodes += 1
                        node, level = children[level][key], level + 1
                    at += int(self.bits[symbol] >> step & 1)
                ends.setdefault(node, []).append((i, start))
        self.keys, self.next = [], []
        for level in children:
            keys = np.array(sorted(level), np.int64)
            self.keys.append(keys)
            self.next.append(np.array([level[k] for k in keys.tolist()], np.int64))
        self.first = np.full(n_symbols, -1, np.int64)
        self.first[self.keys[0]] = self.next[0]
        self.end_at = np.zeros(nodes + 1, np.int64)
        for node, held in ends.items():
            self.end_at[node + 1] = len(held)
        self.end_at = np.cumsum(self.end_at)
        flat = [pair for node in range(nodes) for pair in ends.get(node, ())]
        self.end_item, self.end_start = np.array(flat, np.int64).reshape(-1, 2).T

    def candidates(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place of its first word) of every window whose sampled words are an item's."""
        n, pad = len(symbols), self.steps[-1] + 2
        line = np.concatenate([symbols[::-1] if self.backward else symbols, np.zeros(pad, symbols.dtype)])
        bits = self.bits[line]
        at, begin, node, level = np.arange(n), np.arange(n), np.zeros(n, np.int64), 0
        found = []
        for step in range(self.steps[-1] + 1):
            if step == self.steps[level]:
                if level == 0:
                    child = self.first[line[at]]
                    keep = child >= 0
                else:
                    key = node * self.n_symbols + line[at]
                    slot = np.minimum(np.searchsorted(self.keys[level], key), max(0, len(self.keys[level]) - 1))
                    keep = self.keys[level][slot] == key if len(self.keys[level]) else np.zeros(len(key), bool)
                    child = self.next[level][slot] if len(self.keys[level]) else key
                at, begin, node, level = at[keep], begin[keep], child[keep], level + 1
                count = self.end_at[node + 1] - self.end_at[node]
                done = np.flatnonzero(count)
                if len(done):
                    size = count[done]
                    slot = np.repeat(self.end_at[node[done]], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    found.append((self.end_item[slot], self.end_start[slot], np.repeat(begin[done], size)))
                if not len(at) or level == len(self.steps):
                    break
            at = at + (bits[at] >> step & 1)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        item, start, place = (np.concatenate(x) for x in zip(*found, strict=True))
        if self.backward:
            return item, n - 1 - place - (lengths[item] - 1 - start)
        return item, place - start


def edit_distances(item: np.ndarray, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between ``item`` and any run of words in each stretch, and the run's end."""
    rows, width = stretches.shape
    ramp = np.arange(width + 1, dtype=np.int32)
    before = np.zeros((rows, width + 1), np.int32)
    for i, symbol in enumerate(item.tolist()):
        row = np.empty_like(before)
        row[:, 0] = i + 1
        np.minimum(before[:, :-1] + (stretches != symbol), before[:, 1:] + 1, out=row[:, 1:])
        before = np.minimum.accumulate(row - ramp, axis=1) + ramp
    return before.min(axis=1), before.argmin(axis=1)


class Index:
    def __init__(self, items: list[tuple[int | None, str]], share: float, recall: float):
        split = [[w for w in map(word, text.split()) if w] for _, text in items]
        self.ids = [i for (i, _), words in zip(items, split, strict=True) if words]
        split = [words for words in split if words]
        names = sorted({w for words in split for w in words})
        self.vocabulary = {w: i + 1 for i, w in enumerate(names)}
        self.items = [np.array([self.vocabulary[w] for w in words], np.int32) for words in split]
        self.lengths = np.array([len(x) for x in self.items], np.int64)
        self.allowed = np.floor(self.lengths * share + 1e-9).astype(np.int64)
        self.repetitions: list[Repetition] = []
        self.measured = 1.0
        if self.items:
            self._repeat(recall)

    def _repeat(self, recall: float) -> None:
        """Add repetitions until edited items are found; forward and backward by turns."""
        rng = np.random.default_rng(11)
        trials = []
        for t in range(TRIALS):
            i = int(rng.integers(len(self.items)))
            copy = self.items[i].tolist()
            for _ in range(int(self.allowed[i])):
                kind, at = int(rng.integers(3)), int(rng.integers(max(1, len(copy))))
                if kind == 0 and len(copy) > 1:
                    copy.pop(at)
                elif kind == 1:
                    copy.insert(at, GAP)
                else:
                    copy[at] = GAP
            trials.append((i, np.array([GAP] * 3 + copy + [GAP] * 3, np.int32)))
        missed = list(range(TRIALS))
        n_symbols = len(self.vocabulary) + 1
        fruitless = 0
        while len(self.repetitions) < 2 or len(missed) > (1 - recall) * TRIALS:
            if fruitless >= MOST_REPETITIONS:
                found = 1 - len(missed) / TRIALS
                raise RuntimeError(f"{len(self.repetitions)} repetitions find {found:.3f} of the edited items; {recall} was asked for")
            rep = Repetition(len(self.repetitions), self.items, n_symbols)
            self.repetitions.append(rep)
            still = []
            for t in missed:
                i, line = trials[t]
                item, place = rep.candidates(line, self.lengths)
                near = (item == i) & (np.abs(place - 3) <= self.allowed[i] + 1)
                if not near.any():
                    still.append(t)
            fruitless = fruitless + 1 if len(still) == len(missed) else 0
            missed = still
        self.measured = 1 - len(missed) / TRIALS

    def leaks(self, docs: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(document, item, edits, end of the run in words) of each item that leaks."""
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        if not self.items or not sizes.sum():
            return []
        line = np.concatenate(docs)
        ends = np.cumsum(sizes)
        pairs = [rep.candidates(line, self.lengths) for rep in self.repetitions]
        item, place = (np.concatenate(x) for x in zip(*pairs, strict=True))
        if not len(item):
            return []
        # Places of one alignment differ by a few edits: one stretch holds all that round to a place.
        grain = self.allowed[item] + 1
        cell = np.floor_divide(place, grain)
        both = np.unique(np.stack([item, cell], axis=1), axis=0)
        item, place = both[:, 0], both[:, 1] * (self.allowed[both[:, 0]] + 1)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        cuts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        for a, b in zip(cuts, [*cuts[1:], len(item)], strict=True):
            for c in range(a, b, 4096):
                self._verify(int(item[a]), place[c : min(b, c + 4096)], line, ends, sizes, best)
        return [(d, i, edits, end) for (d, i), (edits, end) in best.items()]

    def _verify(self, i: int, place: np.ndarray, line: np.ndarray, ends: np.ndarray, sizes: np.ndarray, best: dict) -> None:
        target, allowed = self.items[i], int(self.allowed[i])
        slack = 2 * allowed + 2
        spots = place[:, None] + np.arange(-slack, len(target) + slack)
        middle = np.clip(place + len(target) // 2, 0, len(line) - 1)
        home = np.searchsorted(ends, middle, side="right")
        # A window's middle may lie past its document's end by an edit or two: try both neighbours.
        for shift in (0, -1, 1):
            doc = home + shift
            fine = (doc >= 0) & (doc < len(ends))
            d = np.where(fine, doc, 0)
            inside = (spots >= (ends - sizes)[d][:, None]) & (spots < ends[d][:, None]) & fine[:, None]
            words = np.where(inside, line[np.clip(spots, 0, len(line) - 1)], GAP)
            mine = np.zeros(len(self.vocabulary) + 1, bool)
            mine[target] = True
            rows = np.flatnonzero(mine[words].sum(axis=1) >= len(target) - allowed)  # each word kept is there
            if not len(rows):
                continue
            edits, stop = edit_distances(target, words[rows])
            for r, e, s in zip(rows.tolist(), edits.tolist(), stop.tolist(), strict=True):
                if e <= allowed:
                    end = int(spots[r, 0] + s - (ends[doc[r]] - sizes[doc[r]]))
                    key = (int(doc[r]), i)
                    best[key] = min(best.get(key, (e, end)), (e, end))


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, recall: float = RECALL) -> DataFrame:
    """doc_id, text_hash, item_id, edits, item_words, end_word of each (document, item) where the item
    leaks; ``benchmark`` has item_id and text. Where ids are null or repeated, text_hash (Spark's
    xxhash64 of the text) tells which row leaks."""
    spark = docs.sparkSession
    common.prepare(spark)
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    needed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    names = ["doc_id", "text_hash", "item_id", "edits", "item_words", "end_word"]
    schema = pa.schema([(n, pa.int64()) for n in names])
    found = None
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        index = Index([(r["item_id"], r["text"]) for r in mine.collect()], share, recall)
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            words = Words(index.vocabulary)

            def rows(ids: list, hashed: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
                hits = index.leaks(held)
                columns = [
                    [ids[d] for d, *_ in hits],
                    [hashed[d] for d, *_ in hits],
                    [index.ids[i] for _, i, *_ in hits],
                    [e for _, _, e, _ in hits],
                    [int(index.lengths[i]) for _, i, *_ in hits],
                    [end for *_, end in hits],
                ]
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

            ids: list[int | None] = []
            hashed: list[int] = []
            held: list[np.ndarray] = []
            size = 0
            for batch in batches:
                keys = (batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist())
                for doc, mark, text in zip(*keys, common.texts(batch), strict=True):
                    ids.append(doc)
                    hashed.append(mark)
                    held.append(words.symbols(text))
                    size += len(held[-1])
                    if size >= CHUNK_WORDS:
                        yield rows(ids, hashed, held)
                        ids, hashed, held, size = [], [], [], 0
            if ids:
                yield rows(ids, hashed, held)

        part = needed.mapInArrow(common.tidy(search), ", ".join(f"{n} long" for n in names))
        found = part if found is None else found.unionAll(part)
    return found


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, edits, item_words, end_word of every leak of a benchmark item."""
    found = leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")
