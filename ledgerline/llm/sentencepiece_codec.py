"""Operator 1: SentencePiece encoding and decoding.

Encoding is a Unigram Viterbi search: of all ways to cut a text into pieces it takes the one whose
log scores add up to most. Pieces are looked up in a double-array trie over UTF-8 bytes. A character
without a piece costs the least score less ``UNKNOWN_PENALTY`` and becomes its byte pieces. A space
is the marker U+2581, and a text starts with one. Decoding joins pieces, turns byte pieces back
into bytes and markers into spaces, and drops the first space.

The vocabulary is a parameter: a SentencePiece model file. Its pieces are used as they are. Where
the file has merge ranks instead of log scores (a BPE model), a piece of rank r gets the log
probability of Zipf's law, ``-log(r + 1) - log(H)``. Nothing is trained.

No piece has a marker behind another character, so the best cut of a text is the best cuts of its
chunks (a run of markers and what follows it) side by side. A worker encodes each distinct chunk
once, all new chunks of a batch at the same time: the trie is walked from all positions together,
and the search advances one byte in every chunk at a step.

Ties take the piece that starts first. Defined cases: null and empty text have no ids and decode
to the empty text; a text's own U+2581 decodes to a space, so such a text does not round-trip; ids
that name no piece, and bytes that are not UTF-8, decode to U+FFFD. Only ``doc_id`` and ``text``
are read; repeated rows are encoded one by one; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_CHUNKS = 200_000
STRIDE = 1024
SEPARATOR = 0xFF  # never a byte of UTF-8, so no piece reaches past a chunk
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray  # log scores of the ids
    normal: np.ndarray  # ids that text can match
    byte_ids: np.ndarray  # id of each byte's piece, -1 without one
    unk_id: int


def read_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    byte_ids = np.full(256, -1, np.int32)
    normal = []
    for i, piece in enumerate(pieces):
        if model.is_byte(i):
            byte_ids[int(_BYTE.fullmatch(piece)[1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append(i)
    scores = np.array([model.get_score(i) for i in range(n)], np.float64)
    normal = np.array(normal, np.int32)
    return Vocabulary(pieces, log_scores(scores, normal), normal, byte_ids, model.unk_id())


def log_scores(scores: np.ndarray, normal: np.ndarray) -> np.ndarray:
    """Log scores as they are; merge ranks (0, -1, -2, ...) as log probabilities of Zipf's law."""
    held = scores[normal]
    if not np.array_equal(held, np.round(held)):
        return scores
    rank = np.empty(len(normal))
    rank[np.lexsort((normal, -held))] = np.arange(len(normal))
    out = scores.copy()
    out[normal] = -np.log(rank + 1) - np.log(np.sum(1 / np.arange(1, len(normal) + 1)))
    return out


class DoubleArray:
    """A trie in two arrays: the child of state s by byte c is ``base[s] + c``, if ``check`` of
    that cell is s. ``value`` holds the id of the piece that ends in a cell, or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        size = 512 + 2 * STRIDE + 4 * sum(len(k) for k, _ in keys)
        self.base, self.check, self.value = (np.full(size, -1, np.int32) for _ in range(3))
        taken = np.zeros(size, bool)
        taken[0] = True
        self.check[0] = 0
        free = 1
        work = [(0, 0, len(keys), 0)]  # state, range of its keys, depth
        while work:
            state, begin, end, depth = work.pop()
            if len(keys[begin][0]) == depth:
                self.value[state] = keys[begin][1]
                begin += 1
            if begin == end:
                continue
            heads, starts = [], []
            for i in range(begin, end):
                c = keys[i][0][depth]
                if not heads or heads[-1] != c:
                    heads.append(c)
                    starts.append(i)
            offsets = np.array(heads)
            while taken[free]:
                free += 1
            at = max(1, free - heads[0])
            while True:  # the first place where no child's cell is taken, looked for in strides
                clash = np.zeros(STRIDE, bool)
                for c in heads:
                    clash |= taken[at + c : at + c + STRIDE]
                if not clash.all():
                    at += int(np.argmin(clash))
                    break
                at += STRIDE
            self.base[state] = at
            taken[at + offsets] = True
            self.check[at + offsets] = state
            for c, a, b in zip(heads, starts, [*starts[1:], end], strict=True):
                work.append((at + c, a, b, depth + 1))
        used = np.flatnonzero(taken)[-1] + 257  # any byte may be added to any base
        self.base, self.check, self.value = self.base[:used], self.check[:used], self.value[:used]

    def matches(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and id of every key found in ``data`` (which ends in a separator) at one
        of ``starts``; all starts walk the trie together."""
        found = []
        at, state, depth = starts, np.zeros(len(starts), np.int32), 0
        while len(at):
            base = self.base[state]
            step = base + data[at + depth]
            alive = (base >= 0) & (self.check[step] == state)
            at, state = at[alive], step[alive]
            depth += 1
            ends = self.value[state] >= 0
            found.append((at[ends], np.full(int(ends.sum()), depth, np.int32), self.value[state[ends]]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (starts,) * 3


class Codec:
    def __init__(self, vocabulary: Vocabulary, trie: DoubleArray):
        self.vocabulary, self.trie = vocabulary, trie
        self.unknown = float(vocabulary.scores[vocabulary.normal].min()) - UNKNOWN_PENALTY
        self.cache: dict[str, bytes] = {}
        shown = [p.replace(MARK, " ").encode() for p in vocabulary.pieces]
        for byte, i in enumerate(vocabulary.byte_ids):
            if i >= 0:
                shown[i] = bytes([byte])
        special = set(range(len(shown))) - set(vocabulary.normal.tolist()) - set(vocabulary.byte_ids.tolist())
        for i in special:
            shown[i] = "�".encode() if i == vocabulary.unk_id else b""
        self.shown = dict(enumerate(shown))

    def cut(self, chunks: list[str]) -> list[bytes]:
        """Ids (int32) of each chunk's best cut."""
        coded = [c.encode("utf-8", "replace") for c in chunks]
        data = np.frombuffer(b"\xff".join(coded) + b"\xff", np.uint8).astype(np.int32)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        starts = np.flatnonzero((data & 0xC0 != 0x80) & (data != SEPARATOR))
        at, length, ids = self.trie.matches(data, starts)
        # A character that no piece of its own covers: an edge with id -1.
        head = data[starts]
        wide = 1 + (head >= 0xC0) + (head >= 0xE0) + (head >= 0xF0)
        width = np.zeros(len(data), np.int32)
        width[starts] = wide
        whole = np.zeros(len(data), bool)
        whole[at[length == width[at]]] = True
        lone = starts[~whole[starts]]
        at = np.concatenate([at, lone])
        length = np.concatenate([length, width[lone]])
        scores = np.concatenate([self.vocabulary.scores[ids], np.full(len(lone), self.unknown)])
        ids = np.concatenate([ids, np.full(len(lone), -1, ids.dtype)])

        home = np.repeat(begins, sizes + 1)
        step = at - home[at]
        order = np.argsort(step, kind="stable")
        at, length, ids, scores, step = at[order], length[order], ids[order], scores[order], step[order]
        best = np.full(len(data) + 1, -np.inf)
        best[begins] = 0.0
        came, piece = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int32)
        edges = np.flatnonzero(np.concatenate([[True], step[1:] != step[:-1], [True]])) if len(step) else np.zeros(1, int)
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            # All edges here leave their chunks at the same byte: one start a chunk, so no end twice.
            score = best[at[i:j]] + scores[i:j]
            to = at[i:j] + length[i:j]
            won = score > best[to]
            to = to[won]
            best[to], came[to], piece[to] = score[won], at[i:j][won], ids[i:j][won]

        # Back from the ends of all chunks together.
        who, place = np.arange(len(coded)), begins + sizes
        owner, ident = [], []
        going = place > begins
        who, place = who[going], place[going]
        while len(who):
            before = came[place]
            got = piece[place]
            for k in range(4):  # the bytes of an unknown character, the last one first
                byte_at = place - 1 - k
                lone = (got < 0) & (byte_at >= before)
                if not lone.any():
                    break
                owner.append(who[lone])
                named = self.vocabulary.byte_ids[data[byte_at[lone]]]
                ident.append(np.where(named >= 0, named, self.vocabulary.unk_id).astype(np.int32))
            plain = got >= 0
            owner.append(who[plain])
            ident.append(got[plain])
            place = before
            going = place > begins[who]
            who, place = who[going], place[going]
        if not owner:
            return [b""] * len(coded)
        owner, ident = np.concatenate(owner)[::-1], np.concatenate(ident)[::-1]
        order = np.argsort(owner, kind="stable")
        flat = ident[order].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(coded)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Chunks of a text as cache keys: a word stands for marker + word, any other chunk (runs of
        spaces) for itself."""
        parts = text.split(" ")
        if "" not in parts and MARK not in text:
            return parts
        return [c if c.startswith(MARK * 2) or len(c) == 1 else c[1:] for c in _CHUNK.findall(MARK + text.replace(" ", MARK))]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.chunks(t) if t else [] for t in texts]
        if len(self.cache) > CACHE_CHUNKS:
            self.cache = {}
        new = list({c for chunks in split for c in chunks if c not in self.cache})
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            self.cache.update(zip(part, self.cut([c if c.startswith(MARK) else MARK + c for c in part]), strict=True))
        return [b"".join(map(self.cache.__getitem__, chunks)) for chunks in split]

    def decode(self, ids: np.ndarray) -> str:
        shown = b"".join(map(self.shown.get, ids.tolist(), [b"\xef\xbf\xbd"] * len(ids)))
        return shown.removeprefix(b" ").decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}
_TRIES: dict[str, tuple[Vocabulary, DoubleArray]] = {}


def build(path: str) -> tuple[Vocabulary, DoubleArray]:
    if path not in _TRIES:
        vocabulary = read_vocabulary(path)
        keys = [(vocabulary.pieces[i].encode(), int(i)) for i in vocabulary.normal]
        if any(MARK in vocabulary.pieces[i].lstrip(MARK) for i in vocabulary.normal):
            raise ValueError("a piece has a marker behind another character: chunks would not be independent")
        _TRIES[path] = vocabulary, DoubleArray(keys)
    return _TRIES[path]


def codec(path: str, made: tuple[Vocabulary, DoubleArray]) -> Codec:
    """One for each worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(*made)
    return _CODECS[path]


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text, piece_ids (array of int) for every row of ``docs``."""
    common.prepare(docs.sparkSession)
    path = model or default_model()
    made = docs.sparkSession.sparkContext.broadcast(build(path))  # bounded by the vocabulary file
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("piece_ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, made.value)
        for batch in batches:
            coded = coder.encode(common.texts(batch))
            ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(coded), "<i4"))
            ids = pa.ListArray.from_arrays(pa.array(ends), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text").cast(pa.string()), ids], schema=schema)
        coder.cache = {}  # the worker may go on with other work

    needed = docs.select(F.col("doc_id").cast("long"), "text")
    return needed.mapInArrow(common.tidy(run), "doc_id long, text string, piece_ids array<int>")


def decode(coded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text (as given), piece_ids, decoded, n_pieces, n_byte_pieces, ids_crc32 of
    ``encode``'s rows."""
    common.prepare(coded.sparkSession)
    path = model or default_model()
    made = coded.sparkSession.sparkContext.broadcast(build(path))
    names = ["doc_id", "text", "piece_ids", "decoded", "n_pieces", "n_byte_pieces", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, made.value)
        is_byte = np.zeros(len(coder.vocabulary.pieces), bool)
        is_byte[coder.vocabulary.byte_ids[coder.vocabulary.byte_ids >= 0]] = True
        for batch in batches:
            column = batch.column("piece_ids")
            flat = column.values.to_numpy(zero_copy_only=False)
            ends = column.offsets.to_numpy()
            held = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [
                batch.column("doc_id"),
                batch.column("text"),
                column,
                pa.array([coder.decode(x) for x in held], pa.string()),
                pa.array([len(x) for x in held], pa.int64()),
                pa.array([int(is_byte[x].sum()) for x in held], pa.int64()),
                pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in held], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    types = "doc_id long, text string, piece_ids array<int>, decoded string, n_pieces long, n_byte_pieces long, ids_crc32 long"
    return coded.select("doc_id", "text", "piece_ids").mapInArrow(common.tidy(run), types)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_crc32 and whether decoding gives the text back."""
    found = decode(encode(common.table(spark, sf_dir, "documents")))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return found.select("doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", same.alias("round_trip"))
