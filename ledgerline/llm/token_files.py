"""Operator 9: token ids in Arrow stream files with fixed-size-list batches.

Documents are range-partitioned and sorted by ``doc_id``, encoded, and their ids laid end to end in
sequences of ``seq_len``. Each file is one Arrow IPC stream with two columns:

- ``ids``: ``fixed_size_list<uint16|uint32>[seq_len]``
- ``mask``: ``fixed_size_list<bool>[seq_len]``, a bit for each id; false only on the padding after a
  file's last id

The schema's metadata hold the file's place in the global order (``part``, ``seq``) and its
documents (``doc_ids``, ``lengths``). Every sequence has the same length, so a reader finds id
``k`` of a file at sequence ``k // seq_len`` without scanning, and ``TokenFile`` slices ids (as numpy
views) and masks (as Arrow views, because numpy has no bits) out of the file's own buffer without a copy.

Defined cases: a null text is empty (its ids are the end id alone); a null ``doc_id`` sorts first;
rows of equal ``doc_id`` are each written, ordered by a hash of their text, and however many they are,
they spread over ranges; an empty table gives no files and no rows. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import common

END_ID = 1
SEQ_LEN = 1024
#: A file is closed at the first document end after this many ids.
FILE_IDS = 2_000_000
#: Entries kept by a worker for words that it has encoded; beyond it the cache starts anew.
CACHE_WORDS = 300_000

NULL_DOC = -(2**63)

# A run of lower-case letters and a run of plain marks: the pre-tokenizer cuts exactly between them,
# and none of these characters is changed by NFC. Any other chunk goes through the whole tokenizer.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([.,!?;:|#$%&*()\[\]{}_=+/\"-]*)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable bytes stand for themselves, the others
    take the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(shown))
    return out


class Encoder:
    """Ids of whole texts by the tokenizers library, one call for each distinct chunk between
    spaces and line ends. The tokenizer drops white space and never joins across it, so the ids
    of a text are those of its chunks in order."""

    def __init__(self, path: str, dtype: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.dtype = np.dtype(dtype).newbyteorder("<")
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            mapped = "".join(map(self.letters.__getitem__, word.encode()))
            got = np.array([t.id for t in self.model.tokenize(mapped)], self.dtype).tobytes()
            if len(self.words) > CACHE_WORDS:
                self.words = {"": b""}
            self.words[word] = got
        return got

    def _chunk(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk.lower())
        if plain:
            return self._word(plain[1]) + self._word(plain[2])
        return np.array(self.whole.encode(chunk, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        parts = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.chunks.__getitem__, parts))
        except KeyError:
            if len(self.chunks) > CACHE_WORDS:
                self.chunks = {"": b""}
            for part in set(parts):
                if part not in self.chunks:
                    self.chunks[part] = self._chunk(part)
            return b"".join(map(self.chunks.__getitem__, parts))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, dtype: str) -> Encoder:
    """One for each worker process: it keeps its cache from task to task."""
    key = (path, dtype)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, dtype)
    return _ENCODERS[key]


def stream_file(ids: np.ndarray, docs: list[int], lengths: list[int], seq_len: int, place: dict[str, int]) -> bytes:
    """One Arrow stream. It ends in the end-of-stream marker, whose last byte is NUL."""
    rows = -(-len(ids) // seq_len)
    padded = np.zeros(rows * seq_len, ids.dtype)
    padded[: len(ids)] = ids
    mask = np.zeros(rows * seq_len, bool)
    mask[: len(ids)] = True
    columns = [
        pa.FixedSizeListArray.from_arrays(pa.array(padded), seq_len),
        pa.FixedSizeListArray.from_arrays(pa.array(mask), seq_len),
    ]
    meta = {k: str(v) for k, v in (place | {"n_ids": len(ids), "seq_len": seq_len}).items()}
    meta |= {"doc_ids": np.array(docs, "<i8").tobytes(), "lengths": np.array(lengths, "<i8").tobytes()}
    schema = pa.schema([("ids", columns[0].type), ("mask", columns[1].type)], metadata=meta)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
    return sink.getvalue().to_pybytes()


class TokenFile:
    """Zero-copy view of one stream file: ``sequence(i)`` and ``mask(i)`` are slices of its buffer."""

    def __init__(self, content: bytes | pa.Buffer):
        buffer = pa.py_buffer(content) if isinstance(content, bytes) else content
        reader = pa.ipc.open_stream(buffer)
        batch = reader.read_next_batch()
        meta = reader.schema.metadata
        self.seq_len = int(meta[b"seq_len"])
        self.n_ids, self.part, self.seq = (int(meta[k]) for k in (b"n_ids", b"part", b"seq"))
        self.doc_ids = np.frombuffer(meta[b"doc_ids"], "<i8")
        self.lengths = np.frombuffer(meta[b"lengths"], "<i8")
        self.rows = len(batch)
        self.flat = batch.column(0).values.to_numpy(zero_copy_only=True)
        self.flat_mask = batch.column(1).values

    def __len__(self) -> int:
        return self.rows

    def sequence(self, i: int) -> np.ndarray:
        return self.flat[i * self.seq_len : (i + 1) * self.seq_len]

    def mask(self, i: int) -> pa.BooleanArray:
        return self.flat_mask.slice(i * self.seq_len, self.seq_len)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    seq_len: int = SEQ_LEN,
    file_ids: int = FILE_IDS,
) -> None:
    """Encode ``text`` of ``docs`` and write the stream files below ``path`` in ``doc_id`` order.
    The tokenizer file is a path that executors can read, as an installed package's is."""
    common.prepare(docs.sparkSession)
    source = tokenizer or default_tokenizer()
    from tokenizers import Tokenizer

    dtype = "uint16" if Tokenizer.from_file(source).get_vocab_size() <= 2**16 else "uint32"
    schema = pa.schema([("blob", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(source, dtype), TaskContext.get().partitionId()
        end = np.array([end_id], enc.dtype).tobytes()
        width, seq, held = enc.dtype.itemsize, 0, 0
        blobs: list[bytes] = []
        ids: list[int] = []
        lengths: list[int] = []

        def closed() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(blobs), enc.dtype)
            made = stream_file(flat, ids, lengths, seq_len, {"part": part, "seq": seq})
            return pa.RecordBatch.from_pydict({"blob": [made]}, schema)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), common.texts(batch), strict=True):
                got = enc.encode(text) + end
                blobs.append(got)
                ids.append(NULL_DOC if doc is None else doc)
                lengths.append(len(got) // width)
                held += lengths[-1]
                if held >= file_ids:
                    yield closed()
                    blobs, ids, lengths, seq, held = [], [], [], seq + 1, 0
        if ids:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("place"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("place")]  # place: ranges split equal rows too
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    common.write_blobs(ordered.mapInArrow(encode, "blob binary"), path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: part, seq, at (place in the file), doc_id, first (ids
    before it in its file), n_tokens, ids_crc32 (over little-endian unsigned 32-bit ids)."""
    common.prepare(spark)
    schema = pa.schema(
        [("part", pa.int64()), ("seq", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64())]
        + [("first", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = TokenFile(content.as_buffer())
                ends = np.cumsum(file.lengths)
                firsts = ends - file.lengths
                sums = [
                    zlib.crc32(file.flat[a:b].astype("<u4").tobytes())
                    for a, b in zip(firsts.tolist(), ends.tolist(), strict=True)
                ]
                n = len(ends)
                columns = [np.full(n, file.part), np.full(n, file.seq), np.arange(n), file.doc_ids, firsts, file.lengths]
                arrays = [pa.array(c, pa.int64()) for c in [*columns, sums]]
                arrays[3] = pa.array(file.doc_ids, pa.int64(), mask=file.doc_ids == NULL_DOC)
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    names = "part long, seq long, at long, doc_id long, first long, n_tokens long, ids_crc32 long"
    return common.read_blobs(spark, path).select("content").mapInArrow(documents, names)


def with_starts(documents: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before it. Sums are taken per file, then per part; only
    one row for each part meets in one task. The starts are written first: Spark then knows that theirs is
    the smaller side of the join, and broadcasts them only where their size allows it."""
    files = documents.groupBy("part", "seq").agg(F.sum("n_tokens").alias("ids"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(across), F.lit(0)).alias("part_start"))
    files = files.select("part", "seq", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("file_start"))
    starts = files.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("file_start")).alias("base"))
    starts = common.materialize(starts, "token-file-starts")
    return documents.join(starts, ["part", "seq"]).withColumn("start", F.col("base") + F.col("first"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from its stream files."""
    path = common.scratch_path(spark, "token-files")
    write_token_files(common.table(spark, sf_dir, "documents"), path)
    documents = common.materialize(read_documents(spark, path), "token-file-documents")
    return with_starts(documents).select("doc_id", "start", "n_tokens", "ids_crc32")
