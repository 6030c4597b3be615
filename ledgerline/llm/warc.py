"""Operator 5: WARC archives with a two-level capture index.

Writing. Every page is one gzip member holding one WARC record. Of records with equal payloads of
at least ``min_bytes`` bytes the one with the smallest page_id is a response, the others are
revisits without a block that refer to it; smaller payloads are always responses. Members are
packed into blobs of about ``BLOB_BYTES``, and a file holds a few blobs, so files stay small
enough to be read whole. Each blob ends with an empty member, whose last byte is NUL (see
``common.write_blobs``); readers of WARC skip it.

Index. One pass over the archives gives a line for each record: reversed-host key, page_id, file,
offset, length. Lines are range-sorted by key, then by page_id and place, so that a URL with very many
captures spreads over ranges, and cut into blocks of ``BLOCK_LINES``, each a gzip member in an index
file. The directory keeps one row for each block: its first and last key, file, offset and length,
sorted by key.

Reading. ``lookup`` takes a table of URLs. Their distinct keys are range-sorted; a task reads the
directory rows between its least and greatest key, and a binary search finds each key's blocks. Every
such block's byte range is read once for its keys, another binary search finds their lines, and the
records' byte ranges are read, neighbours in one read. Only keys and lines are shuffled, no page.
Ranges are read inside tasks through Arrow's file systems (``file:``, ``hdfs:``, ``s3a:``, ``gs:``).

Defined cases: null html is an empty payload; a null url has the key ``)/`` of an empty host; a
page_id that repeats is written once for each row (equal ids and payloads: one of them, by hash of the url and
then by place in the scan, is the response, the others revisit it); null page_ids are written with an empty id and read back as null, and
refer or are referred to like a page of largest id. An empty table gives no files and no rows. A lookup
of a URL that was not captured gives no row, of one that is asked for twice its captures once; a null URL
asks for the captures without URL. URLs of equal key are one URL to the index.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import dataset, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

BLOB_BYTES = 4 << 20
BLOBS_PER_FILE = 4
BLOCK_LINES = 3000
#: Keys searched in the directory at a time.
SEARCH_KEYS = 20_000
#: Bytes of an archive read at once, and the most bytes between two records that are read in one go.
READ_BYTES = 4 << 20
GAP_BYTES = 64 << 10
#: Bytes of records that a reading task takes, about.
TASK_BYTES = 64 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
_EMPTY = gzip.compress(b"", mtime=0)


def capture_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.example.org/a?b`` is ``org,example)/a?b``."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:  # not a URL by the standard: keyed as a path
        return f")/{url}"
    host = re.sub(r"^www\d*\.", "", host)
    suffix = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + suffix + ")" + (parts.path or "/").lower() + query.lower()


def target_uri(url: str | None) -> str:
    """A URL as records hold it: white space and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def digest_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: str | None, n_bytes: int, digest: str) -> bytes:
    """One WARC/1.1 record. ``refers_to`` None: a response with its payload, else a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    shown = "" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{shown}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target_uri(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {n_bytes}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines[5:5] = [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(urn: str) -> int | None:
    shown = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(shown) if shown else None


def parse(data: bytes) -> dict:
    """Fields of one record; a response's length and digest are taken from its payload itself."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    _, _, payload = block.partition(b"\r\n\r\n")
    out = {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": None,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": payload,
    }
    if out["record_type"] == "revisit":
        out["refers_to"] = _page(fields["WARC-Refers-To"])
    else:
        found = (len(payload), digest_base32(payload))
        if found != (out["payload_bytes"], out["payload_digest"]):
            raise ValueError(f"record {out['page_id']}: the payload does not match its digest")
    return out


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of each non-empty gzip member."""
    view, at = memoryview(content), 0
    while at < len(view):
        unzip, end, parts = zlib.decompressobj(31), at, []
        while not unzip.eof:
            if end >= len(view):
                raise ValueError("truncated gzip member")
            parts.append(unzip.decompress(view[end : end + 65536]))
            end += 65536
        size = min(end, len(view)) - len(unzip.unused_data) - at
        data = b"".join(parts)
        if data:
            yield at, size, data
        at += size


def with_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, body (binary), sha (hex SHA-1), n_bytes, refers_to (null for responses; text)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", body.alias("body"), F.monotonically_increasing_id().alias("at"))
    rows = rows.withColumns({"sha": F.sha1("body"), "n_bytes": F.octet_length("body").cast("long")})
    last = F.lit(2**63 - 1)
    place = F.struct(F.coalesce("page_id", last).alias("p"), F.xxhash64("url").alias("u"), F.col("at").alias("r"))  # r: tells equal rows apart
    # Partial sums leave one row a digest and task; only shared digests stay. A digest that very
    # many pages share is split by Spark's skew join: the other side is one row.
    groups = rows.select("sha", "n_bytes", place.alias("place")).filter(F.col("n_bytes") >= min_bytes)
    groups = groups.groupBy("sha").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written first: where few digests are shared, Spark sees a small table and moves no page.
    groups = common.materialize(groups.select("sha", "first"), "shared-payloads")
    joined = rows.join(groups, "sha", "left")
    later = F.col("first").isNotNull() & (F.col("n_bytes") >= min_bytes) & (place != F.col("first"))
    target = F.when(F.col("first.p") == last, F.lit("")).otherwise(F.col("first.p").cast("string"))
    return joined.select("page_id", "url", "body", "sha", "n_bytes", F.when(later, target).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record for each row of ``pages`` (page_id, url, html) below ``path``."""
    common.prepare(pages.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                payload = b"" if row["refers_to"] is not None else row["body"]
                digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                data = record(row["page_id"], row["url"], payload, row["refers_to"], row["n_bytes"], digest)
                held.append(gzip.compress(data, LEVEL, mtime=0))
                size += len(held[-1])
                if size >= BLOB_BYTES:
                    yield pa.RecordBatch.from_pydict({"blob": [b"".join([*held, _EMPTY])]})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"blob": [b"".join([*held, _EMPTY])]})

    rows = with_types(pages, min_bytes)
    rows = rows.withColumn("body", F.when(F.col("refers_to").isNull(), F.col("body")))  # revisits carry none
    common.write_blobs(rows.mapInArrow(pack, "blob binary"), path, BLOBS_PER_FILE)


def capture_lines(spark: SparkSession, archives: str) -> DataFrame:
    """key, page_id, file, offset, length of every record below ``archives``."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string())])
        schema = schema.append(pa.field("offset", pa.int64())).append(pa.field("length", pa.int64()))
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for offset, length, data in members(content.as_py()):
                    fields = dict(x.split(": ", 1) for x in data.partition(b"\r\n\r\n")[0].decode().split("\r\n") if ": " in x)
                    url = fields.get("WARC-Target-URI")
                    rows.append(
                        {"key": capture_key(url), "page_id": _page(fields["WARC-Record-ID"]), "file": file}
                        | {"offset": offset, "length": length}
                    )
                yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = "key string, page_id long, file string, offset long, length long"
    return common.read_blobs(spark, archives).select("path", "content").mapInArrow(lines, kinds)


def build_index(spark: SparkSession, archives: str, index: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted, compressed blocks below ``index``/blocks and return the directory: one row
    for each block (first, last, file, offset, length), also kept below ``index``/directory."""
    common.prepare(spark)
    lines = common.materialize(capture_lines(spark, archives), "capture-lines")
    order = ["key", "page_id", "file", "offset"]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []

        def blob() -> pa.RecordBatch:
            data = gzip.compress("\n".join(held).encode(), LEVEL, mtime=0) + _EMPTY
            return pa.RecordBatch.from_pydict({"blob": [data]})

        for batch in batches:
            for r in batch.to_pylist():
                shown = "" if r["page_id"] is None else r["page_id"]
                held.append(f"{r['key']} {shown} {r['offset']} {r['length']} {r['file']}")
                if len(held) == block_lines:
                    yield blob()
                    held = []
        if held:
            yield blob()

    common.write_blobs(ordered.mapInArrow(blocks, "blob binary"), f"{index}/blocks", 1000)

    def directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for offset, length, data in members(content.as_py()):
                    lines = data.decode().split("\n")
                    first, last = lines[0].split(" ")[0], lines[-1].split(" ")[0]
                    rows.append({"first": first, "last": last, "file": file, "offset": offset, "length": length})
                yield pa.RecordBatch.from_pylist(rows, _DIRECTORY)

    kinds = "first string, last string, file string, offset long, length long"
    found = common.read_blobs(spark, f"{index}/blocks").select("path", "content").mapInArrow(directory, kinds)
    found = common.materialize(found, "block-directory")
    found.repartitionByRange("first", "last").sortWithinPartitions("first", "last").write.parquet(f"{index}/directory")
    return spark.read.parquet(f"{index}/directory")


_DIRECTORY = pa.schema(
    [("first", pa.string()), ("last", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, which a task cannot know."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()


def store(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system and path for a Hadoop path with its scheme."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(quote(re.sub("^s3[an]://", "s3://", path), safe="/:@"))


def _blocks_of(keys: list[str], directory: pa.Table) -> Iterator[dict]:
    """The blocks that may hold ``keys`` (ascending), each with those of them, by binary search."""
    rows = directory.sort_by([("first", "ascending"), ("last", "ascending")]).to_pylist()
    firsts, lasts = [r["first"] for r in rows], [r["last"] for r in rows]
    asked: dict[int, list[str]] = {}
    for key in keys:
        for at in range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)):
            asked.setdefault(at, []).append(key)
    for at, held in asked.items():
        yield {k: rows[at][k] for k in ("file", "offset", "length")} | {"keys": held}


def _lines_of(keys: list[str], block: bytes) -> Iterator[dict]:
    """The lines of ``keys`` in a block, by binary search."""
    lines = [line.split(" ", 4) for line in block.decode().split("\n")]
    held = [line[0] for line in lines]
    for key in keys:
        for _, _, offset, length, file in lines[bisect.bisect_left(held, key) : bisect.bisect_right(held, key)]:
            yield {"file": file, "offset": int(offset), "length": int(length)}


def _runs(spans: list[dict]) -> Iterator[list[dict]]:
    """Spans of a file in ascending order, grouped into ranges to be read at once."""
    run: list[dict] = []
    for span in spans:
        if run:
            end = run[-1]["offset"] + run[-1]["length"]
            near = span["file"] == run[0]["file"] and 0 <= span["offset"] - end <= GAP_BYTES
            if not near or span["offset"] + span["length"] - run[0]["offset"] > READ_BYTES:
                yield run
                run = []
        run.append(span)
    if run:
        yield run


class Ranges:
    """Byte ranges of files; the last file stays open."""

    def __init__(self) -> None:
        self.path, self.file = "", None

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path != self.path:
            self.close()
            place, inner = store(path)
            self.path, self.file = path, place.open_input_file(inner)
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


_SPAN = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def captures_of(urls: DataFrame, index: str) -> DataFrame:
    """file, offset, length of every record of the URLs in column ``url``, through the directory."""
    spark = urls.sparkSession
    common.prepare(spark)
    directory = qualified(spark, f"{index}/directory")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"key": [capture_key(target_uri(u)) for u in batch.column("url").to_pylist()]})

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, inner = store(directory)
        rows = dataset.dataset(inner, filesystem=place, format="parquet", schema=_DIRECTORY)

        def search(keys: list[str]) -> Iterator[pa.RecordBatch]:
            near = (dataset.field("last") >= keys[0]) & (dataset.field("first") <= keys[-1])
            found = list(_blocks_of(keys, rows.to_table(filter=near, use_threads=False)))
            yield from pa.Table.from_pylist(found, _SPAN.append(pa.field("keys", pa.list_(pa.string())))).to_batches()

        held: list[str] = []
        for batch in batches:
            held += batch.column("key").to_pylist()
            if len(held) >= SEARCH_KEYS:
                yield from search(held)
                held = []
        if held:
            yield from search(held)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        for batch in batches:
            for block in batch.to_pylist():
                data = zlib.decompress(ranges.read(block["file"], block["offset"], block["length"]), 31)
                yield pa.RecordBatch.from_pylist(list(_lines_of(block["keys"], data)), _SPAN)
        ranges.close()

    keys = urls.select("url").mapInArrow(keyed, "key string").distinct()
    ordered = keys.repartitionByRange("key").sortWithinPartitions("key")
    found = ordered.mapInArrow(blocks, "file string, offset long, length long, keys array<string>")
    dealt = found.repartition("file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(lines, "file string, offset long, length long")


def lookup(urls: DataFrame, index: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (empty for revisits) of
    every record of the URLs in column ``url``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        for batch in batches:
            for run in _runs(batch.to_pylist()):
                start, end = run[0]["offset"], run[-1]["offset"] + run[-1]["length"]
                data = ranges.read(run[0]["file"], start, end - start)
                found, size = [], 0
                for span in run:
                    at = span["offset"] - start
                    found.append(parse(zlib.decompress(data[at : at + span["length"]], 31)))
                    size += found[-1]["payload_bytes"]
                    if size >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(found, _RECORD)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, _RECORD)
        ranges.close()

    # The lines say how much is to be read; their own size, by which Spark would coalesce tasks, does not.
    spans = common.materialize(captures_of(urls, index), "captures")
    size = spans.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(urls.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    near = F.floor(F.col("offset") / F.lit(READ_BYTES))
    spans = spans.repartition(tasks, "file", near).sortWithinPartitions("file", "offset")
    kinds = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return spans.mapInArrow(records, f"{kinds}, payload binary")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back by looking up
    the URLs of all pages."""
    archives, index = common.scratch_path(spark, "warc"), common.scratch_path(spark, "warc-index")
    pages = common.table(spark, sf_dir, "pages")
    write_archives(pages, archives)
    build_index(spark, archives, index)
    found = lookup(pages, index)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
