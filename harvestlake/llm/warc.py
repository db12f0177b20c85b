"""WARC archives and a two-level capture index.

Pages become WARC records, each a gzip member of its own in a file of the shared folder.
The captures are sorted by their reversed-host URL key into shards; a shard is a run of
compressed blocks of lines, followed by its directory with the first key and the place of
each block. A lookup finds the shard among the first keys of the shards, reads the shard's
directory, finds the block by binary search, reads that range, finds the lines by binary
search, and reads the records by their ranges.

Files are written by tasks under names that no other attempt uses, and count only through
the rows that the task hands back. What a lost or repeated attempt left is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.llm.common import scratch_path, small_batches, stage, text_of
from harvestlake.operators.joins import join_to_one

#: Lines of one index block.
BLOCK_LINES = 1000
#: A task starts a new archive file beyond so many bytes.
FILE_BYTES = 1 << 30
#: First keys of shards that a lookup sends along; more are refused. One per range partition.
MAX_SHARDS = 200_000

_DATE = "1970-01-01T00:00:00Z"
_ID = "urn:page:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str):
    """The file system and path of a folder or file in the shared folder."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
    return fs.LocalFileSystem(), uri


def read_range(files: dict, uri: str, offset: int, length: int) -> bytes:
    """A byte range of a file; ``files`` keeps the last one open."""
    if uri not in files:
        for other in files.values():
            other.close()
        files.clear()
        system, path = file_system(uri)
        files[uri] = system.open_input_file(path)
    return files[uri].read_at(length, offset)


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then path and query; null gives ''.

    Scheme, credentials and default ports don't count, and case of the host doesn't.
    """
    text = (url or "").strip()
    try:
        parts = urlsplit(text if "//" in text else "//" + text)
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return quote(text, safe="/:?&=%,.;@()-_~!*'")
    labels = ",".join(reversed(host.split("."))) if host else ""
    shown = f":{port}" if port not in (None, 80, 443) else ""
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return quote(f"{labels}{shown}){rest}", safe="/:?&=%,.;@()-_~!*'") if text else ""


def digest_of(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record(page: str, url: str, payload: bytes, digest: str, refers_to: str | None, refers_url: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("ascii") + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{page}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        head.append(f"WARC-Target-URI: {url}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
        if refers_url:
            head.append(f"WARC-Refers-To-Target-URI: {refers_url}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers of a record (lower-case names) and its HTTP payload."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


class _Writer:
    """Files of one task attempt, written one after another."""

    def __init__(self, folder: str, suffix: str, limit: int):
        context = TaskContext.get()
        self.name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        self.suffix, self.limit, self.number = suffix, limit, 0
        self.stream = None
        self.uri, self.at = "", 0

    def write(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is None or (self.at and self.at + len(data) > self.limit):
            self.close()
            self.uri = f"{self.name}-{self.number:03d}{self.suffix}"
            system, path = file_system(self.uri)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.stream, self.at, self.number = system.open_output_stream(path, compression=None), 0, self.number + 1
        place = (self.uri, self.at, len(data))
        self.stream.write(data)
        self.at += len(data)
        return place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def _one_line(url: str | None) -> str:
    return quote(url or "", safe="".join(map(chr, range(33, 127))))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and return the captures, read from a table.

    A capture has page_id, url, key, file, offset, length. Null html is an empty payload. Of
    equal payloads of at least ``min_bytes`` bytes, the page with the smallest id is the
    response and others are revisits of it; shorter payloads are responses. Rows that repeat
    the smallest id are responses each; rows without an id refer to a page that has one, and
    are responses where none has. An empty table gives an empty table and no file.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_of("html").alias("html"),
    ).withColumn("sha1", F.sha1("html"))
    first = (
        rows.where(F.octet_length("html") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("first"))
        .select("sha1", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )
    rows = join_to_one(rows, first, ["sha1"]).select("page_id", "url", "html", "first_id", "first_url")

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = _Writer(folder, ".warc.gz", FILE_BYTES)
        for frame in frames:
            out = []
            for page, url, html, first_id, first_url in frame.itertuples(index=False, name=None):
                page = None if pd.isna(page) else int(page)
                first_id = None if pd.isna(first_id) else int(first_id)
                payload = html.encode("utf-8", "surrogatepass")
                again = first_id is not None and first_id != page
                record = _record(
                    "" if page is None else str(page), _one_line(url), payload, digest_of(payload),
                    str(first_id) if again else None, _one_line(first_url) if again else None,
                )
                place = writer.write(gzip.compress(record, 6, mtime=0))
                out.append((page, url, url_key(url), *place))
            yield pd.DataFrame(out, columns=["page_id", "url", "key", "file", "offset", "length"]).astype(
                {"page_id": "Int64"}
            )
        writer.close()

    return stage(
        rows.mapInPandas(
            written, "page_id long, url string, key string, file string, offset long, length long"
        ),
        "captures",
    )


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted shards; returns one row per shard: first_key, file, directory place.

    A key that very many captures share is spread over several blocks and shards.
    """

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = _Writer(folder, ".cdx.gz", 1 << 62)
        directory: list[list] = []
        lines: list[str] = []
        firsts: list[str] = []

        def flush() -> None:
            block = gzip.compress("\n".join(lines).encode("utf-8"), 6, mtime=0)
            _, offset, length = writer.write(block)
            directory.append([firsts[0], offset, length])
            lines.clear()
            firsts.clear()

        for frame in frames:
            for page, key, file, offset, length in frame.itertuples(index=False, name=None):
                firsts.append(key)
                lines.append(key + " " + json.dumps([None if pd.isna(page) else int(page), file, offset, length]))
                if len(lines) >= block_lines:
                    flush()
        if lines:
            flush()
        if directory:
            listed = gzip.compress(json.dumps(directory).encode("utf-8"), 6, mtime=0)
            uri, at, size = writer.write(listed)
            yield pd.DataFrame(
                [(directory[0][0], uri, at, size)], columns=["first_key", "file", "offset", "length"]
            )
        writer.close()

    ordered = captures.select("page_id", "key", "file", "offset", "length").repartitionByRange(
        "key", "file", "offset"
    )
    ordered = ordered.sortWithinPartitions("key", "file", "offset")
    return stage(
        ordered.mapInPandas(shards, "first_key string, file string, offset long, length long"), "shards"
    )


class _Shard:
    """The directory of one shard and its blocks, read by ranges."""

    def __init__(self, files: dict, file: str, offset: int, length: int):
        self.files, self.file = files, file
        listed = json.loads(gzip.decompress(read_range(files, file, offset, length)))
        self.keys = [k.encode("utf-8") for k, _, _ in listed]
        self.places = [(o, n) for _, o, n in listed]
        self.at, self.lines, self.line_keys = -1, [], []

    def _load(self, block: int) -> None:
        if block != self.at:
            data = gzip.decompress(read_range(self.files, self.file, *self.places[block]))
            self.lines = [line.partition(b" ") for line in data.split(b"\n")]
            self.line_keys = [k for k, _, _ in self.lines]
            self.at = block

    def find(self, key: bytes) -> Iterator[list]:
        # The first block that may hold the key is the last one that begins below it.
        block = max(bisect_left(self.keys, key) - 1, 0)
        while block < len(self.keys) and self.keys[block] <= key:
            self._load(block)
            for i in range(bisect_left(self.line_keys, key), bisect_right(self.line_keys, key)):
                yield json.loads(self.lines[i][2])
            block += 1


#: Bytes of archive that one task reads records from.
READ_BYTES = 16 << 20


def lookup(keys: DataFrame, shards: DataFrame) -> DataFrame:
    """Captures of the ``key`` column of ``keys``: key, page_id, file, offset, length.

    Keys count once; keys without a capture give no row. A key whose captures fill several
    shards is looked up in each of them by a task of its own.
    """
    rows = shards.orderBy("first_key", "file").limit(MAX_SHARDS + 1).collect()
    if len(rows) > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards; build the index with fewer partitions")
    rows.sort(key=lambda r: r["first_key"].encode("utf-8"))
    firsts = [r["first_key"].encode("utf-8") for r in rows]
    places = [(r["file"], r["offset"], r["length"]) for r in rows]
    shared = keys.sparkSession.sparkContext.broadcast((firsts, places))

    def located(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts, _ = shared.value
        for frame in frames:
            out = []
            for key in frame["key"]:
                raw = key.encode("utf-8")
                low = max(bisect_left(firsts, raw) - 1, 0)
                out += [(key, shard) for shard in range(low, bisect_right(firsts, raw))]
            yield pd.DataFrame(out, columns=["key", "shard"])

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, places = shared.value
        files: dict = {}
        number, shard = -1, None
        for frame in frames:
            out = []
            for key, wanted in frame.itertuples(index=False, name=None):
                if wanted != number:
                    number, shard = wanted, _Shard(files, *places[wanted])
                out += [(key, *capture) for capture in shard.find(key.encode("utf-8"))]
            yield pd.DataFrame(out, columns=["key", "page_id", "file", "offset", "length"]).astype(
                {"page_id": "Int64", "offset": "int64", "length": "int64"}
            )

    asked = keys.select("key").where(F.col("key").isNotNull()).distinct()
    asked = asked.mapInPandas(located, "key string, shard int")
    # Neighbouring keys share shards and blocks; a shard with many keys is cut between them.
    # The count is given, as the few bytes of a key say nothing of the blocks that are read for it.
    asked = asked.repartitionByRange(max(1, len(rows)), "shard", "key").sortWithinPartitions("shard", "key")
    return asked.mapInPandas(found, "key string, page_id long, file string, offset long, length long")


def read_records(captures: DataFrame) -> DataFrame:
    """The records at the captures' places, as they are in the archives.

    Columns: page_id, record_type, payload_digest, refers_to (from the headers), payload
    (null for revisits) and payload_bytes; the digest of a response is that of the payload
    read, and differs from its header only in a damaged file, which is an error.
    """
    small_batches(captures.sparkSession)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files: dict = {}
        number = lambda v: int(v.strip("<>").removeprefix(_ID)) if v and v.strip("<>") != _ID else None
        for frame in frames:
            out = []
            for file, offset, length in zip(frame["file"], frame["offset"], frame["length"], strict=True):
                headers, payload = parse_record(read_range(files, file, int(offset), int(length)))
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                if kind == "response" and digest_of(payload) != digest:
                    raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
                out.append(
                    (
                        number(headers["warc-record-id"]), kind, digest, number(headers.get("warc-refers-to")),
                        payload if kind == "response" else None, len(payload) if kind == "response" else None,
                    )
                )
            names = ["page_id", "record_type", "payload_digest", "refers_to", "payload", "payload_bytes"]
            yield pd.DataFrame(out, columns=names).astype(
                {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"}
            )

    wanted = stage(captures.select("file", "offset", "length"), "captures")
    # As many tasks as the bytes of archive ask for, not as these narrow rows would give.
    size = wanted.agg(F.sum("length")).first()[0] or 0
    ordered = wanted.repartitionByRange(max(1, -(-size // READ_BYTES)), "file", "offset")
    return ordered.sortWithinPartitions("file", "offset").mapInPandas(
        read,
        "page_id long, record_type string, payload_digest string, refers_to long, payload binary, payload_bytes long",
    )


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write ``pages``, index them, look every URL up and read the records back.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Facts
    of a revisit's payload are those of the response it refers to.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    captures = write_archives(pages, f"{folder}/archive", min_bytes)
    shards = build_index(captures, f"{folder}/index", block_lines)
    found = lookup(captures.select("key"), shards)
    records = stage(read_records(found).drop("payload"), "records")
    sizes = records.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("digest")
    )
    # Rows that repeat a page are alike in digest; one stands for them.
    sizes = sizes.groupBy("refers_to", "digest").agg(F.min("size").alias("size"))
    revisits = records.where("record_type = 'revisit'").withColumnRenamed("payload_digest", "digest")
    revisits = join_to_one(revisits, sizes, ["refers_to", "digest"]).select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return records.where("record_type = 'response'").select(*columns).unionByName(revisits)

