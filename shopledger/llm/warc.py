"""Web archives with a two-level capture index.

``write`` turns pages into WARC records, each a gzip member of its own, so that a record can
be read by its range. A payload that occurs more than once is stored once; the other
records are revisits of it. ``build_index`` sorts the captures by reversed-host key into
compressed blocks and keeps a sparse directory of the blocks. ``locate`` finds captures by
binary search in the directory and in one block; ``read`` then reads their ranges.

Tasks write files of their own under new names into the shared folder. Only files that a
committed table names belong to the archive, so a task that is run again after an executor
is lost leaves no more than a file that nobody refers to.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import stored

BLOCK_LINES = 3_000
# The directory stays within about this many rows; beyond that, blocks get longer.
DIRECTORY_ROWS = 100_000
FILE_BYTES = 1 << 30
# Repeated payloads are broadcast up to this many (some 100 bytes each), else joined by shuffle.
BROADCAST_PAYLOADS = 50_000
READ_BYTES = 16 << 20
OPEN_FILES = 16
LEVEL = 6

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

_ENTRIES = (
    "key string, page_id long, record_type string, digest string, payload_bytes long, refers_to long, "
    "file string, offset long, length long"
)
_FIELDS = [c.split()[0] for c in _ENTRIES.split(", ")]
_PLACES = "page_id long, key string, file string, offset long, length long"
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


@dataclass
class Archive:
    folder: str
    entries: DataFrame
    directory: DataFrame


def reversed_host_key(url: str | None) -> str:
    """``com,example,news)/path?query``: captures of a host and its subdomains sort together.

    Scheme, ``www.``, port and fragment are left out; null gives an empty key.
    """
    text = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
    rest = text.partition("#")[0].partition("://")[2] or text.partition("#")[0]
    end = min((at for at in (rest.find("/"), rest.find("?")) if at >= 0), default=len(rest))
    host, path = rest[:end], rest[end:]
    host = host.rpartition("@")[2].lower().partition(":")[0].removeprefix("www.")
    return f"{','.join(reversed(host.split('.')))}){'/' * path.startswith('?')}{path}" if text else ""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    """One WARC record; a revisit holds the response's headers only."""
    body = HTTP_HEAD + f"Content-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if revisit:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _record_id(refers_to), "X-Refers-To-Page-Id": str(refers_to)}
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in head.items())]
    return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    body = rest[: int(headers["Content-Length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Files:
    """New files of one task, in one folder; a file is closed when it is large enough."""

    def __init__(self, folder: str, suffix: str):
        self.system, root = fs.FileSystem.from_uri(folder)
        self.system.create_dir(root, recursive=True)
        self.root, self.suffix, self.stream, self.name, self.size = root, suffix, None, "", 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.size >= FILE_BYTES:
            self.close()
            self.name, self.size = f"{uuid.uuid4().hex}{self.suffix}", 0
            self.stream = self.system.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.stream.write(data)
        self.size += len(data)
        return self.name, self.size - len(data), len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


class _Ranges:
    """Range reads from the files of a folder, with few files open at a time."""

    def __init__(self, folder: str):
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.open: OrderedDict[str, pa.NativeFile] = OrderedDict()

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name in self.open:
            self.open.move_to_end(name)
        else:
            if len(self.open) >= OPEN_FILES:
                self.open.popitem(last=False)[1].close()
            self.open[name] = self.system.open_input_file(f"{self.root}/{name}")
        return zlib.decompress(self.open[name].read_at(length, offset), 31)


def _rows(batches: Iterator[pa.RecordBatch], work: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Result rows of a generator of tuples, in batches."""
    rows: list[tuple] = []
    for row in work(batches):
        rows.append(row)
        if len(rows) == 1_000:
            yield _columns(rows, schema)
            rows = []
    if rows:
        yield _columns(rows, schema)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def _with_firsts(pages: DataFrame) -> DataFrame:
    """Pages with the digest of the payload and the smallest page that has the same payload."""
    marked = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("sha1", F.sha1(F.encode("html", "utf-8")))
    repeated = stored(
        marked.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", "first")
    )
    if repeated.count() <= BROADCAST_PAYLOADS:
        repeated = F.broadcast(repeated)
    return marked.join(repeated, "sha1", "left").select("page_id", "url", "html", "sha1", "first")


def write(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes one record per row of ``pages(page_id, url, html, ...)`` and returns the captures.

    A null page is an empty payload. Of equal payloads the one with the smallest id is the
    response; rows that repeat its id are responses too. Rows with a null id revisit a row
    that has one; without such a row they are responses.
    """
    schema = _arrow(_ENTRIES)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        files = _Files(f"{folder}/warc", ".warc.gz")
        for batch in batches:
            pages, urls, firsts, sha1s = (batch.column(n).to_pylist() for n in ("page_id", "url", "first", "sha1"))
            for page, url, first, sha1, html in zip(pages, urls, firsts, sha1s, batch.column("html")):
                payload = html.as_py().encode()
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                revisit = first is not None and page != first
                place = files.add(_gzip(record(page, url, payload, digest, first, revisit, date)))
                kind = "revisit" if revisit else "response"
                yield reversed_host_key(url), page, kind, digest, len(payload), first if revisit else None, *place
        files.close()

    return stored(_with_firsts(pages).mapInArrow(lambda batches: _rows(batches, each, schema), _ENTRIES))


def build_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the captures, sorted by key, as compressed blocks; returns the directory of the blocks."""
    lines = max(block_lines, -(-entries.count() // DIRECTORY_ROWS))
    directory = "first_key string, first_page long, last_key string, last_page long, file string, offset long, length long"
    schema = _arrow(directory)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        files, block = _Files(f"{folder}/index", ".cdx.gz"), []
        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in _FIELDS]):
                block.append(row)
                if len(block) == lines:
                    yield _block(files, block)
                    block = []
        if block:
            yield _block(files, block)
        files.close()

    ordered = entries.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return stored(ordered.select(*_FIELDS).mapInArrow(lambda batches: _rows(batches, each, schema), directory))


def _block(files: _Files, rows: list[tuple]) -> tuple:
    text = "\n".join("\t".join("-" if v is None else str(v) for v in row) for row in rows)
    return *rows[0][:2], *rows[-1][:2], *files.add(_gzip(text.encode()))


def _lines(raw: bytes) -> list[tuple]:
    """Captures of a block: ``(sort key, page_id, file, offset, length)``."""
    found = []
    for line in raw.decode().split("\n"):
        key, page, *_, name, offset, length = line.split("\t")
        page_id = None if page == "-" else int(page)
        found.append((_order(key, page_id), page_id, name, int(offset), int(length)))
    return found


def _order(key: str, page_id: int | None) -> tuple:
    """Sort key of a capture: null ids first, as Spark sorts them."""
    return key, page_id is not None, page_id or 0


def archive(pages: DataFrame, folder: str) -> Archive:
    entries = write(pages, folder)
    return Archive(folder, entries, build_index(entries, folder))


def locate(found: Archive, wanted: DataFrame) -> DataFrame:
    """Captures of ``wanted(page_id, url)``: ``page_id, key, file, offset, length``.

    Each distinct pair is searched once and gives all its captures. The directory fits in
    memory by construction; a task keeps one block at a time, and its keys come in order.
    """
    blocks = sorted(
        (_order(r.first_key, r.first_page), _order(r.last_key, r.last_page), r.file, r.offset, r.length)
        for r in found.directory.collect()
    )
    starts, folder = [b[0] for b in blocks], found.folder
    schema = _arrow(_PLACES)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [reversed_host_key(u) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(keys, pa.string())], ["page_id", "key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ranges, held, lines = _Ranges(f"{folder}/index"), -1, []
        for batch in batches:
            for page, key in zip(batch.column("page_id").to_pylist(), batch.column("key").to_pylist()):
                target = _order(key, page)
                at = bisect_right(starts, target) - 1
                # Equal captures may begin in blocks before the last that starts with them.
                while at > 0 and blocks[at - 1][1] >= target:
                    at -= 1
                while 0 <= at < len(blocks) and blocks[at][0] <= target:
                    if at != held:
                        held, lines = at, _lines(ranges.read(*blocks[at][2:]))
                    i = bisect_left(lines, target, key=lambda line: line[0])
                    while i < len(lines) and lines[i][0] == target:
                        yield page, key, *lines[i][2:]
                        i += 1
                    at += 1

    pairs = wanted.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(keyed, "page_id long, key string")
    ordered = pairs.distinct().repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(lambda batches: _rows(batches, search, schema), _PLACES)


def read(found: Archive, places: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records at ``places``: ``page_id, payload_bytes, payload_digest, record_type, refers_to, payload``.

    Ranges are read in the order of files and offsets. A stored payload that does not have its
    digest is an error. A revisit's payload is null, its size and digest are those of what it
    revisits.
    """
    folder, schema = found.folder, _arrow(_RECORDS)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ranges = _Ranges(f"{folder}/warc")
        for batch in batches:
            for name, offset, length in zip(*[batch.column(n).to_pylist() for n in ("file", "offset", "length")]):
                headers, payload = parse(ranges.read(name, offset, length))
                digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                size, page, refers = (int(headers[n]) if n in headers else None for n in ("X-Payload-Length", "X-Page-Id", "X-Refers-To-Page-Id"))
                if kind == "response" and (base32_sha1(payload) != digest or len(payload) != size):
                    raise ValueError(f"damaged record in {name} at {offset}")
                kept = payload if with_payload and kind == "response" else None
                yield page, size, digest, kind, refers, kept

    parts = max(1, -(-(found.entries.agg(F.sum("length")).first()[0] or 0) // READ_BYTES))
    ordered = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(lambda batches: _rows(batches, each, schema), _RECORDS)


def captures(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages(page_id, url, html, ...)`` as an archive and reads every record back by its index.

    Per row ``page_id, payload_bytes, payload_digest, record_type, refers_to``. Rows stay as they
    are, repeated ones and null ids too (see ``write``); other columns are ignored.
    """
    made = archive(pages, folder)
    return read(made, locate(made, pages), with_payload=False).drop("payload")
