"""WARC archives of pages, and a two-level index of their captures.

Writing. Each page is a record, compressed by itself, so that a range of bytes can be read alone. Of
pages with equal payloads the one with the smallest id is a response; the others are revisits that
name it. Tasks write archives of their own and report each record's place; a repeated task writes
another file, and only files that are reported are ever read.

Index. Captures are sorted by the key of their URL (host reversed, then path and query) and id, and
cut into shards by ranges. A shard is a file of compressed blocks of lines, closed by a sparse
directory with the first key of each block. Only the first keys of the shards, one for each partition
of the sort, are known to every task; a lookup searches them, then the shard's directory, then one
block, each by halves, and reads ranges only.

Files are opened with Arrow's file systems, so archives may lie on any store that they reach.
"""

from __future__ import annotations

import bisect
import itertools
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stored

# The format's version, profile of revisits and line ends.
VERSION, LINE = "WARC/1.1", "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page-record")

#: Payloads of fewer bytes are never revisits; bytes of an archive from which the next is begun;
#: lines of an index block; bytes of an archive that are read by one task.
LEAST_BYTES, ARCHIVE_BYTES, BLOCK_LINES, READ_BYTES = 100, 256 << 20, 256, 8 << 20
#: Time of capture where the pages have none.
DATE = "1970-01-01T00:00:00Z"
#: Effort of the compression.
LEVEL = 4

RECORDS = "page_id long, key string, archive string, offset long, length long, record_type string"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system of a path or address, and the path on it."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    return pafs.FileSystem.from_uri(path)


def url_key(url: Column) -> Column:
    """Key that sorts pages of a host and its subdomains together: ``com,example,www)/path?query``.

    Scheme, user and fragment are left out, the host is in lower case. Without a host the key is the
    address itself; null has the empty key.
    """
    plain = F.regexp_replace(F.coalesce(url, F.lit("")), r"#.*$", "")
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)(.*)$"
    host, rest = F.lower(F.regexp_extract(plain, pattern, 1)), F.regexp_extract(plain, pattern, 2)
    return F.when(host == "", plain).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def typed(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as records to write: payload, digest, record_type, refers_to, key.

    Null html is empty. Repeated rows of the smallest id are responses all; a null id is never the
    smallest.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), url_key(F.col("url")).alias("key"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    large = rows.where(F.octet_length("payload") >= LEAST_BYTES)
    repeated = large.groupBy(F.col("digest").alias("same")).agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    repeated = small(stored(repeated.where("n > 1").select("same", "first")))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(repeated, F.col("digest") == F.col("same"), "left").select(
        "page_id", "url", "key", "payload", F.lower(F.hex("digest")).alias("digest"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One compressed record. A revisit keeps the HTTP head, the payload's length in it, and no payload."""
    head = LINE.join((
        "HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", "",
    )).encode()
    address = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or f"urn:page:{page_id}")
    fields = [
        VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if page_id is not None:
        fields.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        fields += [
            f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}",
        ]
        payload = b""
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(head) + len(payload)}", "", ""]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join((
        packer.compress(LINE.join(fields).encode()), packer.compress(head), packer.compress(payload),
        packer.compress(LINE.encode() * 2), packer.flush(),
    ))


def parse(packed: bytes) -> dict:
    """Fields of a compressed record: page_id, url, record_type, refers_to, digest, payload_bytes, payload."""
    raw = zlib.decompress(packed, 31)
    top, _, rest = raw.partition(b"\r\n\r\n")
    lines = top.decode().split(LINE)
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    number = lambda name: int(fields[name]) if name in fields else None
    kind = fields["WARC-Type"]
    return {
        "page_id": number("WARC-Page-ID"), "url": fields["WARC-Target-URI"], "record_type": kind,
        "refers_to": number("WARC-Refers-To-Page-ID"), "digest": fields["WARC-Payload-Digest"].partition(":")[2],
        "payload_bytes": length, "payload": payload if kind == "response" else None,
    }


def _written(folder: str):
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        rows = (row for batch in batches for row in batch.to_pylist())
        for row in rows:
            # Places are reported once their archive is closed.
            archive, places, offset = f"{uuid.uuid4().hex}.warc.gz", [], 0
            with system.open_output_stream(f"{path}/{archive}", compression=None) as stream:
                while row is not None:
                    packed = record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                    stream.write(packed)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    places.append((row["page_id"], row["key"], archive, offset, len(packed), kind))
                    offset += len(packed)
                    row = next(rows, None) if offset < ARCHIVE_BYTES else None
            yield _batch(places)

    return written


def _batch(places: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*places)) or [()] * 6
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = ["page_id", "key", "archive", "offset", "length", "record_type"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of the pages below a shared folder; the stored places of all records."""
    return stored(typed(pages).mapInArrow(_written(folder), RECORDS))


def _order(key: str, page_id: int | None) -> tuple:
    """Order of captures, as Spark sorts them: by the key's bytes, null ids first."""
    return (key.encode(), page_id is not None, page_id or 0)


def _indexed(folder: str):
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        first = next(rows, None)
        if first is None:
            return
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        shard = f"{uuid.uuid4().hex}.idx"
        directory, lines, offset = [], [], 0
        with system.open_output_stream(f"{path}/{shard}", compression=None) as stream:

            def close() -> int:
                packed = zlib.compress("\n".join(json.dumps(line) for line in lines).encode(), LEVEL)
                stream.write(packed)
                directory.append((*lines[0][:2], offset, len(packed)))
                lines.clear()
                return offset + len(packed)

            for row in itertools.chain([first], rows):
                lines.append((row["key"], row["page_id"], row["archive"], row["offset"], row["length"], row["record_type"]))
                if len(lines) == BLOCK_LINES:
                    offset = close()
            if lines:
                offset = close()
            packed = zlib.compress(json.dumps(directory).encode(), LEVEL)
            stream.write(packed + struct.pack("<Q", len(packed)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([first["key"]]), pa.array([first["page_id"]], pa.int64())],
            names=["shard", "key", "page_id"],
        )

    return indexed


def index(records: DataFrame, folder: str) -> list[tuple[str, int | None, str]]:
    """Index of stored records below a shared folder: first key and id of each shard, and its file, in order.

    There is one shard for each partition of the sort, so the list does not grow with the captures.
    """
    ordered = records.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    shards = stored(ordered.mapInArrow(_indexed(folder), "shard string, key string, page_id long")).collect()
    return sorted(((row["key"], row["page_id"], row["shard"]) for row in shards), key=lambda item: _order(*item[:2]))


class Shard:
    """A shard of the index, of which only the directory and the block used last are held."""

    def __init__(self, folder: str, name: str):
        system, path = filesystem(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        (length,) = struct.unpack("<Q", self.file.read_at(8, size - 8))
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 8 - length)))
        self.starts = [_order(*entry[:2]) for entry in self.directory]
        self.place, self.lines, self.keys = -1, [], []

    def block(self, place: int) -> None:
        if place != self.place:
            _, _, offset, length = self.directory[place]
            text = zlib.decompress(self.file.read_at(length, offset)).decode()
            self.lines = [json.loads(line) for line in text.split("\n")]
            self.keys = [_order(*line[:2]) for line in self.lines]
            self.place = place

    def find(self, wanted: tuple) -> Iterator[list]:
        """Lines of one capture key; equal ones may run over several blocks."""
        place = max(0, bisect.bisect_left(self.starts, wanted) - 1)
        while place < len(self.directory) and self.starts[place] <= wanted:
            self.block(place)
            at = bisect.bisect_left(self.keys, wanted)
            while at < len(self.keys) and self.keys[at] == wanted:
                yield self.lines[at]
                at += 1
            place += 1


def _found(folder: str, shards: list[tuple[str, int | None, str]]):
    starts = [_order(key, page_id) for key, page_id, _ in shards]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Shard] = {}
        for batch in batches:
            places = []
            for key, page_id in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist()):
                wanted = _order(key, page_id)
                at = max(0, bisect.bisect_left(starts, wanted) - 1)
                while at < len(starts) and starts[at] <= wanted:
                    if at not in opened:
                        if len(opened) > 4:
                            opened.clear()
                        opened[at] = Shard(folder, shards[at][2])
                    places += [(line[1], line[0], *line[2:]) for line in opened[at].find(wanted)]
                    at += 1
            yield _batch(places)

    return found


def lookup(requests: DataFrame, folder: str, shards: list[tuple[str, int | None, str]]) -> DataFrame:
    """Places of the captures of distinct requests (key, page_id); one that is not indexed has none."""
    wanted = requests.select("key", "page_id").distinct()
    return wanted.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id").mapInArrow(
        _found(folder, shards), RECORDS
    )


def _fetched(folder: str):
    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        name, file = None, None
        kinds = {
            "page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
            "digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary(),
        }
        for batch in batches:
            rows, size = [], 0
            for row in batch.to_pylist():
                if row["archive"] != name:
                    name, file = row["archive"], system.open_input_file(f"{path}/{row['archive']}")
                rows.append(parse(file.read_at(row["length"], row["offset"])))
                size += rows[-1]["payload_bytes"]
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return fetched


def read(places: DataFrame, folder: str) -> DataFrame:
    """Records at these places: page_id, url, record_type, refers_to, digest, payload_bytes, payload.

    Each task reads neighbouring ranges in order. The payload of a revisit is null, its digest and
    length are those of the payload it stands for.
    """
    near = places.repartition("archive", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("archive", "offset")
    shape = (
        "page_id long, url string, record_type string, refers_to long, digest string, payload_bytes long, payload binary"
    )
    return near.select("archive", "offset", "length").mapInArrow(_fetched(folder), shape)
