"""WARC archives: revisit records, one-stream gzip files, their normaliser and record reader.

A task writes its records to archives that are one gzip stream each. The normaliser inflates such
a stream once, from start to end, writes every record as a gzip member of its own, and writes a
sidecar index with the offset and length of each. The reader then opens single records.

File names carry a random part, so that a task that runs again never meets its own first try. Only
files named in the stored manifest are read further; the manifest lists those of committed tasks.

Cases: a null payload is an empty payload. Rows that repeat both key and payload are all
responses, as a revisit cannot refer to its own key. A null key is a response only when no row
with that payload has a key. An empty table gives no archives and no rows. Columns besides key,
url and payload are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.session import scratch

ARCHIVE_BYTES = 16 << 20  # records of an archive before compression; a larger record has its own
BLOCK = 1 << 20
MAX_TASKS = 50_000  # archives are dealt to as many tasks as there are archives, up to this
DATE = "2000-01-01T00:00:00Z"  # one date for all records, so that archives can be compared
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "archive string, records long, payload_bytes long"
INDEX = "archive string, offset long, length long, key long, record_type string"
RECORD = "key long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a shared folder, the same on the driver and on executors."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def base32_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def with_revisits(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """key, url, payload, record_type and refers_to of each row.

    Of the rows with equal payloads of at least ``min_bytes`` bytes, the one with the smallest key
    is the response. Payloads are told apart by SHA-1 and size; the smallest keys are aggregated
    before the join, and a payload with a third of all rows is split by the adaptive join.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"),
        F.sha1(F.encode(body, "UTF-8")).alias("digest"), F.octet_length(body).cast("long").alias("size"),
    )
    first = rows.groupBy("digest", "size").agg(F.min("key").alias("first"))
    joined = rows.join(first, ["digest", "size"])
    response = (F.col("size") < min_bytes) | F.col("key").eqNullSafe(F.col("first"))
    return joined.select(
        "key", "url", "payload", F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("first")).alias("refers_to"),
    )


def record_bytes(key: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit holds the HTTP head alone and names the response's record."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or f"urn:page:{key}"
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{key}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_digest(hashlib.sha1(payload).digest())}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        fields[6:6] = [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(fields).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def head_of(data: bytes | bytearray) -> tuple[dict[str, str], int] | None:
    """The named fields of a record and where its block starts; None while the head is cut short."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    version, *lines = bytes(data[:end]).decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record starts with {version[:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, end + 4


def records_of(stream: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an inflated stream, each whole with its closing blank lines."""
    held = bytearray()
    need = 0
    for part in stream:
        held += part
        while len(held) >= need and (found := head_of(held)):
            fields, start = found
            need = start + int(fields["content-length"]) + 4
            if len(held) < need:
                break
            yield fields, bytes(held[:need])
            del held[:need]
            need = 0
    if held.strip():
        raise ValueError(f"{len(held)} bytes after the last whole record")


def inflated(source) -> Iterator[bytes]:
    """The inflated bytes of a gzip file, block by block, over all its members."""
    engine = zlib.decompressobj(31)
    while data := source.read(BLOCK):
        while data:
            yield engine.decompress(data)
            data = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)


def _key(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "None" else int(text)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one-stream gzip archives to a shared folder; a stored manifest of them."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        sink = engine = None
        name, n, size, total = "", 0, 0, 0

        def done() -> pa.RecordBatch:
            sink.write(engine.flush())
            sink.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [n], "payload_bytes": [total]})

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "url", "payload", "record_type", "refers_to")]
            for row in range(batch.num_rows):
                key, url, payload, kind, refers_to = (c[row].as_py() for c in columns)
                payload = payload.encode("utf-8")
                data = record_bytes(key, url, payload, refers_to, kind == "revisit")
                if sink is not None and size + len(data) > archive_bytes:
                    yield done()
                    sink = None
                if sink is None:
                    name, n, size, total = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0, 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    engine = zlib.compressobj(1, zlib.DEFLATED, 31)
                sink.write(engine.compress(data))
                n, size, total = n + 1, size + len(data), total + len(payload)
        if sink is not None:
            yield done()

    return stored(records.mapInArrow(write, MANIFEST), "warc-manifest")


def normalise(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite one-stream archives with a gzip member per record; the stored offset index.

    Each archive also gets a sidecar ``<archive>.idx``: a line per record with offset, length,
    key and type, tab-separated.
    """

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(source)
        out_store, out = store_of(target)
        out_store.create_dir(out, recursive=True)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                name, at, rows = f"norm-{uuid.uuid4().hex}.warc.gz", 0, []
                with (
                    store.open_input_stream(f"{root}/{archive}", compression=None) as data,
                    out_store.open_output_stream(f"{out}/{name}", compression=None) as sink,
                ):
                    for fields, record in records_of(inflated(data)):
                        engine = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = engine.compress(record) + engine.flush()
                        sink.write(member)
                        rows.append((at, len(member), _key(fields["warc-record-id"]), fields["warc-type"]))
                        at += len(member)
                with out_store.open_output_stream(f"{out}/{name}.idx", compression=None) as sidecar:
                    sidecar.write("".join("\t".join(map(str, r)) + "\n" for r in rows).encode())
                columns = [pa.array(c) for c in zip(*rows)] if rows else []
                if columns:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(rows)), columns[0], columns[1], columns[2].cast("int64"), columns[3]],
                        ["archive", "offset", "length", "key", "record_type"],
                    )

    spread = manifest.select("archive").repartition(max(1, min(manifest.count(), MAX_TASKS)))
    return stored(spread.mapInArrow(rewrite, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Open each indexed record at its offset; payload size and digest are taken from the payload.

    The digest of a response must equal the one in its head. A revisit has no payload; its size
    and digest are those its head states.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != name:
                    name, source = archive, store.open_input_file(f"{root}/{archive}")
                source.seek(offset)
                record = zlib.decompress(source.read(length), 31)
                fields, start = head_of(record)
                block = record[start : start + int(fields["content-length"])]
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                size, refers_to = int(fields["x-payload-length"]), None
                if fields["warc-type"] == "revisit":
                    refers_to = _key(fields["warc-refers-to"])
                else:
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    found = base32_digest(hashlib.sha1(payload).digest())
                    if (len(payload), found) != (size, digest):
                        raise ValueError(f"{archive} at {offset}: payload differs from its head")
                rows.append((_key(fields["warc-record-id"]), size, digest, fields["warc-type"], refers_to))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    tasks = max(1, min(index.select("archive").distinct().count(), MAX_TASKS))
    spread = index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")
    return spread.sortWithinPartitions("archive", "offset").mapInArrow(read, RECORD)


def archive_pages(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None,
) -> DataFrame:
    """Write pages as archives, normalise them, and read every record back: a row per page."""
    root = folder or scratch(pages.sparkSession, "warc")
    records = with_revisits(pages, key, url, payload, min_bytes)
    manifest = write_archives(records, f"{root}/streams", archive_bytes)
    index = normalise(manifest, f"{root}/streams", f"{root}/records")
    return read_records(index, f"{root}/records").withColumnRenamed("key", key)
