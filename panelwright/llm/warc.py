"""WARC archives: written as one gzip stream each, normalised to one member per record with an index beside, read back.

A whole-file gzip stream has to be inflated from its start to reach any record. The normaliser inflates it once, writes every
record as a gzip member of its own, and notes where each member lies in a sidecar index, one JSON line per record; from then
on any record is one ranged read.

Files are opened by URI in the tasks that write them, in the shared folder. Each attempt of a task takes fresh names, and only
files named in a committed manifest count, so lost or repeated tasks leave nothing behind that is read.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import join_bounded, python_tasks, staged
from panelwright.session import shared_path

#: Bytes of records after which a task starts another archive, and of a read.
ARCHIVE_BYTES, READ_BYTES = 64 << 20, 1 << 18
#: Payloads below this size are never replaced by a revisit.
LEAST_REVISIT = 1000
_GZIP = 31  # zlib's window bits for a gzip frame
# Fixed values of the format.
_VERSION, _END = b"WARC/1.1\r\n", b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "<urn:x-page:%s>"
_INDEX = "archive string, offset long, length long, page_id long, record_type string"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit has the HTTP header alone; its payload is that of the record it refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_ID % page_id}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_ID % refers_to}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return _VERSION + "\r\n".join(lines).encode() + _END + block + _END


def headers(head: bytes) -> dict[str, str]:
    """Named fields of a record's head, names in lower case."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in pieces."""
    stream = zlib.decompressobj(_GZIP)
    for chunk in chunks:
        while chunk:
            yield stream.decompress(chunk)
            chunk = stream.unused_data if stream.eof else b""
            if stream.eof:
                stream = zlib.decompressobj(_GZIP)


def records(pieces: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Head and block of each record of an inflated archive; a cut-off archive fails."""
    buffer = bytearray()
    source = iter(pieces)

    def fill(n: int) -> None:
        while len(buffer) < n:
            piece = next(source, None)
            if piece is None:
                raise ValueError("archive ends inside a record")
            buffer.extend(piece)

    while True:
        while not buffer:
            piece = next(source, None)
            if piece is None:
                return
            buffer.extend(piece)
        searched = 0
        while (at := buffer.find(_END, searched)) < 0:
            searched = max(0, len(buffer) - 3)
            fill(len(buffer) + 1)
        head = bytes(buffer[:at])
        size = int(headers(head)["content-length"])
        stop = at + len(_END) + size + len(_END)
        fill(stop)
        yield head, bytes(buffer[at + len(_END) : stop - len(_END)])
        del buffer[:stop]


def _page(name: str | None) -> int | None:
    return int(name[len("<urn:x-page:") : -1]) if name and name != _ID % None else None


def _create(folder: str, suffix: str):
    """A new file of a name no other attempt has: its URI and an open stream."""
    uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None, buffer_size=1 << 20)


def _chunks(uri: str) -> Iterator[bytes]:
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        while chunk := f.read(READ_BYTES):
            yield chunk


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = packer = uri = None
        n = size = 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [uri], "records": [n], "size": [size]})

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"))):
                if out is None:
                    uri, out = _create(folder, ".warc.gz")
                    packer, n, size = zlib.compressobj(1, zlib.DEFLATED, _GZIP), 0, 0
                data = record(*(v.as_py() for v in row), date)
                out.write(packer.compress(data))
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def _normalise(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("archive").to_pylist():
                uri, out = _create(folder, ".warc.gz")
                rows, at = [], 0
                with out:
                    for head, block in records(inflated(_chunks(source))):
                        packer = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                        member = b"".join([packer.compress(head + _END + block + _END), packer.flush()])
                        out.write(member)
                        named = headers(head)
                        rows.append((uri, at, len(member), _page(named["warc-record-id"]), named["warc-type"]))
                        at += len(member)
                system, path = fs.FileSystem.from_uri(uri)
                with system.open_output_stream(path + ".idx", compression=None) as sidecar:
                    for _, offset, length, page, kind in rows:
                        line = {"offset": offset, "length": length, "page_id": page, "type": kind}
                        sidecar.write(json.dumps(line).encode() + b"\n")
                names = ["archive", "offset", "length", "page_id", "record_type"]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def sidecar(archive: str) -> list[dict]:
    """The index beside a normalised archive."""
    system, path = fs.FileSystem.from_uri(archive)
    with system.open_input_file(path + ".idx") as f:
        return [json.loads(line) for line in f.read().splitlines()]


def _read(with_payload: bool):
    def parsed(member: bytes) -> tuple:
        head, block = next(records([zlib.decompress(member, _GZIP)]))
        named = headers(head)
        http, _, payload = block.partition(_END)
        digest = base64.b32decode(named["warc-payload-digest"].partition(":")[2]).hex()
        length = int(headers(http)["content-length"])
        if named["warc-type"] == "response" and length != len(payload):
            raise ValueError(f"payload of {named['warc-record-id']} is cut")
        return (
            _page(named["warc-record-id"]), named.get("warc-target-uri"), length, digest, named["warc-type"],
            _page(named.get("warc-refers-to")), payload if with_payload and named["warc-type"] == "response" else None,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                system, path = fs.FileSystem.from_uri(archive)
                with system.open_input_file(path) as f:
                    rows = []
                    for entry in sidecar(archive):
                        rows.append(parsed(f.read_at(entry["length"], entry["offset"])))
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``page_id, url, html`` and return the manifest ``archive, records, size``.

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more those with
    the greatest page id are responses (all rows that tie on it, and all rows if none has an id); the others are revisits. Each
    archive is a single gzip stream of about ``ARCHIVE_BYTES``. ``date`` is the record date, as pages carry none.

    Digests are counted map-side before they are shuffled; pages move only if repeated digests are too many to broadcast, and
    then a hot digest is split by the adaptive join.
    """
    python_tasks(pages.sparkSession)
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    large = full.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest")
    repeated = large.agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null").drop("n")
    placed = join_bounded(full, staged(repeated, "digests"), ["payload_digest"])
    earlier = F.coalesce(F.col("page_id") < F.col("last"), F.col("last").isNotNull())
    rows = placed.withColumn("refers_to", F.when(earlier, F.col("last"))).drop("last")
    return staged(rows.mapInArrow(_write(folder, date), "archive string, records long, size long"), "archives")


def normalise(manifest: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite each archive of the manifest as one gzip member per record, with ``<archive>.idx`` beside it.

    Returns the index ``archive, offset, length, page_id, record_type``. Archives of several members are read as well. One task
    per archive; memory is bounded by the longest record.
    """
    python_tasks(manifest.sparkSession)
    n = max(1, manifest.count())
    spread = manifest.select("archive").repartition(n)
    return staged(spread.mapInArrow(_normalise(folder, level), _INDEX), "index")


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of normalised archives, each read at its place: ``page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload``. Sizes and digests are those of the full payload, also for revisits."""
    archives = index.select("archive").distinct()
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return archives.repartition(max(1, archives.count()), "archive").mapInArrow(_read(with_payload), schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back a table of pages, in fresh folders of the shared folder."""
    base = shared_path(pages.sparkSession, "llm-warc")
    return read_records(normalise(write_archives(pages, f"{base}/whole"), f"{base}/members"), with_payload=False)
