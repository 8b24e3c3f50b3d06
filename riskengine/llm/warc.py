"""WARC archives in Zstandard: a writer that records repeats as revisits, and a validating reader.

An archive starts with a skippable frame that holds its dictionary (trained on its first
records); then comes one frame a record, so a reader decodes one record at a time.  Tasks
write archives of about ``ARCHIVE_BYTES`` to the shared folder under names of their own and
return the names; only the names of tasks that succeeded are read, so a task that is lost and
run again leaves no archive twice.  The reader takes archives, not rows, as its unit and holds
one record of each.

Defined cases: a null payload is empty; a null url gives no target header; an empty table gives
no archive and no records; of pages with equal payloads the smallest id (all rows of it) is the
response, null ids revisit it, and where all ids are null all are responses;
a very long payload is one record; columns beside id, url and payload, whatever their names, are not read.  A malformed
archive fails with its name and the record's number.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

ARCHIVE_BYTES = 16 << 20     # a new archive starts beyond this many payload bytes
READERS = 10_000             # tasks that read archives
SAMPLES, SAMPLE_BYTES = 256, 4 << 20
DICTIONARY_BYTES, LEVEL = 16 << 10, 3
CHUNK = 1 << 20
DATE = "2000-01-01T00:00:00Z"


class WarcError(ValueError):
    """A record or archive that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(uri: str):
    """A file system and path for a local path or any URI that Arrow knows."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


# --- records ----------------------------------------------------------------------------

def encode_record(kind: str, record_id: str, block: bytes, headers: list[tuple[str, str]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), *headers,
            ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """A response, or a revisit of the page ``refers_to``, with the payload's length and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Page-ID", "-" if page_id is None else str(page_id)), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
               ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    return encode_record("response" if refers_to is None else "revisit", name, block, headers)


def decode_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a frame's one record, validated."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("no end of headers")
    version, *lines = head.decode("utf-8").split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"version {version[:20]!r}")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"header {line[:60]!r}")
        headers[name.lower()] = value.strip()
    if missing := [k for k in MANDATORY if not headers.get(k)]:
        raise WarcError(f"no {missing[0]}")
    length = headers["content-length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"content-length {length} and {len(rest) - 4} bytes")
    block = rest[:-4]
    if headers.get("warc-block-digest", "") not in ("", f"sha1:{digest(block)}"):
        raise WarcError("block digest")
    return headers, block


def page_row(headers: dict[str, str], block: bytes) -> tuple | None:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to); None if no page."""
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, gap, payload = block.partition(b"\r\n\r\n")
    sizes = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:]) if k.lower() == b"content-length"]
    if not http.startswith(b"HTTP/") or not gap or len(sizes) != 1 or not sizes[0].strip().isdigit():
        raise WarcError("HTTP headers")
    size, sha = int(sizes[0]), headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (size != len(payload) or sha != digest(payload)):
        raise WarcError("payload length or digest")
    if kind == "revisit" and payload:
        raise WarcError("a revisit with a payload")
    page, refers = headers.get("warc-page-id", "-"), headers.get("warc-refers-to")
    return (None if page == "-" else int(page), headers.get("warc-target-uri"), payload if kind == "response" else None, size,
            sha, kind, int(refers.removeprefix("<urn:page:").rstrip(">")) if refers else None)


# --- archives ---------------------------------------------------------------------------

def write_archive(out, records) -> tuple[int, list]:
    """Write records of (record bytes); the first ones train the dictionary.  Returns their number."""
    first, held = [], 0
    records = iter(records)
    for r in records:
        first.append(r)
        held += len(r)
        if len(first) >= SAMPLES or held >= SAMPLE_BYTES:
            break
    try:
        trained = zstandard.train_dictionary(min(DICTIONARY_BYTES, held // 8), first, k=256, d=8)
    except (zstandard.ZstdError, ValueError):  # too few or too small records: no dictionary
        trained = None
    if trained is not None:
        body = zstandard.ZstdCompressor().compress(trained.as_bytes())
        out.write(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    info = encode_record("warcinfo", f"urn:uuid:{uuid.uuid4()}", b"format: WARC File Format 1.1\r\n",
                         [("Content-Type", "application/warc-fields")])
    n = 0
    for r in (info, *first):
        out.write(packer.compress(r))
        n += 1
    for r in records:
        out.write(packer.compress(r))
        n += 1
    return n - 1


def read_frames(stream):
    """Each record frame of an archive, decoded; the leading skippable frame gives the dictionary."""
    data, dictionary, started = b"", None, False

    def need(n):
        nonlocal data
        while len(data) < n and (more := stream.read(max(CHUNK, n - len(data)))):
            data += more
        return len(data) >= n

    while need(1):
        if not need(4):
            raise WarcError("a cut frame")
        magic = struct.unpack("<I", data[:4])[0]
        if magic in SKIPPABLE:
            if not need(8):
                raise WarcError("a cut frame")
            size = struct.unpack("<I", data[4:8])[0]
            if not need(8 + size):
                raise WarcError("a cut frame")
            body, data = data[8:8 + size], data[8 + size:]
            if magic == DICTIONARY_FRAME and not started:
                if body.startswith(ZSTD_MAGIC):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body)
            started = True
            continue
        started = True
        try:
            unpack, parts = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), []
            while True:
                parts.append(unpack.decompress(data))
                if unpack.eof:
                    data = unpack.unused_data
                    break
                data = stream.read(CHUNK)
                if not data:
                    raise WarcError("a cut frame")
        except zstandard.ZstdError as e:
            raise WarcError(f"frame: {e}") from None
        yield b"".join(parts)


def read_archive(stream, name: str = "archive"):
    """(headers, block) of each record, in order."""
    for i, frame in enumerate(read_frames(stream)):
        try:
            yield decode_record(frame)
        except (WarcError, UnicodeDecodeError) as e:
            raise WarcError(f"{name}, record {i}: {e}") from None


# --- tables -----------------------------------------------------------------------------

def with_roles(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is null for responses.

    Equal payloads are told by SHA-256; the grouped minimum of ids carries no payload, and the
    join back is one that AQE splits where a payload is very common.
    """
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("_same"))
    first = rows.groupBy("_same").agg(F.min("page_id").alias("first"))
    again = (F.octet_length("payload") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "_same").select("page_id", "url", "payload", F.when(again, F.col("first")).alias("refers_to"))


def write_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write rows of :func:`with_roles` to archives in ``folder``: (path, records)."""

    def run(batches):
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row, names, counts = next(rows, None), [], []
        while row is not None:
            where, path = _open(f"{folder}/{uuid.uuid4().hex}.warc.zst")
            where.create_dir(path.rpartition("/")[0], recursive=True)

            def one_archive():
                nonlocal row
                size = 0
                while row is not None and size < ARCHIVE_BYTES:
                    size += len(row[2])
                    yield page_record(*row)
                    row = next(rows, None)

            with where.open_output_stream(path) as out:
                counts.append(write_archive(out, one_archive()))
            names.append(f"{folder}/{path.rpartition('/')[2]}")
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    return pages.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "path string, records long")


PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_pages(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Page rows of the archives (path, records); every archive is checked against its count."""

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PAGE.types, strict=True)],
                                          PAGE.names)

    def run(batches):
        for b in batches:
            for name, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                where, path = _open(name)
                rows, held, n = [], 0, 0
                with where.open_input_stream(path) as stream:
                    for headers, block in read_archive(stream, name):
                        try:
                            row = page_row(headers, block)
                        except WarcError as e:
                            raise WarcError(f"{name}, page {n}: {e}") from None
                        if row is None:
                            continue
                        n += 1
                        rows.append(row if payloads else (*row[:2], None, *row[3:]))
                        held += len(block) if payloads else 200
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if n != records:
                    raise WarcError(f"{name}: {n} pages, {records} written")
                if rows:
                    yield batch(rows)

    # a task for each archive, up to ``READERS`` at once: their names are too few bytes for Spark to spread by itself
    tasks = max(1, min(READERS, archives.count()))
    return archives.repartition(tasks, "path").mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, "
                                                   "payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, min_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Pages written to archives in the scratch folder and read back."""
    scratch = Scratch(pages.sparkSession, "warc")
    archives = scratch.save(write_pages(with_roles(pages, min_bytes), f"{scratch.base}/archives"))
    return read_pages(archives, payloads)
