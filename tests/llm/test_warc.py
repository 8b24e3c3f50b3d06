"""WARC: round trips, revisits, the format's rules and damaged archives."""

from __future__ import annotations

import base64
import hashlib
import io
import struct

import pytest
import zstandard

from riskengine.llm import warc
from riskengine.llm.common import Scratch

PAGES = "page_id long, url string, html string, payload int, first int, path string, _same int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], PAGES)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [(3, "http://a/1", "<p>one</p>"), (1, "http://a/2", "<p>one</p>"), (2, None, None), (5, "http://b/\n x", ""),
        (4, "http://c", "é" * 70_000), (9, "u", "short"), (None, "u", "<p>one</p>"), (None, "v", "alone"), (1, "http://a/2", "<p>one</p>")]


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_round_trip(spark, min_bytes):
    got = sorted(map(str, [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                            None if r.payload is None else bytes(r.payload))
                           for r in warc.round_trip(pages(spark, ROWS), min_bytes, payloads=True).collect()]))
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in ROWS:
        body = (h or "").encode()
        least = first.get(h or "")
        again = least is not None and i != least and len(body) >= min_bytes
        want.append(str((i, len(body), sha(h), "revisit" if again else "response", least if again else None,
                         None if again else body)))
    assert got == sorted(want)


def test_many_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"http://h/{i}", f"<html>{'body %d ' % i * (1 + i % 50)}</html>") for i in range(300)]
    scratch = Scratch(spark, "test")
    archives = scratch.save(warc.write_pages(warc.with_roles(pages(spark, rows)), f"{scratch.base}/a"))
    assert archives.count() > 10 and archives.agg({"records": "sum"}).first()[0] == 300
    got = warc.read_pages(archives)
    assert {(r.page_id, r.url, bytes(r.payload).decode()) for r in got.collect()} == set(rows)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []


def archive(records, **kw):
    out = io.BytesIO()
    warc.write_archive(out, iter(records))
    return out.getvalue()


RECORDS = [warc.page_record(i, f"http://x/{i}", (f"<html><body>page {i} " + "same words " * 40).encode(), None) for i in range(300)]


def test_leading_frame_holds_the_dictionary():
    data = archive(RECORDS)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompressobj().decompress(data[8:8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
    assert first.decompress(data[8 + size:]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    with pytest.raises(warc.WarcError):  # without its dictionary a frame can't be read
        list(warc.read_archive(io.BytesIO(data[8 + size:])))
    raw = trained.as_bytes()  # a dictionary that isn't compressed is as good
    again = struct.pack("<II", 0x184D2A5D, len(raw)) + raw + data[8 + size:]
    assert len(list(warc.read_archive(io.BytesIO(again)))) == 301


def test_one_frame_for_each_record():
    frames = list(warc.read_frames(io.BytesIO(archive(RECORDS))))
    assert len(frames) == 301 and frames[1:] == RECORDS
    assert list(warc.read_frames(io.BytesIO(archive(RECORDS[:2]))))[1:] == RECORDS[:2]   # too few for a dictionary
    assert list(warc.read_frames(io.BytesIO(b""))) == []


@pytest.mark.parametrize("cut", [1, 3, 7, 100, -1, -5])
def test_cut_archives_fail(cut):
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(archive(RECORDS)[:cut])))


def bad(old, new, count=1):
    assert old in RECORDS[0]
    return RECORDS[0].replace(old, new, count)


@pytest.mark.parametrize("record", [
    bad(b"WARC/1.1", b"WARC/9.9"), bad(b"WARC-Date: ", b"X-Date: "), bad(b"WARC-Type: response\r\n", b""),
    bad(b"WARC-Record-ID: <urn:page:0>", b"WARC-Record-ID: "), bad(b"page 0", b"page 00"), bad(b"page 0", b"page 1"),
    RECORDS[0][:-1], RECORDS[0] + b"x", RECORDS[0] * 2, b"", b"no headers", bad(b"WARC-Type: ", b"WARC-Type "),
    RECORDS[0].replace(b"Content-Length: ", b"Content-Length: -"), bad(b"WARC-Date", b"WARC-\xff\xfe")])
def test_malformed_records_fail(record):
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(zstandard.ZstdCompressor().compress(record))))


def test_payload_is_checked():
    head, block = warc.decode_record(RECORDS[0])
    assert warc.page_row(head, block)[0] == 0
    with pytest.raises(warc.WarcError):
        warc.page_row({**head, "warc-payload-digest": "sha1:" + "A" * 32}, block)
    with pytest.raises(warc.WarcError):
        warc.page_row(head, block[:-1])
    with pytest.raises(warc.WarcError):
        warc.page_row({**head, "warc-type": "revisit"}, block)
