import hashlib
import os
import random
import struct

import pyarrow.fs as pafs
import zstandard

from seqflow.llm import warc
from seqflow.session import scratch_path

from .data import prose


def sample():
    rng = random.Random(3)
    pages = [(i, f"http://h/{i}?q=a b\r\n%41ü", "<p>" + prose(rng, rng.randint(1, 400)) + "</p>") for i in range(80)]
    pages += [(100 + i, "u", pages[5][2] + "x" * 1000) for i in range(5)] + [(110 + i, "u", "short copy") for i in range(3)]
    pages += [(None, None, "x" * 2000), (120, None, None), (121, "", ""), (122, "u", "long " * 100_000), (123, "u", "é" * 600), (123, "u", "é" * 600), (7, "u", "é" * 600)]
    return pages


def frame(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'extra' AS payload_digest", "1 AS refers_to", "'z' AS _top")


def test_round_trip(spark):
    pages = sample()
    got = warc.round_trip(spark, frame(spark, pages)).collect()
    top = {}
    for i, _, h in pages:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            top[b] = max(i, top.get(b, i))
    exp = []
    for i, _, h in pages:
        b = (h or "").encode()
        t = top.get(b)
        exp.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if t is None or t == i else "revisit", None if t in (None, i) else t))
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got))) == sorted(map(repr, exp))


def test_archives_hold_their_dictionary(spark):
    pages = sample()
    folder = scratch_path(spark, f"warc-test-{os.getpid()}")
    manifest = warc.archive_pages(frame(spark, pages), folder, archive_bytes=20_000)
    rows = manifest.collect()
    assert len(rows) > 1 and sum(r["records"] for r in rows) == len(pages)
    fs, name = pafs.FileSystem.from_uri(rows[0]["archive"])
    raw = fs.open_input_stream(name).read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and size > 0
    words = zstandard.ZstdCompressionDict(raw[8:8 + size])
    at, n = 8 + size, 0
    while at < len(raw):  # every record is a frame of its own
        d = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        block = d.decompress(raw[at:])
        assert block.startswith(b"WARC/1.1\r\nWARC-Type: ") and block.endswith(b"\r\n\r\n")
        at, n = len(raw) - len(d.unused_data), n + 1
    assert n == rows[0]["records"]
    back = {(r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in warc.read_archives(manifest).collect() if r["record_type"] == "response"}
    assert back <= {(i, u, h or "") for i, u, h in pages} and any(u and "\r\n%41" in u for _, u, _ in back)


def test_empty_table_and_no_dictionary(spark):
    assert warc.round_trip(spark, frame(spark, [])).count() == 0
    assert [r["payload_bytes"] for r in warc.round_trip(spark, frame(spark, [(1, "u", ""), (2, "u", None)])).collect()] == [0, 0]
