"""Dictionary-compressed WARC archives (.warc.zst): writer and reader.

A Zstandard dictionary is trained on a bounded, seeded sample of the records to be archived. Every
archive starts with a skippable frame that holds the dictionary; each record follows as a frame of its
own, compressed with it, so that a reader needs nothing beside the archive and can start at any record.
Of records with equal payloads of at least `min_revisit` bytes, the one with the largest id is stored
as response and the others as revisit records that name it.

Scale: digests are grouped first (hot payloads meet only as partial maxima); payloads move in no shuffle
unless the table of repeated digests is too large to broadcast. A task streams its records into archives
of about `archive_bytes`, holding one at a time; a rerun task writes new names, and only the archives in
the manifest table count.

Defined cases: null html is an empty payload; a null URL has no target header; a null id is kept as null
(smallest when copies are compared); of repeated rows with the largest id all are responses; an empty
table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqflow.llm.common import hash_sample, join_checked, written
from seqflow.session import scratch_path

DICT_FRAME = 0x184D2A5D  # skippable frame that holds a dictionary
ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null: a response)."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("payload_bytes"),
                        F.sha1(F.encode(html, "UTF-8")).alias("payload_digest"))
    copies = (rows.where(F.col("payload_bytes") >= min_revisit).groupBy(F.col("payload_digest").alias("_digest"))
              .agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    rows = join_checked(rows, written(copies, "warc-copies"), F.col("payload_digest") == F.col("_digest"), "left")
    refers = F.when(F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top")), F.col("_top"))
    return rows.select("page_id", "url", "html", "payload_bytes", "payload_digest", refers.alias("refers_to"))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        head.append(("WARC-Target-URI", urllib.parse.quote(url, safe="".join(map(chr, range(33, 127))).replace("%", ""))))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(length))]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        payload = b""
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + payload + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or where the samples are too few to train on, their raw content; may be empty."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def sampled_dictionary(rows: DataFrame, sample: int, piece: int, size: int) -> bytes:
    """From the `sample` responses with the smallest seeded hashes, a piece of each at a seeded place."""
    h = F.xxhash64(F.lit("warc"), "page_id", "payload_digest")
    at = F.pmod(h, F.greatest(F.lit(1), F.length("html") - piece + 1)).cast("int")
    some = rows.where(F.col("refers_to").isNull() & (F.length("html") > 0))
    best = hash_sample(some, ["page_id", "payload_digest"], sample, some.count(), "warc-sample")
    got = best.select("page_id", "url", "payload_bytes", "payload_digest", F.substring(F.col("html"), at + 1, F.lit(piece)).alias("piece"))
    return train_dictionary([record_bytes(r.page_id, r.url, r.piece.encode(), r.payload_bytes, r.payload_digest, None) for r in got.collect()], size)


def _open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_archives(rows: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = 1 << 28, level: int = 6) -> DataFrame:
    """Writes the rows of `with_revisits`; the manifest (archive, records, bytes) of what counts."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_fs(folder)
        fs.create_dir(root, recursive=True)
        trained = _dictionary(dictionary)
        if trained:
            trained.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
        out, name, n, size, done = None, "", 0, 0, []
        for b in batches:
            c = {k: b.column(k) for k in b.schema.names}
            for i in range(b.num_rows):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    out, n, size = fs.open_output_stream(f"{root}/{name}"), 0, 0
                    if dictionary:
                        out.write(struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary)
                r = {k: c[k][i].as_py() for k in c}
                frame = packer.compress(record_bytes(r["page_id"], r["url"], r["html"].encode(), r["payload_bytes"],
                                                     r["payload_digest"], r["refers_to"]))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, size))
        yield pa.RecordBatch.from_pydict({"archive": [x[0] for x in done], "records": [x[1] for x in done], "bytes": [x[2] for x in done]},
                                         schema=pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return written(rows.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest", batch_rows=500)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open archive; one record is in memory at a time."""
    head, dictionary = stream.read(4), b""
    if head == struct.pack("<I", DICT_FRAME):
        dictionary, head = stream.read(struct.unpack("<I", stream.read(4))[0]), b""
    else:
        stream = _Rest(head, stream)
    lines = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).stream_reader(stream, read_across_frames=True), 1 << 16)
    while version := lines.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError(f"no WARC record: {version[:40]!r}")
        fields = {}
        while (line := lines.readline()) != b"\r\n":
            k, found, v = line.decode().rstrip("\r\n").partition(": ")
            if not found:
                raise ValueError("archive ends inside a record")
            fields[k] = v
        size = int(fields["Content-Length"])
        block = lines.read(size)
        if lines.read(4) != b"\r\n\r\n":
            raise ValueError("archive ends inside a record")
        yield fields, block


class _Rest:
    """A stream with its first bytes put back."""

    def __init__(self, head: bytes, stream):
        self.head, self.stream = head, stream

    def read(self, n: int = -1) -> bytes:
        head, self.head = self.head, b""
        return head + self.stream.read(n - len(head) if n >= 0 else n)


def _page(urn: str) -> int | None:
    v = urn[len("<urn:page:"):-1]
    return int(v) if v else None


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record; a response whose payload doesn't have its digest is an error. payloads: also
    return the payloads (null for revisits)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
        for b in batches:
            for path in b.column("archive").to_pylist():
                fs, name = _open_fs(path)
                rows, size = [], 0
                with fs.open_input_stream(name) as stream:
                    for f, block in records(stream):
                        digest, kind = f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"]
                        if kind == "response" and hashlib.sha1(block).hexdigest() != digest:
                            raise ValueError(f"{path}: damaged record {f['WARC-Record-ID']}")
                        uri = f.get("WARC-Target-URI")
                        rows.append((_page(f["WARC-Record-ID"]), int(f["X-Payload-Length"]), digest, kind,
                                     _page(f["WARC-Refers-To"]) if kind == "revisit" else None,
                                     None if uri is None else urllib.parse.unquote(uri), block if payloads and kind == "response" else None))
                        size += len(block) if payloads else 0
                        if len(rows) >= 2000 or size > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(zip(*rows), schema)], schema=schema)

    return manifest.select("archive").mapInArrow(read, ROWS)


def archive_pages(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_revisit: int = 1000, sample: int = 1000, piece: int = 8192, dict_bytes: int = 1 << 16,
                  archive_bytes: int = 1 << 28) -> DataFrame:
    """Writes a WARC record for each row to archives in `folder`; the manifest of the archives."""
    rows = with_revisits(pages, id_col, url_col, html_col, min_revisit)
    return write_archives(rows, folder, sampled_dictionary(rows, sample, piece, dict_bytes), archive_bytes)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archives the pages in the shared scratch folder and reads every record back."""
    manifest = archive_pages(pages, scratch_path(spark, f"warc-{uuid.uuid4().hex}"))
    n = max(1, manifest.count())
    return read_archives(manifest.repartition(n, "archive"), payloads=False)


#: the same rows in DuckDB's SQL
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM r
"""
