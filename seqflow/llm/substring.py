"""Substring deduplication with content-defined chunks.

A gear rolling hash over the last 16 bytes cuts a text after white space where the hash is small, at least
`MIN` bytes after the last cut; the cuts depend on the nearby text only, so an insertion moves no later cut.
Digests are taken over two chunks in a row, so that short chunks alike by chance don't count. Of equal digests
the occurrence in the smallest doc_id, and there the first, stays; the others are duplicates. Runs of
duplicates that cover at least `min_words` words are removed from the text.

Scale: texts are chunked where they lie. Digests are grouped with partial aggregation and joined back (a
hot passage is split by adaptive execution, as the shared digests are a written table); only the places found duplicate go to their documents, and the
texts are shuffled only if the table of places is too large to broadcast.

Defined cases: null and empty texts have no chunks and stay as they are; rows with a null doc_id are passed on
unchanged; rows with the same doc_id count as one document; stretches of `MAX` bytes
without a cut are cut at the white space, or else the character border, with the least hash; an empty table gives no rows; other columns are passed on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqflow.llm.common import written

MIN, MAX, CUT = 16, 96, 65536 // 3  # least and most bytes of a chunk; a white space is a cut if the hash is below CUT
GAP = 16  # bytes the hash looks back
GEAR = np.array([0] + [xxhash.xxh32_intdigest(bytes([i]), 6) & 0xFFFF for i in range(1, 256)], np.uint16)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def cut_points(texts: list[bytes]) -> list[list[int]]:
    """The ends of each text's chunks."""
    pad = b"\0" * GAP  # the hash of a zero byte is zero: a text's cuts don't depend on its neighbours
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    h = GEAR[data]
    for step in (1, 2, 4, 8):  # sum of GEAR[byte] << age over the last 16 bytes
        older = h[:-step] << np.uint16(step)
        h[step:] += older
    places = np.flatnonzero((h < CUT) & SPACE[data]) + 1
    out, at = [], GAP
    for t in texts:
        a, b = np.searchsorted(places, (at, at + len(t)), side="right")
        ends, last = [], 0
        for c in (places[a:b] - at).tolist():
            if c - last >= MIN:
                last = _forced(data, h, at, last, c, ends)
                ends.append(c)
                last = c
        if last < len(t):
            _forced(data, h, at, last, len(t), ends)
            ends.append(len(t))
        out.append(ends)
        at += len(t) + GAP
    return out


def _forced(data: np.ndarray, h: np.ndarray, at: int, last: int, until: int, ends: list[int]) -> int:
    """Cuts in a stretch of more than MAX bytes without a cut: after the white space, or else at the character border, with
    the least hash among the next MIN to MAX bytes, the first of equals. So the place depends on what is near,
    and a word or line repeated over and over gives equal chunks. Returns the last cut."""
    while until - last > MAX:
        a, b = at + last + MIN, at + last + MAX + 1  # the bytes behind a possible cut
        here = SPACE[data[a - 1:b - 1]]
        if not here.any():
            here = data[a:b] & 0xC0 != 0x80
        last += MIN + int(np.where(here, h[a - 1:b - 1], np.int32(1 << 16)).argmin())
        ends.append(last)
    return last


def windows(text: bytes, ends: list[int]) -> Iterator[tuple[int, int]]:
    """(start, end) of every two chunks in a row; the only chunk of a short text by itself."""
    starts = [0, *ends[:-1]]
    return zip(starts, ends[1:]) if len(ends) > 1 else zip(starts, ends)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for b in batches:
        texts = [(t or "").encode() for t in b.column("t").to_pylist()]
        starts: list[int] = []
        ends: list[int] = []
        found: list[int] = []
        counts = []
        for t, cuts in zip(texts, cut_points(texts)):
            before = len(starts)
            for s, e in windows(t, cuts):
                starts.append(s)
                ends.append(e)
                found.append(digest(t[s:e]))
            counts.append(len(starts) - before)
        of = pa.array(np.repeat(np.arange(len(texts)), counts))
        yield pa.RecordBatch.from_arrays([b.column("doc_id").take(of), pa.array(np.array(found, np.uint64).view(np.int64)),
                                          pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["doc_id", "digest", "s", "e"])


def duplicate_places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, places): the windows whose digest occurs elsewhere, as (s, e, digest, first document)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).where("doc_id IS NOT NULL AND t != ''")
    chunks = written(rows.mapInArrow(_chunks, "doc_id long, digest long, s int, e int"), "cdc-chunks", batch_rows=1000)
    # a document's own first occurrence is told apart later; here one row is dropped only if it is alone
    shared = written(chunks.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "cdc-shared")
    met = chunks.join(shared, "digest", "inner")
    return met.groupBy("doc_id").agg(F.collect_list(F.struct("s", "e", "digest", "first")).alias("places"))


def _word_count(t: bytes) -> int:
    return len(t.split())


def strip_text(doc_id: int, text: str, places: list[tuple[int, int, int, int]], min_words: int) -> tuple[str, int, list[int]]:
    """(text left, spans removed, documents that keep them). Places that don't fit the text are ignored."""
    t = text.encode()
    own: dict[int, int] = {}
    for s, _, d, first in places:
        if first == doc_id:
            own[d] = min(s, own.get(d, s))
    spans: list[list] = []
    for s, e, d, first in sorted(set(places)):
        if first == doc_id and own[d] == s or e > len(t) or np.uint64(xxhash.xxh3_64_intdigest(t[s:e])).view(np.int64) != d:
            continue
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(e, spans[-1][1])
            spans[-1][2].add(first)
        else:
            spans.append([s, e, {first}])
    spans = [x for x in spans if _word_count(t[x[0]:x[1]]) >= min_words]
    left, at = [], 0
    for s, e, _ in spans:
        left.append(t[at:s])
        at = e
    left.append(t[at:])
    return b"".join(left).decode(), len(spans), sorted(set().union(*(x[2] for x in spans)))


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20,
                     broadcast_places: int = 200_000) -> DataFrame:
    """The rows of `docs` with struct `_seqflow_cut` (text, spans, kept_in) added: the text left, the number of spans
    removed, and the documents that keep them."""
    places = written(duplicate_places(docs, id_col, text_col), "cdc-places")
    small = (places.agg(F.sum(F.size("places") + 4)).first()[0] or 0) <= broadcast_places
    places = places.select(F.col("doc_id").alias("_seqflow_places_of"), "places").withColumnRenamed("places", "_seqflow_places")
    key = F.col(id_col).cast("long")
    rows = docs.join(F.broadcast(places) if small else places, key == F.col("_seqflow_places_of"), "left")

    @F.udf("text string, spans int, kept_in array<long>", useArrow=True)
    def cut(doc_id, text, found):
        return strip_text(doc_id, text, [(x["s"], x["e"], x["digest"], x["first"]) for x in found], min_words)

    untouched = F.struct(F.col(text_col).alias("text"), F.lit(0).alias("spans"), F.array().cast("array<long>").alias("kept_in"))
    touched = rows.where(F.col("_seqflow_places").isNotNull()).withColumn("_seqflow_cut", cut(key, F.col(text_col), F.col("_seqflow_places")))
    rest = rows.where(F.col("_seqflow_places").isNull()).withColumn("_seqflow_cut", untouched)
    return touched.unionByName(rest).drop("_seqflow_places", "_seqflow_places_of")
