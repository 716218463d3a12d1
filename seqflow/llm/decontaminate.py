"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and items are lower-cased and their white space is made one space. An item of m bytes may be met with at
most e = `max_error` * m edits; it then shares at least m - q + 1 - q e of its q-grams with the text, on
diagonals that lie within e of each other. Shared q-grams are counted in overlapping bands of diagonals;
bands that reach the bound are verified by banded alignment of the whole item inside the region. Items longer
than `segment` bytes are searched as overlapping segments, so that a part of a long item is found too.

Scale: one pass over the documents for each block of items, with no shuffle; a block's index is bounded by
`block_bytes` and travels with the tasks. The filter is lossless: no gram is skipped, no count is capped.

Defined cases: null and empty texts match nothing; items shorter than q bytes can't be told from chance
and are ignored, as are null items; with a null item_id an item still counts as a leak; repeated rows give
repeated results, repeated items one row each; empty tables give no rows; other columns are ignored (in
`clean_documents` passed on).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 8  # bytes of a q-gram: read as one 64-bit number
BITS = 20  # of the table that rejects most grams at once
MIX = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode()


class Items:
    """The q-gram index of a block of items."""

    def __init__(self, texts: Sequence[str | None], max_error: float, segment: int):
        self.patterns: list[bytes] = []
        self.item: list[int] = []
        for i, t in enumerate(texts):
            b = normal(t)
            starts = [0] if len(b) <= segment else [*range(0, len(b) - segment, segment // 2), len(b) - segment]
            for s in starts:
                p = b[s:s + segment] if len(b) > segment else b
                if len(p) >= Q:
                    self.patterns.append(p)
                    self.item.append(i)
        m = np.array([len(p) for p in self.patterns], np.int64)
        # the edit budget, where needed less, so that the bound is one gram at least
        self.budget = np.minimum((max_error * m).astype(np.int64), (m - Q) // Q)
        self.need = m - Q + 1 - Q * self.budget
        self.width = 1 << np.ceil(np.log2(self.budget + 1)).astype(np.int64) if len(m) else m
        grams, owner, place = [], [], []
        for k, p in enumerate(self.patterns):
            g = _grams(np.frombuffer(p, np.uint8))
            grams.append(g)
            owner.append(np.full(len(g), k, np.int32))
            place.append(np.arange(len(g), dtype=np.int32))
        g = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(g, kind="stable")
        self.owner = (np.concatenate(owner) if grams else np.empty(0, np.int32))[order]
        self.place = (np.concatenate(place) if grams else np.empty(0, np.int32))[order]
        self.gram, self.first, self.count = np.unique(g[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << BITS, bool)
        self.maybe[_slot(self.gram)] = True
        self.longest = int(m.max()) if len(m) else 0

    def find(self, texts: Sequence[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, least edits of one of its segments, bytes of that segment)."""
        if not self.patterns or not texts:
            return
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        data = np.frombuffer(b"\0".join(texts) + b"\0" * Q, np.uint8)
        grams = _grams(data)
        at = np.flatnonzero(self.maybe[_slot(grams)])
        found = grams[at]
        k = np.searchsorted(self.gram, found)
        k[k == len(self.gram)] = 0
        real = self.gram[k] == found
        at, k = at[real], k[real]
        n = self.count[k]
        hit = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(at, n)
        text = np.searchsorted(starts, at, side="right") - 1
        owner = self.owner[hit].astype(np.int64)
        diagonal = at - starts[text] - self.place[hit] + self.longest  # not negative
        band = diagonal // self.width[owner]
        # each diagonal is in two bands of twice the width, which overlap by half
        most = int(band.max()) + 2 if len(band) else 2
        key = (text * len(self.patterns) + owner) * most + band
        key, owner = np.concatenate([key, key - 1]) + 1, np.concatenate([owner, owner])
        slot = _slot(key.astype(np.uint64), BITS - 2)
        dense = np.bincount(slot.astype(np.int64), minlength=1 << (BITS - 2))[slot] >= self.need[owner]  # several keys a slot: never too few
        place = np.tile(self.place[hit], 2)[dense]
        places = np.unique(key[dense] * (self.longest + 1) + place)  # a gram of the item counts once
        key, n = np.unique(places // (self.longest + 1), return_counts=True)
        key -= 1
        owner = key // most % len(self.patterns)
        full = n >= self.need[owner]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for c in key[full].tolist():
            t, p, b = c // most // len(self.patterns), c // most % len(self.patterns), c % most
            w, e, m = int(self.width[p]), int(self.budget[p]), len(self.patterns[p])
            low = b * w - self.longest - e
            region = texts[t][max(0, low):low + 2 * w + m + 2 * e]
            d = 0 if self.patterns[p] in region else edits_within(self.patterns[p], region, e)
            if d is not None:
                old = best.get((t, self.item[p]))
                if old is None or d * old[1] < old[0] * m:
                    best[t, self.item[p]] = (d, m)
        for (t, i), (d, m) in sorted(best.items()):
            yield t, i, d, m


def _grams(b: np.ndarray) -> np.ndarray:
    """Every Q bytes in a row as a number (a view of the bytes)."""
    return np.ndarray((max(0, len(b) - Q + 1),), np.uint64, b.tobytes() + b"\0" * Q, 0, (1,))


def _slot(g: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (g * MIX) >> np.uint64(64 - bits)


def edits_within(pattern: bytes, region: bytes, budget: int) -> int | None:
    """Least edits that turn the pattern into some part of the region, if at most `budget`; by alignment in
    the band of diagonals that the region allows."""
    m = len(pattern)
    width = len(region) - m + 2 * budget + 1  # diagonals (place in region - place in pattern) from -budget on
    if width < 1:
        return None
    p = np.frombuffer(pattern, np.uint8)
    t = np.zeros(m + width + budget, np.uint8)  # zeros match nothing
    t[budget:budget + len(region)] = np.frombuffer(region, np.uint8)
    k = np.arange(width)
    far = np.int64(1 << 30)
    row = np.where(k < budget, far, 0)  # any place of the region may be the start, none before it
    for i in range(m):
        step = row + (t[i:i + width] != p[i])
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - k) + k
        lead = budget - i - 1
        if lead > 0:
            row[:lead] = far
        if 0 <= lead < width:
            row[lead] = i + 1  # the pattern so far is left out
        row = np.where(k + i + 1 - budget > len(region), far, row)
        if lead < 0 and row.min() > budget:
            return None
    return int(row.min()) if row.min() <= budget else None


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """The items, in blocks of about `block_bytes`."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield items.where(F.pmod(F.xxhash64("t"), F.lit(n)) == k).orderBy("i", "t").collect()


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", max_error: float = 0.1, segment: int = 256, block_bytes: int = 1 << 22) -> DataFrame:
    """doc_id, item_id, edits, length: every document that holds an item, or a segment of one, within its budget."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    out = spark.createDataFrame([], "doc_id long, item_id long, edits int, length int")
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(([r.i for r in block], Items([r.t for r in block], max_error, segment)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, items = shared.value
            for b in batches:
                doc = b.column("doc_id").to_pylist()
                for texts, first in _slices(b.column("t")):
                    got = [(doc[first + t], ids[i], d, m) for t, i, d, m in items.find(texts)]
                    if got:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                                                         names=["doc_id", "item_id", "edits", "length"])

        out = out.unionByName(rows.mapInArrow(run, out.schema))
    return out


def _slices(texts) -> Iterator[tuple[list[bytes], int]]:
    """Normalised texts, about a quarter of a megabyte at a time, and the place of the first."""
    part, first, size = [], 0, 0
    for i, t in enumerate(texts):
        part.append(normal(t.as_py() if isinstance(t, pa.Scalar) else t))
        size += len(part[-1])
        if size >= 1 << 18:
            yield part, first
            part, first, size = [], i + 1, 0
    if part:
        yield part, first


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    max_error: float = 0.1, segment: int = 256, block_bytes: int = 1 << 22) -> DataFrame:
    """The documents that hold no item."""
    spark = docs.sparkSession

    def leaks(shared) -> Column:
        @F.pandas_udf("boolean")
        def run(t: pd.Series) -> pd.Series:
            out = np.zeros(len(t), bool)
            for texts, first in _slices(t):
                out[[first + x[0] for x in shared.value.find(texts)]] = True
            return pd.Series(out)

        return run(F.col(text_col).cast("string"))

    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        docs = docs.where(~leaks(spark.sparkContext.broadcast(Items([r.t for r in block], max_error, segment))))
    return docs
