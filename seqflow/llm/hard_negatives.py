"""Hard negatives for embedding rows, from exact integer scores by Kronecker-packed products.

A row's components become integers floor(scale * x); a score is an integer inner product with the anchor. With a bias
all components are 0 to R, so the sum of D products fits a field of w bits, 2**w > D * R * R. The
same component of several candidates goes into separated fields of one wide integer; a product with an
anchor's component serves all of them, no field carries into the next, and after the sum over components
the fields are unpacked and the bias taken off. Wide integers of up to 53 bits are held in doubles, where every sum
is exact, and one matrix product multiplies a block; wider fields go through Python's integers.

An anchor's positives are its `positives` best other rows of the same label; for each of them the best
`negatives` rows of another label follow whose score is between `low` and `high` percent of the positive's.
Higher scores come first, ties by the smaller key (null last).

Scale: the anchors are a stated query set, compared with all rows in blocks. Anchors are dealt to groups by a hash of
their row number (at most `group_rows` each); a task holds its group, and blocks of `block_rows` packed candidates stream
past it twice, once for the positives and once for the negatives. It keeps only the best rows of each anchor, so what leaves a
task is in proportion to its anchors, whatever the size of a group of equal rows.

Defined cases: rows with a null label or vector, or any null or non-finite component (also after scaling), take no
part; missing components of shorter vectors count as zero; rows with a null key are candidates, ordered last; repeated
rows are rows of their own, each an anchor if its key is, and each other's positives; a score beyond 64 bits counts
as the nearest 64-bit number; an empty table, a single label or no anchors give no rows or no pairs;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.llm.common import short_batches, written

LOW64, HIGH64 = -(1 << 63), (1 << 63) - 1
DOUBLE_BITS, WIDE_FIELDS = 53, 16
SUB = 1024  # anchors of a group that are multiplied at once
BLOCK = "g int, kind int, n int, row binary, key binary, known binary, label binary, data binary"


class Packing:
    """How components are packed: `lo` to `hi`, `dim` of them."""

    def __init__(self, lo: int, hi: int, dim: int) -> None:
        self.bias, self.dim = max(0, -lo), dim
        top = max(hi + self.bias, 0)
        self.bits = max(1, (dim * top * top).bit_length())
        self.exact = self.bits > DOUBLE_BITS
        self.fields = WIDE_FIELDS if self.exact else DOUBLE_BITS // self.bits

    def biased(self, ints: np.ndarray) -> np.ndarray:
        return ints + self.bias

    def pack(self, biased: np.ndarray) -> np.ndarray:
        """Rows x dim -> dim x wide integers; field f of wide integer j is row f * columns + j."""
        columns = -(-len(biased) // self.fields)
        kind = object if self.exact else np.int64
        full = np.zeros((columns * self.fields, self.dim), kind)
        full[:len(biased)] = biased
        wide = np.zeros((columns, self.dim), kind)
        for f in range(self.fields):
            wide += full[f * columns:(f + 1) * columns] << (f * self.bits)
        return wide.T if self.exact else np.ascontiguousarray(wide.T, np.float64)

    def scores(self, anchors: np.ndarray, wide: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """anchors: biased rows x dim; wide: packed candidates; sums: of each candidate's biased components."""
        product = anchors @ wide
        if not self.exact:
            product = product.astype(np.int64)
        mask = (1 << self.bits) - 1
        out = np.concatenate([(product >> (f * self.bits)) & mask for f in range(self.fields)], axis=1)[:, :len(sums)]
        off = self.bias * (anchors.sum(axis=1) - self.dim * self.bias)
        if not self.exact:
            return out - (self.bias * sums)[None, :] - off.astype(np.int64)[:, None]
        out = out - (self.bias * sums)[None, :] - off[:, None]
        return np.clip(out, LOW64, HIGH64).astype(np.int64)


def _ints(vectors: pa.Array, scale: float, dim: int, exact: bool) -> np.ndarray:
    flat = np.floor(scale * vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    flat = np.array([int(x) for x in flat], object) if exact else flat.astype(np.int64)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), dim), flat.dtype)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _dump(a: np.ndarray, exact: bool) -> bytes:
    """Exact: rows of decimal digits, as the integers have no fixed width."""
    return " ".join(map(str, a.ravel().tolist())).encode() if exact else a.tobytes()


def _load(b: bytes, exact: bool, kind, shape: tuple) -> np.ndarray:
    flat = np.array(list(map(int, b.split())), object) if exact else np.frombuffer(b, kind)
    return flat.reshape(shape)


class Best:
    """The `k` best rows for each of `n` slots: (score, known, key), higher scores first, then known and smaller keys."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k = n, k
        self.slot = np.zeros(0, np.int64)
        self.score, self.key, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.bound = np.full(n, LOW64, np.int64)  # no row below it can be among the best

    def add(self, slot: np.ndarray, score: np.ndarray, key: np.ndarray, known: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score = np.concatenate((self.slot, slot)), np.concatenate((self.score, score))
        key, known = np.concatenate((self.key, key)), np.concatenate((self.known, known))
        order = np.lexsort((key, ~known, ~score, slot))  # ~score falls as the score rises
        slot = slot[order]
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.concatenate((first, [len(slot)]))))
        kept = order[rank < self.k]
        self.slot, self.score, self.key, self.known = slot[rank < self.k], score[kept], key[kept], known[kept]
        last = rank == self.k - 1
        self.bound[slot[last]] = score[order[last]]

    def rank(self) -> np.ndarray:
        first = np.searchsorted(self.slot, self.slot)
        return np.arange(len(self.slot)) - first + 1


def _blocks(batches: Iterator[pa.RecordBatch], p: Packing, scale: float, block_rows: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (g, row, key, label, vector) -> blocks: packed candidates of `block_rows` rows (kind 1) or, without it, an
    anchor each (kind 0)."""
    schema = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("n", pa.int32())] + [(c, pa.binary()) for c in ("row", "key", "known", "label", "data")])
    for batch in batches:
        step = block_rows or 1
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            g, row, key, label, vec = part.columns
            ints = p.biased(_ints(vec, scale, p.dim, p.exact))
            known = ~key.is_null().to_numpy(zero_copy_only=False)
            data = (b"|" if p.exact else b"").join(_dump(a, p.exact) for a in ((ints.sum(axis=1), p.pack(ints)) if block_rows else (ints,)))
            out = [g[0].as_py() or 0, int(bool(block_rows)), len(ints), row.to_numpy().astype(np.int64).tobytes(),
                   key.fill_null(HIGH64).to_numpy().astype(np.int64).tobytes(), known.tobytes(), label.to_numpy().astype(np.int64).tobytes(), data]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(out, schema, strict=True)], schema=schema)


class Candidates:
    """A block of packed candidates, as read back."""

    def __init__(self, block: dict, p: Packing) -> None:
        n, data = block["n"], block["data"]
        self.row, self.key, self.label = (np.frombuffer(block[c], np.int64) for c in ("row", "key", "label"))
        self.known = np.frombuffer(block["known"], bool)
        columns = -(-n // p.fields)
        if p.exact:
            sums, _, wide = data.partition(b"|")
            self.sums, self.wide = _load(sums, True, None, (n,)), _load(wide, True, None, (p.dim, columns))
        else:
            self.sums, self.wide = np.frombuffer(data[:8 * n], np.int64), np.frombuffer(data[8 * n:], np.float64).reshape(p.dim, columns)


class Anchors:
    """A group of anchors and what has been found for them."""

    def __init__(self, blocks: list[dict], p: Packing) -> None:
        self.p = p
        join = lambda c, kind: np.frombuffer(b"".join(b[c] for b in blocks), kind)
        self.row, self.key, self.label, self.known = join("row", np.int64), join("key", np.int64), join("label", np.int64), join("known", bool)
        if p.exact:
            self.ints = np.array([list(map(int, b["data"].split())) for b in blocks], object).reshape(len(blocks), p.dim)
        else:
            self.ints = join("data", np.int64).reshape(len(blocks), p.dim).astype(np.float64)

    def scored(self, c: Candidates) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Parts of the anchors with their scores and whether the labels are the same."""
        for at in range(0, len(self.row), SUB):
            part = slice(at, at + SUB)
            yield part, self.p.scores(self.ints[part], c.wide, c.sums), self.label[part, None] == c.label[None, :]


def _positives(group: Anchors, blocks: Iterator[dict], k: int) -> Best:
    best = Best(len(group.row), k)
    for block in blocks:
        c = Candidates(block, group.p)
        for part, scores, same in group.scored(c):
            same &= group.row[part, None] != c.row[None, :]
            at, j = np.nonzero(same & (scores >= best.bound[part, None]))
            best.add(at + part.start, scores[at, j], c.key[j], c.known[j])
    return best


def _bounds(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest negative score n with low * s <= 100 * n <= high * s, exact at any size."""
    s = scores.astype(object)
    return np.clip(-((-low * s) // 100), LOW64, HIGH64).astype(np.int64), np.clip((high * s) // 100, LOW64, HIGH64).astype(np.int64)


def _negatives(group: Anchors, slots: dict[str, np.ndarray], blocks: Iterator[dict], k: int, low: int, high: int) -> Best:
    """slots: of each (anchor, positive) the anchor's place, ascending, and the positive's rank and score."""
    best = Best(len(slots["at"]), k)
    least, most = _bounds(slots["score"], low, high)
    for block in blocks:
        c = Candidates(block, group.p)
        for part, scores, same in group.scored(c):
            scores = np.where(same, LOW64, scores)
            n = len(scores)
            for rank in range(int(slots["rank"].max(initial=0))):
                own = np.flatnonzero((slots["rank"] == rank + 1) & (slots["at"] >= part.start) & (slots["at"] < part.start + n))
                rows = slots["at"][own] - part.start
                mine = scores[rows]
                at, j = np.nonzero((mine >= np.maximum(least[own], best.bound[own])[:, None]) & (mine <= most[own][:, None]))
                free = ~same[rows[at], j]
                at, j = at[free], j[free]
                best.add(own[at], mine[at, j], c.key[j], c.known[j])
    return best


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], Iterator[dict]]]:
    """Sorted by (g, kind): for each g its anchors, then its candidates one after the other."""
    rows = ({f: batch.column(f)[i].as_py() for f in batch.schema.names} for batch in batches for i in range(batch.num_rows))
    row = next(rows, None)
    while row is not None:
        g, anchors = row["g"], []
        while row is not None and row["g"] == g and row["kind"] == 0:
            anchors.append(row)
            row = next(rows, None)

        def blocks() -> Iterator[dict]:
            nonlocal row
            while row is not None and row["g"] == g:
                if anchors:
                    yield row
                row = next(rows, None)

        stream = blocks()
        yield anchors, stream
        for _ in stream:
            pass


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: float = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         block_rows: int = 2048, group_rows: int = 65536) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); `is_anchor` is a condition on the
    columns of `rows`. Labels are whole numbers."""
    spark = rows.sparkSession
    short_batches(spark)
    x = F.col(vector).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v * F.lit(float(scale))) == F.lit(math.inf)))
    rows = rows.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & ~odd)
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"),
                               x.alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")), "negatives-rows")
    lo, hi, dim, anchors = rows.agg(F.min(F.array_min("vec")), F.max(F.array_max("vec")), F.max(F.size("vec")),
                                    F.sum(F.col("anchor").cast("long"))).first()
    floor = lambda v: math.floor(scale * v) if v is not None else 0
    p = Packing(floor(lo), floor(hi), dim or 0)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(parallel, -(-(anchors or 0) // 16)), -(-(anchors or 0) // group_rows))

    columns = [F.col(c) for c in ("row", "key", "label", "vec")]
    candidates = rows.select(F.lit(0).alias("g"), *columns).mapInArrow(lambda b: _blocks(b, p, scale, block_rows), BLOCK)
    candidates = written(candidates, "negatives-blocks")
    everywhere = candidates.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    g = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("g")
    own = rows.where("anchor").select(g, *columns).mapInArrow(lambda b: _blocks(b, p, scale, None), BLOCK)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, blocks in _groups(batches):
            if not anchors:
                continue
            group = Anchors(anchors, p)
            best = _positives(group, blocks, positives)
            order = np.arange(len(anchors))
            left, right = np.searchsorted(best.slot, order), np.searchsorted(best.slot, order, "right")
            for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
                pos = b"".join(c[a:b].tobytes() for c in (best.score, best.key, best.known))
                out = [anchors[i][f] for f in schema.names[:-1]] + [pos]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    schema = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("n", pa.int32())] + [(c, pa.binary()) for c in ("row", "key", "known", "label", "data", "pos")])
    dealt = lambda df: df.repartition(groups, "g").sortWithinPartitions("g", "kind")
    with_positives = written(dealt(own.unionByName(everywhere)).mapInArrow(found, BLOCK + ", pos binary"), "negatives-positives")

    result = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                        ("positive_score", pa.int64()), ("negative_score", pa.int64())])

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, blocks in _groups(batches):
            if not anchors:
                continue
            group = Anchors(anchors, p)
            counts = np.array([len(a["pos"]) // 17 for a in anchors])
            score, key, known = (np.concatenate([np.frombuffer(a["pos"][n * f:n * t], kind) for a, n in zip(anchors, counts.tolist(), strict=True)])
                                 for f, t, kind in ((0, 8, np.int64), (8, 16, np.int64), (16, 17, bool)))
            at = np.repeat(np.arange(len(anchors)), counts)
            slots = {"at": at, "score": score, "rank": np.arange(len(at)) - np.searchsorted(at, at) + 1}
            best = _negatives(group, slots, blocks, negatives, low, high)
            s = best.slot
            for a in range(0, len(s), 10_000):
                o = slice(a, a + 10_000)
                t = s[o]
                values = [(group.key[at[t]], ~group.known[at[t]]), (key[t], ~known[t]), (best.rank()[o].astype(np.int32), None),
                          (best.key[o], ~best.known[o]), (score[t], None), (best.score[o], None)]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type, mask=m) for (v, m), f in zip(values, result, strict=True)], schema=result)

    both = with_positives.unionByName(everywhere.withColumn("pos", F.lit(None).cast("binary")))
    return dealt(both).mapInArrow(mined, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


ORACLE = """
WITH e AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.row AS anchor_row, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.row <> b.row
), p AS (
  SELECT anchor_row, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same
), n AS (
  SELECT s.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_row, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_row = p.anchor_row AND p.place <= 5 AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
