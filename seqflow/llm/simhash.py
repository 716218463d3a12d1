"""SimHash near-duplicates: 64-bit fingerprints, linked at few differing bits by general pigeonhole (GPH).

Bits are grouped into partitions of correlated bits. Partition i gets a threshold t_i (-1: not probed) such
that the thresholds add up to distance - partitions + 1; two fingerprints within the distance then differ in
at most t_i bits of some partition i. Dynamic programming picks the thresholds, and the number of partitions,
with the least estimated work: collisions of partition values, counted over all fingerprints and extended
to nearer-than-t pairs by the bits' own statistics, and probe keys. Each distinct fingerprint probes the index
of partition values; every candidate pair is verified on all bits. Links then give connected components.

Scale: equal fingerprints are one node. A partition value that more than `bucket` fingerprints share is not
paired out: those fingerprints meet at the points half the distance away (two are within the distance if
and only if they share one), which costs a fixed number of rows each and loses no link.

Defined cases: texts without words, and null texts, have fingerprint zero and link like any other; the
smallest id ignores nulls; null ids keep their row; repeated rows get the same result; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.llm.common import written
from seqflow.llm.graph import connected_components

WIDTH = 64


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """Unsigned fingerprint of a text: a bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [h(line, seed)]
    else:
        ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
        starts = [0, *(e + 1 for e in ends)]
        hashes = [h(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1:])]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(set_bits).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, key_col: str | None = None) -> DataFrame:
    """(doc_id, fp) with fp as signed long; with `key_col`, a long that isn't null, as a third column."""
    keys = [key_col] if key_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column("t")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64)), *map(b.column, keys)], names=["doc_id", "fp", *keys])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"), *keys)
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{k} long" for k in keys)]))


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((WIDTH, WIDTH))
        for b in batches:
            x = b.column("fp").to_numpy(zero_copy_only=False).astype(np.uint64)
            bits = ((x[:, None] >> np.arange(WIDTH, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            n, both = n + len(x), both + bits.T @ bits
        i, j = np.triu_indices(WIDTH)
        yield pa.RecordBatch.from_pydict({"i": np.append(i, -1).astype(np.int32), "j": np.append(j, -1).astype(np.int32),
                                          "n": np.append(both[i, j], n).astype(np.int64)})

    got = fps.select("fp").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, n = np.zeros((WIDTH, WIDTH)), 0
    for r in got:
        if r.i < 0:
            n = r.n
        else:
            both[r.i, r.j] = both[r.j, r.i] = r.n
    return n, both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of about equal size, correlated bits together."""
    p = both.diagonal() / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    left, groups = list(range(WIDTH)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            b = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(b)
            left.remove(b)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def allocate(cost: np.ndarray, distance: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost by dynamic programming. cost[i][t + 1]: of partition i at threshold t,
    t from -1 to distance. The sum of (t + 1) must exceed the distance by one: distance + 1 in all."""
    m, need = len(cost), distance + 1
    best = np.full((m + 1, need + 1), np.inf)
    pick = np.zeros((m + 1, need + 1), int)
    best[0, 0] = 0
    for i in range(m):
        for s in range(need + 1):
            for k in range(s + 1):
                if (c := best[i, s - k] + cost[i][k]) < best[i + 1, s]:
                    best[i + 1, s], pick[i + 1, s] = c, k
    out, s = [], need
    for i in range(m, 0, -1):
        out.append(int(pick[i, s]) - 1)
        s -= pick[i, s]
    return float(best[m, need]), out[::-1]


def choose_partitions(fps: DataFrame, distance: int, bucket: int, most_parts: int = 5) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition to probe."""
    n, both = bit_statistics(fps)
    if not n:
        return []
    plans = [group_bits(n, both, m) for m in range(2, max(most_parts, distance + 1) + 1)]
    flat = [(k, i, bits) for k, plan in enumerate(plans) for i, bits in enumerate(plan)]
    keys = F.explode(F.array(*[F.struct(F.lit(at).alias("at"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("v"))
                               for at, (_, _, bits) in enumerate(flat)]))
    counts = fps.select(keys.alias("k")).groupBy("k.at", "k.v").count()
    pairs = F.col("count") * F.least((F.col("count") - 1) / 2, F.lit(float(bucket)))  # larger buckets cost no more a row
    got = {r["at"]: float(r["pairs"]) for r in counts.groupBy("at").agg(F.sum(pairs).alias("pairs")).collect()}
    p = both.diagonal() / n
    differ = 2 * p * (1 - p)
    costs: list[list] = [[] for _ in plans]
    for at, (k, _, bits) in enumerate(flat):
        dist = np.array([1.0])  # distribution of the number of differing bits, were the bits independent
        for b in bits:
            dist = np.convolve(dist, [1 - differ[b], differ[b]])
        near = np.cumsum(np.pad(dist, (0, distance + 1)))[:distance + 1] / max(dist[0], 1e-300)
        base = max(got.get(at, 0.0), n * n / 2 * dist[0])
        probes = np.cumsum([float(n) if t == 0 else n * float(np.prod([(len(bits) - j) / (j + 1) for j in range(t)])) for t in range(distance + 1)])
        costs[k].append([0.0, *(base * near + probes)])
    _, best = min(((allocate(np.array(c), distance), k) for k, c in enumerate(costs)), key=lambda x: (x[0][0], x[1]))
    return [(bits, t) for bits, t in zip(plans[best], allocate(np.array(costs[best]), distance)[1]) if t >= 0]


def _flips(c: Column, bits: list[int], times: int) -> Column:
    """Array of `c` with at most `times` of the bits flipped."""
    out = F.array(c)
    flips = F.array(*[F.lit(0).cast("long")], *[F.lit(_mask([b])).cast("long") for b in bits])
    for _ in range(times):
        out = F.array_distinct(F.flatten(F.transform(out, lambda x: F.transform(flips, lambda f: x.bitwiseXOR(f)))))
    return out


def _meeting_points(fp: Column, distance: int) -> Column:
    """Array of keys that two fingerprints share if and only if they differ in at most `distance` bits."""
    every = list(range(WIDTH))
    if distance % 2 == 0:
        return F.transform(_flips(fp, every, distance // 2), lambda z: F.struct(F.lit(-1).alias("j"), z.alias("z")))
    cleared = F.array(*[F.struct(F.lit(b).alias("j"), fp.bitwiseAND(F.lit(~_mask([b]))).alias("z")) for b in every])
    return F.array_distinct(F.flatten(F.transform(cleared, lambda k: F.transform(
        _flips(k["z"], every, distance // 2), lambda z: F.struct(k["j"].alias("j"), z.alias("z"))))))


def links(fps: DataFrame, distance: int, bucket: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all within the distance: every such pair where
    buckets are small, a star at each meeting point where they are large."""
    parts = choose_partitions(fps, distance, bucket)
    if not parts:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)

    def keys(i: int, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(i).alias("i"), v.alias("v")))

    own = [F.col("fp").bitwiseAND(F.lit(_mask(bits))) for bits, _ in parts]
    index = [F.struct(F.lit(i).alias("i"), v.alias("v")) for i, v in enumerate(own)]
    probe = [keys(i, _flips(v, bits, t)) for i, (v, (bits, t)) in enumerate(zip(own, parts))]
    indexed = fps.select(F.col("fp").alias("a"), F.explode(F.array(*index)).alias("k")).select("a", "k.i", "k.v")
    probes = fps.select(F.col("fp").alias("b"), F.explode(F.concat(*probe)).alias("k")).select("b", "k.i", "k.v")
    full = written(indexed.groupBy("i", "v").count().where(F.col("count") > bucket).select("i", "v"), "simhash-full")
    if not full.isEmpty():
        indexed = indexed.join(full, ["i", "v"], "left_anti")
        crowded = probes.join(full, ["i", "v"], "left_semi").select("b").distinct()
        points = crowded.select("b", F.explode(_meeting_points(F.col("b"), distance)).alias("z"))
        least = points.groupBy("z").agg(F.min("b").alias("a"), F.max("b").alias("last")).where("a < last").select("z", "a")
        stars = points.join(least, "z").where("a < b").select("a", "b")
    pairs = indexed.join(probes, ["i", "v"]).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    pairs = pairs.select("a", "b")
    return pairs if full.isEmpty() else pairs.union(stars)


def near_duplicates(docs: DataFrame, *, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    bucket: int = 64) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id (the smallest doc_id reachable), one row per document."""
    marked = written(fingerprints(docs, id_col, text_col, shingle), "simhash-docs", batch_rows=1000)
    fps = written(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-fps")
    roots = written(connected_components(links(fps, distance, bucket)), "simhash-roots")
    own = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    linked = own.join(roots.select("root").distinct(), "root", "left_semi")  # the others are their own component
    ids = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    own = own.join(ids, "root", "left").select(F.col("fp").alias("_fp"), F.coalesce("component_id", "low").alias("component_id"))
    out = marked.join(own, F.col("fp") == F.col("_fp"), "inner")
    return out.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text",
             bucket: int = 64) -> DataFrame:
    """One document of each component: that with the smallest doc_id, null ids last, and any one of rows that share it.
    A key of the written rows tells them apart, so a row goes or stays for itself, whatever id it has."""
    key = "_seqflow_row"
    rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "simhash-rows")
    marked = written(fingerprints(rows, id_col, text_col, shingle, key), "simhash-docs", batch_rows=1000)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key))
    fps = written(marked.groupBy("fp").agg(first.alias("first")), "simhash-fps")
    roots = written(connected_components(links(fps.select("fp"), distance, bucket)), "simhash-roots")
    own = fps.join(roots, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "first")
    kept = own.groupBy("root").agg(F.min("first").alias("first")).select(F.col(f"first.{key}").alias(key))
    gone = written(marked.select(key).join(kept, key, "left_anti"), "simhash-gone")
    return rows.join(gone, key, "left_anti").select(docs.columns)
