"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted by balanced bisection on a bounded sample and linked in a neighbour graph that fits in
memory. Every vector goes to the list of its nearest centroid and, near a boundary, to those of further
centroids within (1 + `closure`) times that distance. A query walks the graph to its nearest centroids and is compared with the lists of those whose
distance is at most (1 + ratio) times the least one, `probes` lists at most; a walk that ends inside that distance is taken up
again with twice the width. Both limits are measured for each input: a seeded set of `trials` queries is compared with all
rows, and the least ratio and the least number of lists are taken that together hold the share `recall` of their true
neighbours; they grow with the index as the vectors need. A caller may set either instead. A query always looks in
enough lists for k results.
Nearness is the inner product: vectors get one more coordinate that makes all norms equal, in which the
largest inner product is the least distance; the scores are those of the original vectors, in doubles.

Scale: the index has at most `max_lists` centroids, whatever the input; all rows are indexed. Equal vectors
are one entry with its k + 1 smallest ids, which is all that a result can need. Lists, and the queries at a
list, are cut into chunks of `chunk` rows that meet pairwise, so a crowded list is spread over tasks. First a query
meets the nearest lists that hold k results; in the others only scores not below its k-th one so far count. A
pair of chunks gives one row for each query with such scores, holding the best k.

Defined cases: vectors that are null, zero, hold null or non-finite parts or are of another length than most
take no part, nor do null ids; of rows that share an id, the least vector counts; ties go to the smaller id;
fewer candidates than k give fewer rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqflow.llm.common import hash_sample, written


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 4) -> np.ndarray:
    """k centroids of `x`: bisection at the median of the main axis, then rounds of k-means in which the
    distance to a large cluster is raised."""
    parts, rng = [np.arange(len(x))], np.random.default_rng(7)
    while len(parts) < k:
        parts.sort(key=len)
        p = parts.pop()
        if len(p) < 2:
            parts.append(p)
            break
        y = x[p] - x[p].mean(0)
        axis = rng.standard_normal(x.shape[1]).astype(x.dtype)
        for _ in range(4):  # power iteration
            axis = y.T @ (y @ axis)
            axis /= np.linalg.norm(axis) + 1e-12
        order = np.argsort(y @ axis, kind="stable")
        share = (k - len(parts)) // 2 / (k - len(parts)) if len(parts) == 0 else 0.5
        cut = min(max(1, round(len(p) * share)), len(p) - 1)
        parts += [p[order[:cut]], p[order[cut:]]]
    c = np.stack([x[p].mean(0) for p in parts])
    of = np.empty(len(x), int)
    for i, p in enumerate(parts):
        of[p] = i
    for _ in range(rounds):
        size = np.bincount(of, minlength=len(c))
        extra = np.maximum(size / size.mean() - 1, 0)
        for a in range(0, len(x), 4096):
            d = squared(x[a:a + 4096], c)
            of[a:a + 4096] = np.argmin(d + 0.1 * np.median(d.min(1)) * extra, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        size = np.bincount(of, minlength=len(c))
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    return c.astype(np.float32)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1), 0)


def neighbour_graph(c: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours of each centroid, entry points): the nearest `degree`, and four random ones that keep far
    regions in reach."""
    k, rng = len(c), np.random.default_rng(11)
    near = np.empty((k, min(degree, k - 1) if k > 1 else 1), np.int32)
    for a in range(0, k, 1024):
        d = squared(c[a:a + 1024], c)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf if k > 1 else 0
        near[a:a + 1024] = np.argsort(d, axis=1, kind="stable")[:, :near.shape[1]]
    far = rng.integers(0, k, (k, 4), dtype=np.int32)
    return np.hstack([near, far]), rng.choice(k, min(k, max(8, int(k ** 0.5))), replace=False).astype(np.int32)


def graph_search(q: np.ndarray, c: np.ndarray, near: np.ndarray, entry: np.ndarray, width: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Best-first walk of all queries at once: (centroids, squared distances), nearest first, -1 where fewer."""
    b, norms = len(q), (c * c).sum(1)
    own = (q * q).sum(1)
    rows = np.arange(b)[:, None]
    seen = np.zeros((b, len(c) + 1), bool)

    def reach(ids: np.ndarray) -> np.ndarray:
        d = own[:, None] - 2 * np.einsum("bd,bnd->bn", q, c[ids], optimize=False) + norms[ids]
        d[seen[rows, ids]] = np.inf
        seen[rows, ids] = True
        first = np.sort(ids, axis=1)
        if (first[:, 1:] == first[:, :-1]).any():  # the same centroid twice in one step: count it once
            order = np.argsort(ids, axis=1, kind="stable")
            s = np.take_along_axis(ids, order, 1)
            again = np.zeros_like(s, bool)
            again[:, 1:] = s[:, 1:] == s[:, :-1]
            back = np.empty_like(again)
            np.put_along_axis(back, order, again, 1)
            d[back] = np.inf
        return d

    ids = np.broadcast_to(entry, (b, len(entry)))
    pool, dist, done = ids.copy(), reach(ids), np.zeros(ids.shape, bool)
    while True:
        order = np.argsort(dist, axis=1, kind="stable")[:, :width]
        pool, dist, done = (np.take_along_axis(v, order, 1) for v in (pool, dist, done))
        open_ = ~done & np.isfinite(dist)
        if not open_.any():
            break
        turn = np.cumsum(open_, axis=1)
        pick = np.argsort(~(open_ & (turn <= step)), axis=1, kind="stable")[:, :step]
        chosen = np.take_along_axis(open_, pick, 1)
        done[rows, pick] = True
        ids = near[np.take_along_axis(pool, pick, 1)]
        ids = np.where(chosen[:, :, None], ids, np.take_along_axis(pool, pick, 1)[:, :, None]).reshape(b, -1)
        d = reach(ids)
        pool, dist = np.hstack([pool, ids]), np.hstack([dist, d])
        done = np.hstack([done, np.zeros(ids.shape, bool)])
    return np.where(np.isfinite(dist), pool, -1), np.maximum(dist, 0)


def nearest(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All centroids, nearest first, as `graph_search` gives them: for indexes no larger than its width."""
    d = squared(q, c)
    ids = np.argsort(d, axis=1, kind="stable")
    return ids, np.take_along_axis(d, ids, 1)


def _matrix(c: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    return c.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(c), -1)


def lists_needed(order: np.ndarray, held_in: np.ndarray, recall: float) -> int:
    """Least number of lists that holds the share `recall` of neighbours. order: per neighbour, the lists, its query's
    nearest first; held_in: (neighbours, lists), whether the neighbour is in a list."""
    need = np.sort(np.argmax(np.take_along_axis(held_in, order, 1), axis=1) + 1)
    return int(need[min(len(need) - 1, max(0, int(np.ceil(recall * len(need))) - 1))])


def ratio_needed(d: np.ndarray, held_in: np.ndarray, recall: float) -> float:
    """Least ratio that holds the share `recall` of neighbours. d: for each neighbour, its query's distances from all
    lists; held_in: whether the neighbour is in a list."""
    need = np.sort((np.where(held_in, d, np.inf).min(axis=1) / d.min(axis=1)) - 1)
    return float(need[min(len(need) - 1, max(0, int(np.ceil(recall * len(need))) - 1))]) + 1e-6


def lists_within(q: np.ndarray, c: np.ndarray, near: np.ndarray, entry: np.ndarray, ratio: float, width: int,
                 most: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, distances) as `graph_search`, wide enough for `most` that it finds within (1 + ratio) of the least distance."""
    ids, d = graph_search(q, c, near, entry, width) if len(c) > width else nearest(q, c)
    d = np.sqrt(d)
    more = np.flatnonzero(d[:, -1] <= (1 + ratio) * d[:, 0]) if ids.shape[1] < min(len(c), most) else []
    if len(more):
        wide_ids, wide_d = lists_within(q[more], c, near, entry, ratio, 2 * width, most)
        out_ids, out_d = np.full((len(q), wide_ids.shape[1]), -1, ids.dtype), np.full((len(q), wide_ids.shape[1]), np.inf)
        out_ids[:, :ids.shape[1]], out_d[:, :ids.shape[1]] = ids, d
        out_ids[more], out_d[more] = wide_ids, wide_d
        return out_ids, out_d
    return ids, d


def _usable(v: Column) -> Column:
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def search(vectors: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           list_size: int = 128, max_lists: int = 4096, sample: int = 32768, degree: int = 24, replicas: int = 6,
           closure: float = 0.1, probes: int | None = None, ratio: float | None = None, chunk: int = 512, recall: float = 0.99,
           trials: int = 128) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that `is_query` (a condition on `vec_id`) selects,
    against every row but itself."""
    spark = vectors.sparkSession
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(_usable(F.col("v")), F.lit(False)))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if most is None:
        return empty
    rows = written(rows.where(F.size("v") == most["d"]).groupBy("vec_id").agg(F.min("v").alias("v")), "ann-rows")
    # one entry for equal vectors, with its k + 1 smallest ids
    firsts = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    reps = firsts.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    reps = written(reps.select(F.col("members")[0].alias("rep"), "v", "members"), "ann-entries")

    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, top2 = reps.agg(F.count(F.lit(1)), F.max(norm2)).first()
    size = min(sample, max(256, (1 << 23) // most["d"]))
    got = hash_sample(reps.select("rep", "v"), ["rep"], size, n, "ann").select("v").toArrow()
    lists = max(1, min(max_lists, -(-n // list_size), len(got)))
    length = float(np.sqrt(top2)) or 1.0

    def lifted(x: np.ndarray) -> np.ndarray:
        x = x / length
        return np.hstack([x, np.sqrt(np.maximum(1 - (x * x).sum(1), 0))[:, None]]).astype(np.float32)

    centroids = balanced_centroids(lifted(_matrix(got["v"], np.float64)), lists)
    index = spark.sparkContext.broadcast((centroids, *neighbour_graph(centroids, degree)))

    def choose(batches: Iterator[pa.RecordBatch], width: int, keep: int, slack: float, sizes=None) -> Iterator[pa.RecordBatch]:
        """Rows with each list they are put in, or, given the lists' sizes, are looked for in; `first`: the nearest
        lists that hold k results."""
        c, near, entry = index.value
        query = sizes is not None
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                x = _matrix(part.column("v"), np.float64)
                if query:  # only the direction of a query counts
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    x = np.hstack([x, np.zeros((len(x), 1))]).astype(np.float32)
                    ids, d = lists_within(x, c, near, entry, slack, width, keep + keep // 2)
                else:
                    x = lifted(x)
                    ids, d = graph_search(x, c, near, entry, width) if len(c) > width else nearest(x, c)
                    d = np.sqrt(d)
                ok = (ids >= 0) & (d <= (1 + slack) * d[:, :1] + 1e-6)
                ok[:, keep:] = False
                first = np.zeros_like(ok)
                if query:  # an entry is in at most `replicas` lists, so this many postings hold k + 1 entries
                    held = np.where(ids >= 0, sizes.value[ids], 0)
                    first = (ids >= 0) & (np.cumsum(held, axis=1) - held < (k + 1) * replicas)
                    short = held.sum(axis=1) < (k + 1) * replicas
                    if short.any() and ids.shape[1] < len(c):  # the walk found too few
                        all_ids, far = nearest(x[short], c)
                        own = np.cumsum(sizes.value[all_ids], axis=1) - sizes.value[all_ids] < (k + 1) * replicas
                        r, p = np.nonzero(own | (far <= (1 + slack) ** 2 * far[:, :1]))
                        yield named(all_ids[r, p], np.flatnonzero(short)[r], own[r, p], part)
                        ok[short], first[short] = False, False
                    ok |= first
                r, p = np.nonzero(ok)
                yield named(ids[r, p], r, first[r, p], part)

    def named(lists: np.ndarray, r: np.ndarray, first: np.ndarray, part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), part.column("rep").take(pa.array(r)), part.column("v").take(pa.array(r)), pa.array(first)],
                                          names=["list", "rep", "v", "first"])

    def measured(asked: DataFrame) -> tuple[int, float]:
        """The number of lists and the ratio that the trial queries need, from their k nearest by comparison with all
        entries. Each may lose half of what `recall` leaves."""
        t = hash_sample(asked, ["rep"], trials, asked.count(), "ann-trials").toArrow()
        if not t.num_rows:
            return 1, 0.0
        own, q = t["rep"].to_numpy(), _matrix(t["v"], np.float64)
        trial = spark.sparkContext.broadcast((own, q))

        def compare_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, q = trial.value
            for b in batches:
                reps = b.column("rep").to_numpy()
                s = q @ _matrix(b.column("v"), np.float64).T
                s[own[:, None] == reps] = -np.inf
                best = np.argsort(-s, axis=1, kind="stable")[:, :k]
                n = best.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(own)), n)), pa.array(reps[best].ravel()), pa.array(np.take_along_axis(s, best, 1).ravel())], names=["trial", "rep", "score"])

        best = reps.select("rep", "v").mapInArrow(compare_all, "trial long, rep long, score double").where(F.col("score") > float("-inf"))
        place = F.row_number().over(Window.partitionBy("trial").orderBy(F.desc("score"), "rep"))
        best = written(best.withColumn("n", place).where(F.col("n") <= k).select("trial", "rep"), "ann-truth")
        pairs = F.broadcast(best)  # at most trials * k rows
        got = posted.join(pairs, "rep").groupBy("trial", "rep").agg(F.collect_list("list").alias("lists")).collect()
        if not got:
            return 1, 0.0
        x = np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))]).astype(np.float32)
        d = np.sqrt(squared(x, centroids))[[r["trial"] for r in got]]
        held_in = np.zeros((len(got), lists), bool)
        for i, r in enumerate(got):
            held_in[i, r["lists"]] = True
        each = (1 + recall) / 2
        return lists_needed(np.argsort(d, axis=1, kind="stable"), held_in, each), ratio_needed(d, held_in, each)

    kind = "list int, rep long, v array<double>, first boolean"
    posted = written(reps.select("rep", "v").mapInArrow(lambda it: choose(it, max(24, 2 * replicas), replicas, closure), kind).drop("first"), "ann-lists", batch_rows=4096)
    count = np.zeros(lists, np.int64)
    for r in posted.groupBy("list").count().collect():  # at most max_lists rows
        count[r["list"]] = r["count"]
    held = spark.sparkContext.broadcast(count)
    wanted = rows.where(is_query).join(reps.select("rep", F.col("v").alias("_v")), F.col("v") == F.col("_v")).select("vec_id", "rep")
    wanted = written(wanted, "ann-queries")
    asked = reps.select("rep", "v").join(wanted.select("rep").distinct(), "rep", "left_semi")
    asked = written(asked, "ann-asked")
    if probes is None or ratio is None:
        most, slack = measured(asked)
        probes, ratio = most if probes is None else probes, slack if ratio is None else ratio
    asked = written(asked.mapInArrow(lambda it: choose(it, 32, probes, ratio, held), kind), "ann-probes", batch_rows=4096)

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        """A row for each query with scores not below its bound: the best k + 1, highest first."""
        if not a.num_rows or not b.num_rows:
            return best_schema.empty_table()
        x, q, ids = _matrix(a["v"], np.float64), _matrix(b["v"], np.float64), a["rep"].to_numpy()
        s = np.einsum("qd,nd->qn", q, x, optimize=False)
        bound = b["bound"].to_numpy()
        on = np.flatnonzero((s >= bound[:, None]).any(axis=1))
        tops = []
        for i in on.tolist():
            j = np.flatnonzero(s[i] >= bound[i])
            j = j[np.lexsort((ids[j], -s[i, j]))[:k + 1]]
            tops.append([{"s": -v, "rep": r} for v, r in zip(s[i, j].tolist(), ids[j].tolist(), strict=True)])
        return pa.table([b["rep"].take(pa.array(on)).combine_chunks(), pa.array(tops, best_schema.field(1).type)], schema=best_schema)

    best_schema = pa.schema([("query", pa.int64()), ("top", pa.list_(pa.struct([("s", pa.float64()), ("rep", pa.int64())])))])

    def met(asked: DataFrame) -> DataFrame:
        """Chunks of a list times chunks of the queries at it."""
        sizes = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("np"))
        calls = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("nq"))
        grid = F.broadcast(written(sizes.join(calls, "list"), "ann-grid"))  # a row per list: at most max_lists
        left = posted.join(grid, "list").withColumn("p", F.pmod(F.xxhash64("rep"), "np").cast("int"))
        left = left.select("list", "p", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("q"), "rep", "v")
        right = asked.join(grid, "list").withColumn("q", F.pmod(F.xxhash64("rep"), "nq").cast("int"))
        right = right.select("list", F.explode(F.sequence(F.lit(0), F.col("np") - 1)).alias("p"), "q", "rep", "v", "bound")
        return left.groupBy("list", "p", "q").cogroup(right.groupBy("list", "p", "q")).applyInArrow(compare, "query long, top array<struct<s:double,rep:long>>")

    def merged(found: DataFrame) -> DataFrame:
        """The best k + 1 of each query; an entry of several lists has the same score in each."""
        return found.groupBy("query").agg(F.slice(F.array_distinct(F.array_sort(F.flatten(F.collect_list("top")))), 1, k + 1).alias("top"))

    low = F.lit(float("-inf"))
    near = written(merged(met(asked.where("first").withColumn("bound", low))), "ann-near")
    bounds = near.select(F.col("query").alias("rep"), F.when(F.size("top") > k, -F.col("top")[k]["s"]).otherwise(low).alias("bound"))
    rest = asked.where("not first").join(bounds, "rep")
    found = merged(near.unionByName(met(written(rest, "ann-rest"))))
    found = found.select("query", F.explode("top").alias("t")).select("query", (-F.col("t.s")).alias("score"), F.col("t.rep").alias("rep"))
    found = found.join(reps.select("rep", "members"), "rep").select("query", "score", F.explode("members").alias("vec_id"))
    found = found.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k + 1).alias("best"))
    out = wanted.withColumnRenamed("vec_id", "query_id").join(found, F.col("rep") == F.col("query"))
    out = out.select("query_id", F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    out = out.select("query_id", F.posexplode("best").alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
