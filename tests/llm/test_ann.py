import numpy as np
from pyspark.sql import functions as F

from seqflow.llm import ann


def brute(rows, queries, k):
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids])
    out = {}
    for q in queries:
        s = [(-(x[j] @ np.array(rows[q])), i) for j, i in enumerate(ids) if i != q]
        out[q] = [(i, -v) for v, i in sorted(s)[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rep", "2 AS v", "3 AS list", "4 AS label")


def search(spark, rows, **options):
    got = {}
    for r in ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def test_recall_and_order(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 24))
    x = (centres[rng.integers(0, 20, 1500)] + 0.7 * rng.standard_normal((1500, 24))) * rng.uniform(0.5, 2, (1500, 1))
    x = x.astype(np.float32).astype(float)
    x[700:1000] = x[700]  # a large group of copies
    rows = {i: x[i].tolist() for i in range(1500)}
    bad = [(None, [1.0] * 24), (2000, None), (2001, [0.0] * 24), (2002, [float("nan")] * 24), (2003, [1.0] * 23), (2004, [None] + [1.0] * 23), (2005, [float("inf")] * 24), (2020, [])]
    got = search(spark, list(rows.items()) + bad + [(3, rows[3])], list_size=32, probes=24, chunk=16)
    exp = brute(rows, [i for i in rows if i % 20 == 0], 20)
    assert set(got) == set(exp)
    hits = 0
    for q, e in exp.items():
        assert [r for r, _, _ in got[q]] == list(range(1, 21)) and q not in {v for _, v, _ in got[q]}
        for _, v, s in got[q]:
            assert abs(s - np.dot(rows[q], rows[v])) < 1e-9
        order = [(-s, v) for _, v, s in got[q]]
        assert order == sorted(order)
        hits += len({v for _, v, _ in got[q]} & {v for v, _ in e})
    assert hits >= 0.9 * 20 * len(exp)
    copies = [v for _, v, _ in got[720]]
    assert set(copies) <= set(range(700, 1000)) | {v for v, _ in exp[720]}


def test_few_rows_are_exact(spark):
    rows = {0: [1.0, 0.0], 20: [0.0, 1.0], 3: [0.5, 0.5], 4: [1.0, 0.0], 5: [-1.0, 2.0]}
    got = search(spark, list(rows.items()))
    assert {q: [(v, s) for _, v, s in x] for q, x in got.items()} == brute(rows, [0, 20], 20)
    assert search(spark, [(0, [1.0, 2.0])]) == {} and search(spark, []) == {} and search(spark, [(1, [0.0])]) == {}


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    c = rng.standard_normal((700, 16)).astype(np.float32)
    q = rng.standard_normal((90, 16)).astype(np.float32)
    ids, d = ann.graph_search(q, c, *ann.neighbour_graph(c, 24), 48)
    exact = np.argsort(ann.squared(q, c), axis=1)[:, :10]
    found = np.mean([len(set(a[:10]) & set(b)) for a, b in zip(ids.tolist(), exact.tolist())])
    assert found >= 9.3 and (np.diff(d, axis=1) >= 0).all()
    assert all(len(set(r)) == len(r) for r in ids.tolist() if -1 not in r)
    sizes = np.bincount(np.argmin(ann.squared(c, ann.balanced_centroids(c, 20)), axis=1), minlength=20)
    assert sizes.max() <= 4 * sizes.mean()


def test_lists_grow_with_what_the_vectors_need(spark):
    """Random unit vectors in more lists than a fixed number of probes could hold."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((4000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32).astype(float)
    rows = {i: x[i].tolist() for i in range(4000)}
    exp = brute(rows, [i for i in rows if i % 20 == 0], 20)
    got = search(spark, list(rows.items()), list_size=8)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in e}) for q, e in exp.items())
    assert hits >= 0.98 * 20 * len(exp)


def test_ratio_needed():
    d = np.array([[1.0, 2, 3, 4], [4, 3, 2, 1], [2, 1, 4, 3], [3, 4, 1, 2]])
    held = np.zeros((4, 4), bool)
    held[0, [0, 3]] = held[1, 1] = held[2, 0] = held[3, 1] = True  # at 1, 3, 2 and 4 times the least distance
    assert [round(ann.ratio_needed(d, held, r), 3) for r in (0.25, 0.5, 0.75, 0.99, 1.0)] == [0, 1, 2, 3, 3]


def test_walk_widens_to_all_lists_within_the_ratio():
    rng = np.random.default_rng(3)
    c = rng.standard_normal((600, 8)).astype(np.float32)
    q = rng.standard_normal((40, 8)).astype(np.float32)
    ids, d = ann.lists_within(q, c, *ann.neighbour_graph(c, 24), 0.5, 8, 600)
    exact = np.sqrt(ann.squared(q, c))
    found = total = 0
    for i in range(len(q)):
        own = set(np.flatnonzero(exact[i] <= 1.5 * exact[i].min()).tolist())
        got = ids[i][(ids[i] >= 0) & (d[i] <= 1.5 * d[i, 0])].tolist()
        assert len(set(got)) == len(got) and set(got) <= own | set(got)
        found, total = found + len(own & set(got)), total + len(own)
    assert total > 40 * 8 and found >= 0.97 * total


def test_default_walks_the_graph_and_prunes_by_a_ratio(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 16))
    x = (centres[rng.integers(0, 60, 3000)] + 0.3 * rng.standard_normal((3000, 16))).astype(np.float32).astype(float)
    rows, ratios = {i: x[i].tolist() for i in range(3000)}, []
    real = ann.ratio_needed
    monkeypatch.setattr(ann, "ratio_needed", lambda d, held, recall: ratios.append((real(d, held, recall), d)) or ratios[-1][0])
    exp = brute(rows, [i for i in rows if i % 20 == 0], 20)
    got = search(spark, list(rows.items()), list_size=8)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in e}) for q, e in exp.items())
    assert hits >= 0.97 * 20 * len(exp)
    (ratio, d), = ratios
    within = (d <= (1 + ratio) * d.min(axis=1, keepdims=True)).sum(axis=1)
    assert d.shape[1] > 256 and within.mean() < 0.5 * d.shape[1]  # more lists than the walk is wide, and most are left out


def test_lists_needed():
    order = np.array([[0, 1, 2, 3], [3, 2, 1, 0], [1, 0, 3, 2], [2, 3, 0, 1]])
    held = np.zeros((4, 4), bool)
    held[0, [0, 3]] = held[1, 1] = held[2, 0] = held[3, 1] = True  # at places 1, 3, 2, 4
    assert [ann.lists_needed(order, held, r) for r in (0.25, 0.5, 0.75, 0.99, 1.0)] == [1, 2, 3, 4, 4]
