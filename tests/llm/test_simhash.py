import random
import re

import numpy as np
import xxhash

from seqflow.llm import simhash

from .data import documents, edge_rows, prose


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def check(spark, rows, bucket):
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(documents(spark, rows), bucket=bucket).collect()}
    fps = [plain_fingerprint(r[1]) for r in rows]
    comp = components(fps, 2)
    for k, r in enumerate(rows):
        ids = [x[0] for x, c in zip(rows, comp) if c == comp[k] and x[0] is not None]
        assert got[r[0], f"{fps[k]:016x}"] == (min(ids) if ids else None)


def sample():
    rng = random.Random(1)
    rows = edge_rows()
    for i in range(120):
        base = prose(rng, 150).split()
        rows.append((i * 10, " ".join(base), "en", "s", 0))
        for k in range(i % 4):
            w = list(base)
            w[rng.randrange(len(w))] = "other"
            rows.append((i * 10 + 1 + k, " ".join(w).title() if k == 1 else "\n".join(w), "en", "s", 0))
    return rows


def test_components_match_brute_force(spark):
    check(spark, sample(), 64)


def test_crowded_buckets_lose_no_link(spark):
    check(spark, sample(), 1)


def test_meeting_points_are_exact(spark):
    rng = random.Random(2)
    for d in (1, 2, 3):
        a = [rng.getrandbits(64) for _ in range(6)]
        a += [x ^ sum(1 << b for b in rng.sample(range(64), k)) for x in a[:6] for k in (1, 2, 3, 4)]
        s = np.array(a, np.uint64).view(np.int64).tolist()
        df = spark.createDataFrame([(x,) for x in s], "fp long").select("fp", simhash._meeting_points(simhash.F.col("fp"), d).alias("z"))
        z = {r["fp"]: set(map(tuple, r["z"])) for r in df.collect()}
        for i in range(len(a)):
            for j in range(i):
                assert bool(z[s[i]] & z[s[j]]) == ((a[i] ^ a[j]).bit_count() <= d)


def test_allocation_covers_the_distance():
    rng = np.random.default_rng(0)
    for m in (2, 3, 4, 5):
        cost = np.sort(rng.random((m, 4)), axis=1)
        _, t = simhash.allocate(cost, 2)
        assert sum(x + 1 for x in t) == 3 and min(t) >= -1


def test_keep_one_and_empty(spark):
    rows = sample()
    kept = simhash.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    ids = [r["doc_id"] for r in kept.collect()]
    fps = {r[0]: plain_fingerprint(r[1]) for r in rows}
    left = [i for i in ids if i is not None and fps[i]]
    assert all((fps[a] ^ fps[b]).bit_count() > 2 for a in left for b in left if a < b)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_keep_one_keeps_a_row_of_each_component(spark):
    """Null ids and repeated ids: near rows with ids, near each other, and alone."""
    rng = random.Random(6)
    one, two, three, four, five, six = (prose(rng, 120) for _ in range(6))
    rows = [(10, one), (None, one), (None, two), (None, three), (None, three), (None, three), (20, four), (20, four),
            (30, five), (5, five), (30, six), (None, six), (40, None), (None, "")]
    rows = [(i, t, "en", "s", 0) for i, t in rows]
    kept = simhash.keep_one(documents(spark, rows, extra=False)).collect()
    got = [(r["doc_id"], r["text"]) for r in kept]
    assert sorted(got, key=repr) == sorted([(10, one), (None, two), (None, three), (20, four), (5, five), (30, six), (40, None)], key=repr)

    rows = sample() + [(None, r[1], "en", "s", 0) for r in sample()[9:60]] + [(10, r[1], "en", "s", 0) for r in sample()[60:90]]
    fps = [plain_fingerprint(r[1]) for r in rows]
    comp = components(fps, 2)
    kept = simhash.keep_one(documents(spark, rows)).collect()
    assert len(kept) == len(set(comp))
    least = {}
    for c, r in zip(comp, rows):
        least[c] = min(least.get(c, (True, 0)), (r[0] is None, r[0] or 0))
    mine = {f: c for f, c in zip(fps, comp)}
    assert {mine[plain_fingerprint(r["text"])]: (r["doc_id"] is None, r["doc_id"] or 0) for r in kept} == least
