import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor, k=5, m=3, low=50, high=95, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in v)]
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for i, (a, v, y) in enumerate(kept):
        if a is None or a % anchor:
            continue
        scored = [(clip(sum(p * q for p, q in zip(v, w, strict=False))), b, z) for j, (b, w, z) in enumerate(kept) if j != i]
        for s, b, _ in sorted((t for t in scored if t[2] == y), key=order)[:k]:
            near = sorted((t for t in scored if t[2] != y and low * s <= 100 * t[0] <= high * s), key=order)[:m]
            out += [(a, b, r + 1, n, s, t) for r, (t, n, _) in enumerate(near)]
    return sorted(out, key=repr)


def mined(spark, rows, anchor, parts=3, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("extra")).withColumn("g", F.lit(1)).repartition(parts)
    got = hn.mine(df, F.col("vec_id") % anchor == 0, block_rows=64, **more)
    return sorted(map(tuple, got.collect()), key=repr)


def unit(rng, dim):
    v = [rng.gauss(0, 1) for _ in range(dim)]
    n = math.sqrt(sum(x * x for x in v)) or 1
    return [x / n for x in v]


def test_brute_force_with_ties_copies_and_bad_rows(spark):
    rng = random.Random(12)
    centre = [unit(rng, 16) for _ in range(3)]
    rows = [(i, [0.7 * c + 0.3 * x for c, x in zip(centre[i % 3], unit(rng, 16), strict=True)], i % 4) for i in range(300)]
    rows += [(300 + i, rows[0][1], i % 2) for i in range(80)]  # copies
    rows += [rows[10], rows[10], (None, rows[1][1], 1), (None, rows[2][1], 2), (500, None, 1), (510, rows[3][1], None), (520, [0.1, None], 1),
             (530, [math.nan] * 16, 1), (540, [math.inf] * 16, 2), (550, [1e308] * 16, 1), (560, [], 1), (570, [0.5, -0.5], 2), (580, [0.0] * 16, 0)]
    expected = brute(rows, 10)
    assert len(expected) > 200
    assert mined(spark, rows, 10) == expected
    assert mined(spark, rows, 10, parts=1, group_rows=7) == expected


@pytest.mark.parametrize("top", [1.0, 3e4, 2e9, 1e40])
def test_wide_components_stay_exact(spark, top):
    rng = random.Random(int(top) % 97)
    rows = [(i, [top * (0.6 + 0.4 * rng.random()) * (1 if rng.random() < 0.9 else -1) for _ in range(5)], i % 2) for i in range(60)]
    assert mined(spark, rows, 6) == brute(rows, 6)


@pytest.mark.parametrize("lo, hi, dim", [(-256, 255, 64), (-3, 3, 2), (0, 0, 4), (5, 9, 3), (-9, -5, 3), (-2**20, 2**20, 9), (-2**24, 2**24, 9), (-10**30, 10**30, 4)])
def test_fields_never_carry(lo, hi, dim):
    rng = random.Random(dim)
    p = hn.Packing(lo, hi, dim)
    pick = lambda n: np.array([[rng.choice([lo, hi, rng.randint(lo, hi)]) for _ in range(dim)] for _ in range(n)], object)
    a, c = pick(7), pick(41)
    kind = object if p.exact else np.int64
    ints = p.biased(c.astype(kind))
    got = p.scores(p.biased(a.astype(kind)) if p.exact else p.biased(a.astype(kind)).astype(float), p.pack(ints), ints.sum(axis=1))
    assert p.exact or p.fields * p.bits <= 53
    assert (got == np.clip(a @ c.T, hn.LOW64, hn.HIGH64)).all()


def test_packs_two_candidates_a_product_for_unit_vectors():
    assert hn.Packing(-256, 255, 64).fields == 2 and not hn.Packing(-256, 255, 64).exact


def test_no_anchors_one_label_empty(spark):
    rng = random.Random(1)
    assert mined(spark, [(i, unit(rng, 4), 1) for i in range(1, 20)], 50) == []
    assert mined(spark, [(i, unit(rng, 4), 1) for i in range(20)], 2) == []
    assert mined(spark, [], 2) == []
