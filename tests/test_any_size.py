"""Operators on groups of any size: exact draws, medians by rank, fill by carry, padding from counts; each against the
plain form or a brute-force one, with a group that is cut over many ranges."""

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from seqflow.operators import features as FE
from seqflow.operators import prepare as P
from seqflow.operators import sequences as SQ
from seqflow.operators.ordering import ordered_sum


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.fixture(scope="module")
def hot(spark):
    """One group of 4,000 rows, several short ones, gaps in the index and missing values."""
    rng = random.Random(6)
    rows = []
    for part, n in [("hot", 4000), ("a", 7), ("b", 1), ("c", 60), (None, 9)]:
        at = 0
        for _ in range(n):
            at += rng.choice([1, 1, 1, 2, 5])
            pick = lambda: rng.choice([None, None, rng.randint(0, 9) / 4])  # noqa: B023, E731
            rows.append((part, 1.0, float(at), pick(), pick(), rng.random()))
    return spark.createDataFrame(rows, "part_number string, subpart_no double, subpart_index double, first_param double, second_param double, third_param double").repartition(8)


@pytest.mark.parametrize("n", [0, 1, 7, 472, 5003])
def test_draws_sum_to_n(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([0.0, 0.0, 0.0, 1.0, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, subpart_label double").repartition(5)
    got = SQ.resample_exact(df, ["id"], n).collect()
    assert len(got) == n
    copies, sizes = Counter(r["id"] for r in got), Counter(y for _, y in rows)
    for y, size in sizes.items():
        own = [copies[i] for i, z in rows if z == y]
        assert abs(sum(own) - n / len(sizes)) <= 1 and all(abs(c - n / len(sizes) / size) < 1 + 1e-6 for c in own)
    assert all(sorted(r["copy"] for r in got if r["id"] == i) == list(range(1, c + 1)) for i, c in copies.items())
    again = SQ.resample_exact(df.repartition(3), ["id"], n).collect()
    assert key(again) == key(got)


def test_draws_by_any_weight(spark):
    rows = [(i, w) for i, w in enumerate([1.0, 2.5, None, 0.0, -3.0, float("nan"), 1e-9, 6.5])]
    df = spark.createDataFrame(rows, "id long, w double")
    copies = Counter(r["id"] for r in SQ.resample_exact(df, ["id"], 1000, label=None, weight="w").collect())
    assert sum(copies.values()) == 1000 and {i: copies[i] for i in (2, 3, 4, 5)} == dict.fromkeys((2, 3, 4, 5), 0)
    assert copies[0] == 100 and copies[1] == 250 and copies[7] == 650
    assert SQ.resample_exact(df.where("id = 3"), ["id"], 5, label=None, weight="w").count() == 0
    with pytest.raises(ValueError):
        SQ.resample_exact(df, ["id"], -1, label=None, weight="w")


def test_ordered_sum_is_exact(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 10**17)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, v long").select("id", F.col("v").cast("decimal(38,0)").alias("v")).repartition(6)
    total = 0
    got = ordered_sum(df, "v", ["id"], num_partitions=9).orderBy("id").collect()
    for (i, v), r in zip(rows, got, strict=True):
        total += v
        assert (r["id"], int(r["prefix_sum"])) == (i, total)


def test_medians_by_rank(spark, hot):
    got = FE.median_setpoints_by_rank(hot, 10, 9000).collect()
    plain = FE.median_setpoints(hot, 10, 9000).collect()
    assert key(got) == key(plain) and len(got) >= 3
    rows = [r["third_param"] for r in hot.where("part_number = 'hot' and subpart_index between 10 and 9000").collect()]
    assert next(r for r in got if r["part_number"] == "hot")["third_param_setpoint"] == pytest.approx(median(rows), abs=0)
    plan = FE.add_relative_features(hot, 10, 9000, skew_safe=True)
    assert key(plan.collect()) == key(FE.add_relative_features(hot, 10, 9000).collect())
    assert FE.median_setpoints_by_rank(hot.limit(0)).count() == 0


@pytest.mark.parametrize("t", [1, 50, 3000, 20_000])
def test_fill_by_carry(hot, t):
    cols = ["first_param", "second_param"]
    df = hot.where("part_number is not null")
    got = P.align_to_grid(df, t, cols, skew_safe=True)
    assert key(got.collect()) == key(P.align_to_grid(df, t, cols).collect())


def test_no_window_over_a_whole_group(hot):
    out = P.align_to_grid(hot, 50, ["first_param"], skew_safe=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__sf_pid" in line for line in windows)
    assert "Window" not in P.pad_to_length(hot, 50, skew_safe=True)._jdf.queryExecution().optimizedPlan().toString()


def test_padding_from_counts(hot):
    for t in (1, 40, 5000):
        assert key(P.pad_to_length(hot, t, skew_safe=True).collect()) == key(P.pad_to_length(hot, t).collect())


def test_grouped_pandas_over_many_batches(spark):
    """Groups shorter and longer than a batch, null, NaN and signed zero keys, results of changing types; each group whole."""
    import pandas as pd

    rng, nan = random.Random(3), float("nan")
    keys = [(p, s) for p in ("a", "b", None) for s in (0.0, 1.0, nan, None)] + [("long", 1.0)]
    rows = [(p, -0.0 if s == 0.0 and i % 2 else s, rng.choice([None, rng.random()])) for p, s in keys for i in range(900 if p == "long" else rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "part_number string, subpart_no double, x double").repartition(5)

    def stats(pdf):
        assert list(pdf.index) == list(range(len(pdf))) and list(pdf.columns) == ["part_number", "subpart_no", "x"]
        out = pd.DataFrame({"p": [pdf["part_number"].iloc[0]], "n": [len(pdf)], "seen": [int(pdf["x"].notna().sum()) if len(pdf) % 2 else None]})
        return out if len(pdf) != 2 else pd.DataFrame()

    schema = "p string, n long, seen long"
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = FE.apply_grouped_pandas(df, stats, schema)
            assert "MapInPandas" in got._jdf.queryExecution().toString()  # not a message to Python per group
            assert key(got.collect()) == key(df.groupBy("part_number", "subpart_no").applyInPandas(stats, schema).collect())
        assert FE.apply_grouped_pandas(df.where("x > 2"), stats, schema).count() == 0
        # whole numbers keep their type per group, and a function may take the key
        numbers = spark.createDataFrame([("a", 1.0, 2**60 + 1), ("b", 1.0, None)], "part_number string, subpart_no double, x long")
        with_key = FE.apply_grouped_pandas(numbers, lambda k, pdf: pd.DataFrame({"p": [k[0]], "x": [str(pdf["x"].iloc[0])]}), "p string, x string")
        assert dict(map(tuple, with_key.collect()))["a"] == str(2**60 + 1)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
