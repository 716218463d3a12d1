"""Chunking, nesting, splits, resampling, skew-safe ordering."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seqflow.operators import sequences as SQ
from seqflow.operators.ordering import add_row_index, ordered_index


def test_ordered_index_matches_window_with_hot_key(spark):
    # one key holds most rows: positions must equal a per-key row_number
    rows = [("hot", i) for i in range(3000)] + [(f"k{i % 7}", i) for i in range(200)] + [(None, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o int")
    got = ordered_index(df, ["o"], ["k"], name="idx", num_partitions=16)
    exp = df.withColumn("e", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    j = got.join(exp, [got.k.eqNullSafe(exp.k), got.o == exp.o])
    assert j.count() == len(rows)
    assert j.where(F.col("idx") != F.col("e")).count() == 0


def test_global_row_index_dense(spark):
    df = spark.range(0, 5000).withColumn("o", (F.col("id") * 7919) % 5003)
    out = add_row_index(df, ["o"]).orderBy("o").select("row_index").collect()
    assert [r[0] for r in out] == list(range(5000))


def _rows(spark, parts=2, n=10):
    rows = []
    for p in range(parts):
        for i in range(1, n + 1):
            rows.append((f"p{p}", float(1 + (i - 1) // 4), float(i), float(i * 10 + p), 1.0 if p == 0 else 0.0))
    return spark.createDataFrame(rows, "part_number string, subpart_no double, part_index double, x double, "
                                       "subpart_label double")


def test_chunks_drop_tail_and_take_last_row(spark):
    ch = SQ.chunk_rows(_rows(spark), 4, by=("part_number",)).where(F.col("part_number") == "p0").orderBy(
        "chunk", "step").collect()
    assert len(ch) == 8  # 10 rows -> 2 chunks of 4, tail of 2 dropped
    assert {r["group_id"] for r in ch if r["chunk"] == 1} == {"p0#2.0"}
    assert {r["group_id"] for r in ch if r["chunk"] == 0} == {"p0#1.0"}


def test_chunks_per_sequence_do_not_drift(spark):
    # part p: subpart 1 has 6 rows (longer than T = 4), subpart 2 has 4 rows
    rows = [("p", 1.0, float(i), float(i), 0.0) for i in range(1, 7)] + [("p", 2.0, float(i), float(i), 1.0)
                                                                         for i in range(7, 11)]
    df = spark.createDataFrame(rows, "part_number string, subpart_no double, part_index double, x double, "
                                     "subpart_label double")
    per_seq = {(r["subpart_no"], r["chunk"]) for r in SQ.chunk_rows(df, 4).collect()}
    assert per_seq == {(1.0, 0), (2.0, 0)}  # subpart 2 stays one whole chunk
    assert {r["group_id"] for r in SQ.chunk_rows(df, 4).collect()} == {"p#1.0", "p#2.0"}
    per_part = SQ.chunk_rows(df, 4, by=("part_number",)).where(F.col("chunk") == 1).collect()
    assert sorted(r["x"] for r in per_part) == [5.0, 6.0, 7.0, 8.0]  # the stream drifts across subparts
    assert {r["group_id"] for r in per_part} == {"p#2.0"}


def test_nest_unnest_identity(spark):
    ch = SQ.chunk_rows(_rows(spark), 4, by=("part_number",))
    nested = SQ.nest_sequences(ch, ["x"], by=("part_number",))
    back = SQ.unnest_sequences(nested, ["x"])
    a = sorted((r["part_number"], r["chunk"], r["step"], r["x"]) for r in ch.collect())
    b = sorted((r["part_number"], r["chunk"], r["step"], r["x"]) for r in back.collect())
    assert a == b
    assert nested.where(F.size("features") != 4).count() == 0


def test_split_disjoint_complete_exact_quotas(spark):
    rows = [(f"p{i}", float(s), float(i % 3 == 0)) for i in range(60) for s in (1, 2)]
    df = spark.createDataFrame(rows, "part_number string, subpart_no double, subpart_label double")
    g = SQ.split_groups(df).collect()
    assert len(g) == 120 and len({(r[0], r[1]) for r in g}) == 120
    by = {}
    for r in g:
        by.setdefault(r["subpart_label"], {}).setdefault(r["split"], 0)
        by[r["subpart_label"]][r["split"]] += 1
    # label 1: 40 groups -> 30 train, floor(10 * 0.4) = 4 val, 6 test; label 0: 80 -> 60, 8, 12
    assert by[1.0] == {"train": 30, "val": 4, "test": 6}
    assert by[0.0] == {"train": 60, "val": 8, "test": 12}
    with pytest.raises(ValueError):
        SQ.split_fractions(0.9, 0.2)


def test_split_assign_keeps_groups_whole(spark):
    rows = [(f"p{i}", 1.0, float(i % 2), j) for i in range(20) for j in range(3)]
    df = spark.createDataFrame(rows, "part_number string, subpart_no double, subpart_label double, j int")
    g = SQ.split_groups(df)
    parts = [SQ.assign_split(df, g, s) for s in ("train", "val", "test")]
    assert sum(p.count() for p in parts) == df.count()


def test_class_weights_and_resample(spark):
    rows = [(f"k{i}", 1.0 if i < 10 else 0.0) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, subpart_label double")
    w = {r["k"]: r["weight"] for r in SQ.class_weights(df).collect()}
    assert w["k0"] == pytest.approx(0.1) and w["k50"] == pytest.approx(1 / 90)
    rs = SQ.resample_balanced(df, ["k"], seed=42)
    counts = {r[0]: r[1] for r in rs.groupBy("subpart_label").count().collect()}
    assert counts[1.0] == 50  # 10 rows x 5 copies exactly
    assert 40 <= counts[0.0] <= 60


def test_prepare_sequences_modes(spark):
    from seqflow.plans.sequences import prepare_sequences
    df = _rows(spark, parts=3, n=8)
    train, params = prepare_sequences(df, "train", ["x"], 4)
    assert sorted(round(r["weight"], 9) for r in train.collect()) == [0.25, 0.25, 0.25, 0.25, 0.5, 0.5]
    score, same = prepare_sequences(df, "score", ["x"], 4, scaler=params)
    rows = score.collect()
    assert len(rows) == 6 and {r["subpart_label"] for r in rows} == {0.0}
    flat = [v for r in train.collect() for step in r["features"] for v in step]
    assert sum(flat) == pytest.approx(0.0, abs=1e-9)  # centred by the train fit
    with pytest.raises(ValueError):
        prepare_sequences(df, "val", ["x"], 4)
    with pytest.raises(ValueError):
        prepare_sequences(df, "predict", ["x"], 4, scaler=params)
