"""Preparation operators: ids, labels, length bounds, indexes, padding, grid alignment."""

import pytest
from pyspark.sql import functions as F

from seqflow.functions.scalar import subpart_status, valid_valve
from seqflow.operators import prepare as P


def test_normalize_and_exclude_zero(spark):
    df = spark.createDataFrame([(0.3,), (0.6,), (0.7,), (0.0,), (6.0,), (-1.0,), (None,), (7.0,)], "subpart_no double")
    got = sorted((r[0] is None, r[0]) for r in P.normalize_subparts(df).collect())
    vals = [v for _, v in got]
    assert vals == [-1.0, 0.7, 3.0, 6.0, 6.0, 7.0, None]


def test_valve_validation_and_status(spark):
    rows = [("3",), ("3,4",), ("12",), ("x7",), ("3,",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    assert [r[0] for r in df.select(valid_valve("v")).collect()] == ["3", "3,4", None, None, None, None]
    lab = spark.createDataFrame([("NG", "3", 3.0), ("NG", "3", 4.0), ("NG", None, 1.0), ("OK", None, 3.0),
                                 ("NG", "0", 3.0), ("NG", "3,4", 0.4)], "ft string, v string, s double")
    got = [r[0] for r in lab.select(subpart_status("ft", "v", "s")).collect()]
    # '0' is a substring of '3.0' (kept as in the source system)
    assert got == ["NG", "OK_within_NG", "NG", "OK", "NG", "NG"]


@pytest.mark.parametrize("k,steps,counts,kept", [
    (6, 200, [1080, 1081, 1319, 1320], [1081, 1319]),
    (6, 230, [1242, 1518, 1519], [1518]),
])
def test_length_bounds(spark, k, steps, counts, kept):
    rows = []
    for c in counts:
        rows += [(f"p{c}", 1.0)] * c
    df = spark.createDataFrame(rows, "part_number string, subpart_no double")
    out = P.filter_by_length(df, n_subparts=k, steps=steps)
    got = sorted(int(r[0][1:]) for r in out.select("part_number").distinct().collect())
    assert got == kept


def test_length_default_steps_from_min_subpart(spark):
    rows = [("a", 0.0)] * 1300 + [("b", 1.0)] * 1250
    df = spark.createDataFrame(rows, "part_number string, subpart_no double")
    # min subpart is 0 -> 230 steps -> (1242, 1518): both parts kept
    got = sorted(r[0] for r in P.filter_by_length(df).select("part_number").distinct().collect())
    assert got == ["a", "b"]


def test_null_part_dropped_by_length_filter(spark):
    df = spark.createDataFrame([(None, 1.0)] * 5 + [("a", 1.0)] * 5, "part_number string, subpart_no double")
    assert P.filter_by_length(df, 1, 5).where(F.col("part_number").isNull()).count() == 0


def test_indexes_and_pad(spark):
    df = spark.createDataFrame([("p", 1.0, 10, "a"), ("p", 1.0, 20, None), ("p", 2.0, 5, "c"),
                                ("p", 2.0, 6, "d"), ("p", 2.0, 7, "e"), (None, 1.0, 1, "z")],
                               "part_number string, subpart_no double, t int, v string")
    idx = P.add_subpart_index(df, ["t"])
    padded = P.pad_to_length(idx, 3)
    rows = sorted((r["subpart_no"], r["subpart_index"], r["v"]) for r in padded.collect())
    # pad to 3: index 3 copies the last row, NULL value included; NULL keys dropped
    assert rows == [(1.0, 1.0, "a"), (1.0, 2.0, None), (1.0, 3.0, None), (2.0, 1.0, "c"), (2.0, 2.0, "d"),
                    (2.0, 3.0, "e")]
    pi = P.add_part_index(padded).orderBy("part_index").collect()
    assert [(r["subpart_no"], r["subpart_index"]) for r in pi] == [
        (1.0, 1.0), (1.0, 2.0), (1.0, 3.0), (2.0, 1.0), (2.0, 2.0), (2.0, 3.0)]
    assert dict(padded.dtypes)["subpart_index"] == "double"


def test_pad_length_property(spark):
    rows = [("p", float(s), float(i)) for s in (1, 2) for i in range(1, 4 + s)]
    df = spark.createDataFrame(rows, "part_number string, subpart_no double, subpart_index double")
    out = P.pad_to_length(df, 4).groupBy("subpart_no").count().orderBy("subpart_no").collect()
    assert [r["count"] for r in out] == [4, 5]  # max(T, n)


def test_align_to_grid(spark):
    df = spark.createDataFrame([("p", 1.0, 1.0, 7.0), ("p", 1.0, 2.0, None), ("q", 1.0, 2.0, 5.0),
                                ("q", 1.0, 5.0, 9.0)],
                               "part_number string, subpart_no double, subpart_index double, x double")
    out = {(r[0], r[2]): r[3] for r in P.align_to_grid(df, 3, ["x"]).collect()}
    assert [out[("p", i)] for i in (1.0, 2.0, 3.0)] == [7.0, 7.0, 7.0]
    # q: slot 1 before the first row -> 0, slots 2-3 forward-filled, index 5 truncated
    assert [out[("q", i)] for i in (1.0, 2.0, 3.0)] == [0.0, 5.0, 5.0]
    assert len(out) == 6


def test_labels_and_union(spark):
    a = spark.createDataFrame([("OK",), ("OK_within_NG",), ("NG",), (None,)], "subpart_label string")
    out = [r[0] for r in P.labels_to_binary(P.exclude_ambiguous(a)).collect()]
    assert sorted(out, key=lambda v: (v is None, v)) == [0.0, 1.0, None]
    b = spark.createDataFrame([("NG", "3")], "subpart_label string, ng_valve_no string")
    u = P.union_sources(a, b)
    assert set(u.columns) == {"subpart_label", "ng_valve_no", "source_rank"}
    assert u.where(F.col("source_rank") == 1).count() == 1


def test_missing_column_raises(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(KeyError):
        P.add_part_index(df)


def test_skew_safe_indexes_equal_windows(spark):
    rows = [("hot", float(1 + i % 2), i) for i in range(500)] + [("c", 1.0, i) for i in range(7)]
    df = spark.createDataFrame(rows, "part_number string, subpart_no double, t int")
    a = P.add_part_index(P.add_subpart_index(df, ["t"]))
    b = P.add_part_index(P.add_subpart_index(df, ["t"], skew_safe=True), skew_safe=True)
    assert sorted(map(tuple, a.select("part_number", "t", "subpart_index", "part_index").collect()), key=str) == \
        sorted(map(tuple, b.select("part_number", "t", "subpart_index", "part_index").collect()), key=str)


def test_empty_inputs_give_typed_empty_outputs(spark):
    from seqflow.plans.features import feature_job
    from seqflow.plans.prepare import prepare_job
    schema = ("part_number string, subpart_no double, t int, first_param double, second_param double, "
              "third_param double, subpart_label string")
    empty = spark.createDataFrame([], schema)
    prep = prepare_job(empty, order_by=["t"], mode="train", n_subparts=1, steps=5)
    assert prep.count() == 0 and "part_index" in prep.columns
    feats = feature_job(prep, ["row_index", "first_param_velocity", "device"])
    assert feats.count() == 0
    types = dict(feats.dtypes)
    assert types["magnitude"] == "double" and types["row_index"] == "double" and types["device"] == "string"


def test_grid_and_pad_take_a_scalar_subquery_length(spark):
    df = spark.createDataFrame([("p", 1.0, 1.0, 2.0), ("p", 1.0, 2.0, 4.0), ("q", 1.0, 1.0, 1.0),
                                ("q", 1.0, 2.0, 1.0), ("q", 1.0, 3.0, 1.0)],
                               "part_number string, subpart_no double, subpart_index double, x double")
    t = P.column_max(df, "subpart_index")  # 3, computed by Spark, no action here
    grid = P.align_to_grid(df, t, ["x"]).where(F.col("part_number") == "p").orderBy("subpart_index").collect()
    assert [r["x"] for r in grid] == [2.0, 4.0, 4.0]
    padded = P.pad_to_length(df, t).groupBy("part_number").count().orderBy("part_number").collect()
    assert [r["count"] for r in padded] == [3, 3]
