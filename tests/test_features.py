"""Hand-worked feature cases (values from the NumPy / pandas definitions)."""

import pytest
from pyspark.sql import functions as F

from seqflow.operators import features as FE


def seq(spark, values, key="p"):
    rows = [(key, 1.0, float(i + 1), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "part_number string, subpart_no double, subpart_index double, x double")


def feats(spark, values, window_size=3, features=FE.FEATURES, abs_cumsum=()):
    df = FE.add_signal_features(seq(spark, values), signals=("x",), window_size=window_size, features=features,
                                abs_cumsum=abs_cumsum)
    return {r["subpart_index"]: r for r in df.collect()}


def col(res, name):
    return [res[k][name] for k in sorted(res)]


def approx(values):
    return [None if v is None else pytest.approx(v) for v in values]


def test_gradient_and_second_gradient(spark):
    r = feats(spark, [1, 2, 4, 7, 11, 16])
    assert col(r, "x_velocity") == approx([1, 1.5, 2.5, 3.5, 4.5, 5])
    assert col(r, "x_acceleration") == approx([0.5, 0.75, 1, 1, 0.75, 0.5])


def test_gradient_with_gap(spark):
    r = feats(spark, [1, None, 4, 7])
    assert col(r, "x_velocity") == approx([None, 1.5, None, 3])


def test_centred_mean_with_gap(spark):
    r = feats(spark, [1, None, 4, 7])
    assert col(r, "x_moving_average") == approx([1, 2.5, 5.5, 5.5])


def test_centred_sum_even_window(spark):
    assert FE.centred_frame(4) == (-2, 1)
    df = seq(spark, [1, 2, 4, 7, 11, 16])
    from pyspark.sql import Window
    lo, hi = FE.centred_frame(4)
    w = Window.partitionBy("part_number", "subpart_no").orderBy("subpart_index").rowsBetween(lo, hi)
    got = [r["s"] for r in df.select("subpart_index", F.sum("x").over(w).alias("s")).orderBy("subpart_index").collect()]
    assert got == [3, 7, 14, 24, 38, 34]


def test_std_single_row_is_null(spark):
    r = feats(spark, [5])
    assert col(r, "x_moving_std") == [None]
    assert col(r, "x_velocity") == [None]  # one row: no gradient


def test_diff_cumsum_with_gap(spark):
    r = feats(spark, [1, None, 4, 7])
    assert col(r, "x_neighbor_diff") == approx([0, None, None, 3])
    assert col(r, "x_neighbor_diff_cumsum") == approx([0, None, None, 3])


def test_abs_diff_cumsum(spark):
    r = feats(spark, [5, 3, 6], abs_cumsum=("x",))
    assert col(r, "x_neighbor_diff_cumsum") == approx([0, 2, 5])


def test_two_rows_gradient(spark):
    r = feats(spark, [2, 5])
    assert col(r, "x_velocity") == approx([3, 3])


def test_magnitude_and_relative(spark):
    df = spark.createDataFrame([("p", 1.0, 1.0, 3.0, 4.0, 0.0), ("p", 1.0, 2.0, 1.0, None, 1.0)],
                               "part_number string, subpart_no double, subpart_index double, "
                               "third_param double, second_param double, first_param double")
    m = [r["magnitude"] for r in FE.add_magnitude(df).orderBy("subpart_index").collect()]
    assert m == [pytest.approx(5.0), None]
    rel = FE.add_relative_features(df, 1, 1, ["third_param"]).orderBy("subpart_index").collect()
    assert rel[1]["relative_third_param"] == pytest.approx(1.0 / (3.0 + 1e-9))


def test_relative_without_rows_in_range(spark):
    df = seq(spark, [1, 2]).withColumnRenamed("x", "first_param")
    r = FE.add_relative_features(df, 75, 125, ["first_param"]).collect()
    assert all(x["relative_first_param"] is None for x in r)


def test_feature_schema_and_conform(spark):
    df = seq(spark, [1.0])
    schema = FE.feature_schema(df, ["x", "row_index", "device", "new_feature"])
    assert [f.name for f in schema.fields][-3:] == ["row_index", "device", "new_feature"]
    out = FE.conform_to_schema(df, schema)
    r = out.collect()[0]
    assert r["device"] is None and dict(out.dtypes)["device"] == "string" and dict(out.dtypes)["new_feature"] == "double"


def test_skew_safe_features_equal_plain(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(1, 400):  # one hot key ...
        rows.append(("hot", 1.0, float(i), None if i % 37 == 0 else rnd.uniform(-5, 5)))
    for k in range(5):       # ... and small ones, including a one-row and a two-row group
        for i in range(1, [1, 2, 9, 10, 23][k] + 1):
            rows.append((f"k{k}", 1.0, float(i), rnd.uniform(0, 3)))
    df = spark.createDataFrame(rows, "part_number string, subpart_no double, subpart_index double, x double")
    for w in (3, 4):
        plain = FE.add_signal_features(df, signals=("x",), window_size=w, abs_cumsum=("x",))
        safe = FE.add_signal_features_skew_safe(df, signals=("x",), window_size=w, abs_cumsum=("x",), block_rows=8)
        assert safe.columns == plain.columns
        a = {(r["part_number"], r["subpart_index"]): r for r in plain.collect()}
        b = {(r["part_number"], r["subpart_index"]): r for r in safe.collect()}
        assert a.keys() == b.keys()
        for key in a:
            for c in plain.columns:
                va, vb = a[key][c], b[key][c]
                assert (va is None and vb is None) or va == pytest.approx(vb, abs=1e-9), (key, c, va, vb)
