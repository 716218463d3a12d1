"""State with several writers, mergeable scaler moments, folds by group."""

import math
import random
import threading

import pytest
from pyspark.sql import functions as F

from seqflow.operators import scaling as SC
from seqflow.operators import state as ST
from seqflow.plans import model as MD


def test_two_writers_lose_and_double_nothing(spark, tmp_dir):
    path, failed = f"{tmp_dir}/state", []
    ST.set_value(spark, path, "other", 0)

    def write(who):
        try:
            for i in range(6):
                assert ST.set_value(spark, path, "k", f"{who}-{i}")
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    rows = spark.read.parquet(path).where("key = 'k'").collect()
    assert sorted(r["version"] for r in rows) == list(range(1, 13))
    assert sorted(r["value"] for r in rows) == sorted(f'"{w}-{i}"' for w in "ab" for i in range(6))
    for w in "ab":  # each writer's values in its own order
        own = [r["value"] for r in sorted(rows, key=lambda r: r["version"]) if r["value"].startswith(f'"{w}')]
        assert own == sorted(own)


def test_a_claim_without_a_row_leaves_a_gap(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    assert ST.set_value(spark, path, "k", 1)
    claims = next(iter((__import__("pathlib").Path(f"{path}_claims")).iterdir()))
    (claims / "2").touch()
    assert ST.set_value(spark, path, "k", 2) and not ST.set_value(spark, path, "k", 2)
    assert sorted(r["version"] for r in spark.read.parquet(path).collect()) == [1, 3]
    assert ST.get_value(spark.read.parquet(path), "k") == 2


def test_an_append_leaves_the_files_of_others_alone(spark, tmp_dir):
    """Another writer's files in work, which Spark's committer would remove when it ends."""
    import pathlib

    path = f"{tmp_dir}/state"
    assert ST.set_value(spark, path, "k", 1)
    work = pathlib.Path(path, "_temporary", "0", "_temporary", "attempt_1")
    work.mkdir(parents=True)
    assert ST.set_value(spark, path, "k", 2) and work.exists()
    assert sorted((r["version"], r["value"]) for r in spark.read.parquet(path).collect()) == [(1, "1"), (2, "2")]


@pytest.mark.parametrize("parts", [1, 4])
def test_merged_moments_equal_one_fit(spark, parts):
    rng = random.Random(parts)
    rows = [(i % parts, 1e6 + rng.gauss(0, 3), rng.choice([None, 2.0, -7.5]), 5.0, None) for i in range(400)]
    df = spark.createDataFrame(rows, "batch int, a double, b double, constant double, nothing double")
    features = ["a", "b", "constant", "nothing"]
    pieces = [SC.fit_moments(df.where(F.col("batch") == k), features) for k in range(parts)] + [SC.fit_moments(df.limit(0), features)]
    merged = pieces[0]
    for p in pieces[1:]:
        merged = merged.unionByName(p)
    moments = {r["feature"]: r for r in SC.merge_moments(merged, "m").collect()}
    got = {r["feature"]: r for r in SC.scaler_from_moments(SC.merge_moments(merged, "m")).collect()}
    for r in SC.fit_scaler(df, features, "m").collect():
        g = got[r["feature"]]
        assert g["scaler_id"] == "m"
        for c in ("mean", "scale"):
            assert (g[c] is None) == (r[c] is None) and (r[c] is None or math.isclose(g[c], r[c], rel_tol=1e-9)), (r["feature"], c)
    assert moments["a"]["n"] == 400 and moments["nothing"]["n"] == 0
    twice = SC.merge_moments(SC.merge_moments(merged, "m").unionByName(SC.fit_moments(df, features)), "m").where("feature = 'a'").first()
    assert twice["n"] == 800 and math.isclose(twice["m2"], 2 * moments["a"]["m2"], rel_tol=1e-6)


def test_folds_keep_groups_together(spark):
    rng = random.Random(1)
    rows = [(f"p{i % 40}", i, [[rng.gauss(i % 2, 1)]], float(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "part_number string, chunk int, features array<array<double>>, subpart_label double")
    folds = df.withColumn("f", MD.fold_number(("part_number",), 3)).groupBy("part_number").agg(F.count_distinct("f").alias("n"), F.max("f").alias("f")).collect()
    assert {r["n"] for r in folds} == {1} and {r["f"] for r in folds} == {0, 1, 2}
    cv = MD.grid_search(df, {"regParam": [0.01]}, weight=None, folds=3, fold_by=("part_number",))
    assert 0.3 < cv.avgMetrics[0] <= 1
