"""Streaming ingest: two batches equal one batch; a restart adds nothing."""

import os

import pytest
from pyspark.sql import functions as F

from seqflow.sources import fixtures as FX
from seqflow.streaming import ingest as SI

from .conftest import SF_SMALL


def _rows(df):
    cols = ["device", "pos", "part_number", "subpart_no", "first_param", "temp_b"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_two_batches_equal_one_and_restart_is_idempotent(spark, tmp_dir):
    src = FX.json_source(spark, SF_SMALL)
    cut = src.select(F.percentile_approx("ts", 0.5)).first()[0]
    one, two = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "two")
    src.write.parquet(f"{one}/src/a")
    q = SI.start_ingest(spark, f"{one}/src/*", f"{one}/sink", f"{one}/ckpt")
    q.awaitTermination()

    src.where(F.col("ts") <= cut).write.parquet(f"{two}/src/a")
    SI.start_ingest(spark, f"{two}/src/*", f"{two}/sink", f"{two}/ckpt").awaitTermination()
    first = spark.read.parquet(f"{two}/sink").count()
    src.where(F.col("ts") > cut).write.parquet(f"{two}/src/b")
    SI.start_ingest(spark, f"{two}/src/*", f"{two}/sink", f"{two}/ckpt").awaitTermination()
    SI.start_ingest(spark, f"{two}/src/*", f"{two}/sink", f"{two}/ckpt").awaitTermination()  # restart, no new files

    a, b = spark.read.parquet(f"{one}/sink"), spark.read.parquet(f"{two}/sink")
    assert 0 < first < b.count()
    assert _rows(a) == _rows(b)
    assert a.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_foreach_batch_scoring_is_idempotent(spark, tmp_dir):
    from seqflow import catalog as C
    from seqflow.streaming import score as SS
    src = C.labelled(spark, SF_SMALL)
    src.write.parquet(f"{tmp_dir}/src/a")
    stream = spark.readStream.schema(src.schema).parquet(f"{tmp_dir}/src/*")

    def summary(feats):
        return feats.groupBy("part_number").agg(F.count(F.lit(1)).alias("n"))

    job = {"order_by": FX.MEASUREMENT_ORDER, "target_len": 20, "steps": C.STEPS, "scorer": summary, "n_subparts": C.K_SUBPARTS}

    def run():
        SS.start_scoring(stream, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", **job).awaitTermination()
        SS.finish_scoring(spark, src.schema, f"{tmp_dir}/sink", **job)
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/sink").collect())

    first = run()
    assert first and all(r[1] > 0 for r in first)
    assert run() == first  # restart without new files: nothing added
    src.limit(0).write.mode("append").parquet(f"{tmp_dir}/src/b")
    assert len(run()) >= len(first)


def test_runs_that_span_micro_batches(spark, tmp_dir):
    """Two runs over four files; the first is whole, by the delay, before the second ends."""
    from datetime import datetime, timedelta

    from seqflow.streaming import score as SS
    t0 = datetime(2024, 1, 1)
    schema = ("part_number string, subpart_no double, ts timestamp, first_param double, second_param double, third_param double, "
              "machine_position double, ng_valve_no string, subpart_label string")

    def rows(part, start, ids):
        return [(part, 1.0, start + timedelta(minutes=i), float(i), 1.0, 2.0, 3.0, None, "OK") for i in ids]

    late = t0 + timedelta(days=1)
    parts = [rows("a", t0, range(10)), rows("a", t0, range(10, 20)) + rows("b", late, range(4)), rows("b", late, range(4, 12)), rows("b", late, range(12, 20))]
    for k, r in enumerate(parts):
        spark.createDataFrame(r, schema).coalesce(1).write.parquet(f"{tmp_dir}/src/{k}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src/*")
        job = {"order_by": ["ts"], "target_len": 20, "steps": 20, "n_subparts": 1,
               "scorer": lambda f: f.groupBy("part_number").agg(F.count(F.lit(1)).alias("n"))}
        SS.start_scoring(stream, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", time_col="ts", delay="2 hours", **job).awaitTermination()
    done = {(r["part_number"], r["n"]) for r in spark.read.parquet(f"{tmp_dir}/sink").collect()}
    assert done == {("a", 20)}
    SS.finish_scoring(spark, stream.schema, f"{tmp_dir}/sink", **job)
    done = {(r["part_number"], r["n"]) for r in spark.read.parquet(f"{tmp_dir}/sink").collect()}
    assert done == {("a", 20), ("b", 20)}


RUN_SCHEMA = ("part_number string, subpart_no double, ts timestamp, first_param double, second_param double, third_param double, "
              "machine_position double, ng_valve_no string, subpart_label string")


def _run_rows(part, start, ids):
    from datetime import timedelta
    return [(part, 1.0, start + timedelta(minutes=i), float(i), 1.0, 2.0, 3.0, None, "OK") for i in ids]


class _Runs:
    """Drops of rows that are streamed one after the other with one checkpoint."""

    def __init__(self, spark, root, **job):
        self.spark, self.root, self.k = spark, root, 0
        self.job = {"order_by": ["ts"], "target_len": 20, "steps": 20, "n_subparts": 1,
                    "scorer": lambda f: f.groupBy("part_number").agg(F.count(F.lit(1)).alias("n"), F.min("first_param").alias("least"))} | job

    def drop(self, rows):
        self.spark.createDataFrame(rows, RUN_SCHEMA).repartition(2).write.parquet(f"{self.root}/src/{self.k}")
        self.k += 1
        return self.run()

    def run(self):
        from datetime import timedelta

        from seqflow.streaming import runs as SR
        stream = self.spark.readStream.schema(RUN_SCHEMA).parquet(f"{self.root}/src/*")
        q = SR.start_scoring_runs(stream, f"{self.root}/sink", f"{self.root}/ckpt", "ts", "30 minutes", timedelta(hours=2), **self.job)
        q.awaitTermination()
        return q

    def done(self):
        if not os.path.isdir(f"{self.root}/sink"):
            return []
        return sorted((r["part_number"], r["n"], r["least"]) for r in self.spark.read.parquet(f"{self.root}/sink").collect())


def test_runs_close_by_event_time(spark, tmp_dir):
    """State only for open runs; a late row is dropped; a restart adds nothing; a clock row closes the rest."""
    from datetime import datetime, timedelta

    from seqflow.streaming import runs as SR
    t0 = datetime(2024, 1, 1)
    r = _Runs(spark, tmp_dir)
    r.drop(_run_rows("a", t0, range(10)))
    r.drop(_run_rows("a", t0, range(15, 20)) + _run_rows("b", t0 + timedelta(minutes=35), range(4)))
    assert r.done() == []
    r.drop(_run_rows("a", t0, range(10, 15)))  # out of order, but not later than the watermark of 00:08
    assert r.done() == []
    q = r.drop(_run_rows("c", t0 + timedelta(days=1), range(7)))  # far later: closes a, and b as incomplete
    assert r.done() == [("a", 20, 0.0)]
    states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert states[-1]["numRowsTotal"] == 1  # c alone
    q = r.drop(_run_rows("a", t0, range(20, 40)))  # a whole run, later than the watermark: dropped
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]) >= 20
    r.run()  # restart without new rows
    assert r.done() == [("a", 20, 0.0)]
    r.drop(_run_rows("c", t0 + timedelta(days=1), range(7, 20)))
    SR.clock_row(spark, spark.createDataFrame([], RUN_SCHEMA).schema, "ts", t0 + timedelta(days=2)).write.parquet(f"{tmp_dir}/src/clock")
    q = r.run()
    assert r.done() == [("a", 20, 0.0), ("c", 20, 0.0)]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1] == 0


def test_two_runs_of_a_part_and_overlong_runs(spark, tmp_dir):
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1)
    r = _Runs(spark, tmp_dir)
    r.drop(_run_rows("a", t0, range(20)) + _run_rows("a", t0 + timedelta(hours=9), range(100, 119)) + _run_rows("long", t0, range(500)))
    r.drop(_run_rows("long", t0, range(500, 501)) + _run_rows("z", t0 + timedelta(days=3), range(20)))
    assert r.done() == [("a", 20, 0.0), ("a", 20, 100.0)]  # the second padded to 20; the overlong run is no run


def test_merge_runs():
    from seqflow.streaming.runs import merge_runs
    x, y, z = (0, 10, 2, [b"x"]), (30, 40, 3, [b"y"]), (15, 25, 1, [b"z"])
    assert merge_runs([y, x], 5, None) == [x, y]
    assert merge_runs([x, y, z], 5, None) == [(0, 40, 6, [b"x", b"z", b"y"])]
    assert merge_runs([x, y, z], 5, 4) == [(0, 40, 6, [])]
    assert merge_runs([x, (10, 10, 1, [b"t"])], 0, None) == [(0, 10, 3, [b"x", b"t"])]


def test_listing_takes_few_tasks(spark, tmp_dir):
    """A batch's files are looked up by a few tasks, not by one a file, each of which answers the driver; cut into
    batches, the files give the same rows, and those sent again are dropped in a later batch, too."""
    from seqflow.streaming import csv_ingest as SC

    folder = os.path.join(tmp_dir, "in", "a", "OK")
    os.makedirs(folder)
    for i in range(90):
        with open(os.path.join(folder, f"B_0_1_{i}_z.csv"), "w") as f:
            f.write(f"title\r\nheader\r\n1.0,0.0,0.0,0.0,{i}.0,,,,,,1.0,2.0\r\n")
    own = spark.conf.get(SC.LISTING, SC.DEFAULT_LISTING)
    spark.conf.set(SC.LISTING, SC.DEFAULT_LISTING)
    try:
        def run():
            query = SC.start_folder_ingest(spark, f"{tmp_dir}/in/*/OK", "OK", "M1", f"{tmp_dir}/sink", f"{tmp_dir}/checkpoint", max_files_per_trigger=50)
            query.awaitTermination()
            return sorted(r["first_param"] for r in spark.read.parquet(f"{tmp_dir}/sink").select("first_param").collect())

        assert run() == [float(i) for i in range(90)]
        assert int(spark.conf.get(SC.LISTING)) <= 64
        again = os.path.join(tmp_dir, "in", "b", "OK")
        os.makedirs(again)
        for name in os.listdir(folder):
            with open(os.path.join(folder, name), "rb") as f, open(os.path.join(again, name), "wb") as g:
                g.write(f.read())
        assert run() == [float(i) for i in range(90)]
        spark.conf.set(SC.LISTING, "7")
        assert run() and spark.conf.get(SC.LISTING) == "7"  # a number of the session's own stays
    finally:
        spark.conf.set(SC.LISTING, own)


def _csv(path, value):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(f"title\r\nheader\r\n1.0,0.0,0.0,0.0,{value}.0,,,,,,1.0,2.0\r\n")


def test_the_driver_keeps_no_entry_for_a_file(spark, tmp_dir, monkeypatch):
    """Tasks list the folders: the stream's own log names tables of the listing, not files; paths, hidden names, folders in
    folders and odd characters are as in a batch read; a restart without new files lists nothing."""
    from seqflow.sources import csv_folder as CSV
    from seqflow.streaming import csv_ingest as SC

    monkeypatch.setattr(SC, "LISTED_ROWS", 40)
    for i in range(100):
        _csv(f"{tmp_dir}/in/d é 100%25/{'sub/' * (i % 2)}B_0_1_{i}_z.csv", i)
    for name in ("_hidden/B_0_1_900_z.csv", ".hidden/B_0_1_901_z.csv", "B_0_1_902_z.csv._COPYING_", "_B_0_1_903_z.csv", "part=1/B_0_1_100_z.csv", "_p=1/B_0_1_101_z.csv", "B_0_1_904_z.CSV"):
        _csv(f"{tmp_dir}/in/d é 100%25/{name}", name.split("_")[-2] if "COPYING" not in name else 902)
    os.symlink(f"{tmp_dir}/nowhere", f"{tmp_dir}/in/d é 100%25/B_0_1_905_z.csv")

    def run(most=None):
        SC.start_folder_ingest(spark, f"{tmp_dir}/in/*", "OK", "M1", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", max_files_per_trigger=most).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/sink").select("path", "part_number", "first_param").collect()))

    def tables():
        return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{tmp_dir}/ckpt/listed") for f in names if f.endswith(".parquet"))

    got = run()
    os.remove(f"{tmp_dir}/in/d é 100%25/B_0_1_905_z.csv")
    batch = CSV.folder_ingest(spark, f"{tmp_dir}/in/*", "OK", "M1")
    assert got == sorted(map(tuple, batch.select("path", "part_number", "first_param").collect())) and len(got) == 102
    log = "".join(open(os.path.join(d, f), errors="replace").read() for d, _, names in os.walk(f"{tmp_dir}/ckpt/sources") for f in names if not f.startswith("."))
    assert ".csv" not in log and ".parquet" in log
    found = tables()
    assert found and all(spark.read.parquet(x).count() <= 40 for x in found)
    assert run() == got and tables() == found
    for i in range(5):
        _csv(f"{tmp_dir}/in/more/B_0_1_{500 + i}_z.csv", i)
    assert len(run(2)) == 107  # cut into batches of two files
    assert sorted(spark.read.parquet(x).count() for x in set(tables()) - set(found)) == [1, 2, 2]


def test_listings_that_end_early_and_files_that_go(spark, tmp_dir):
    from seqflow.streaming import csv_ingest as SC

    for i in range(6):
        _csv(f"{tmp_dir}/in/a/B_0_1_{i}_z.csv", i)

    def run(name):
        SC.start_folder_ingest(spark, f"{tmp_dir}/in/*", "OK", "M1", f"{tmp_dir}/sink-{name}", f"{tmp_dir}/{name}").awaitTermination()
        return sorted(r["first_param"] for r in spark.read.parquet(f"{tmp_dir}/sink-{name}").select("first_param").collect())

    SC.list_new(spark, f"{tmp_dir}/in/*", "OK", f"{tmp_dir}/x/listed")  # a run that ended between the listing and its batch
    os.remove(f"{tmp_dir}/in/a/B_0_1_3_z.csv")
    _csv(f"{tmp_dir}/in/a/B_0_1_7_z.csv", 7)
    assert run("x") == run("x") == [0.0, 1.0, 2.0, 4.0, 5.0, 7.0]
    assert SC.found_files(spark, [], "*.csv").count() == 0
    own = spark.conf.get(SC.MAX_LENGTH, SC.DEFAULT_MAX_LENGTH)
    spark.conf.set(SC.MAX_LENGTH, "20")
    try:
        with pytest.raises(Exception, match="B_0_1_._z.csv"):
            run("small")
    finally:
        spark.conf.set(SC.MAX_LENGTH, own)
    with pytest.raises(Exception, match="(?i)path"):
        SC.start_folder_ingest(spark, f"{tmp_dir}/missing", "OK", "M1", f"{tmp_dir}/sink", f"{tmp_dir}/y")
    SC.start_folder_ingest(spark, f"{tmp_dir}/missing*", "OK", "M1", f"{tmp_dir}/sink-none", f"{tmp_dir}/none").awaitTermination()


def test_the_file_source_where_tasks_cant_list(spark, tmp_dir, monkeypatch):
    """Checkpoints that it began stay with it, so no file is read again."""
    from seqflow.streaming import csv_ingest as SC

    def run():
        SC.start_folder_ingest(spark, f"{tmp_dir}/in/*", "OK", "M1", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt").awaitTermination()
        return sorted(r["first_param"] for r in spark.read.parquet(f"{tmp_dir}/sink").select("first_param").collect())

    _csv(f"{tmp_dir}/in/a/B_0_1_1_z.csv", 1)
    with monkeypatch.context() as m:
        m.setattr(SC, "_opens", lambda uri: False)
        assert run() == [1.0]
    _csv(f"{tmp_dir}/in/a/B_0_1_1_z.csv", 9)  # changed in place
    _csv(f"{tmp_dir}/in/a/B_0_1_2_z.csv", 2)
    assert run() == [1.0, 2.0]
    assert not os.path.exists(f"{tmp_dir}/ckpt/listed")


def test_a_query_that_goes_on_lists_again(spark, tmp_dir, monkeypatch):
    import time

    from seqflow.streaming import csv_ingest as SC

    monkeypatch.setattr(SC, "EVERY_S", 1)
    _csv(f"{tmp_dir}/in/a/B_0_1_1_z.csv", 1)
    query = SC.start_folder_ingest(spark, f"{tmp_dir}/in/*", "OK", "M1", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", available_now=False)
    try:
        _csv(f"{tmp_dir}/in/b/B_0_1_2_z.csv", 2)
        until = time.time() + 60
        while time.time() < until and spark.read.schema(SC.LISTED_SCHEMA).parquet(f"{tmp_dir}/ckpt/listed/kind=*").count() < 2:
            time.sleep(0.5)
    finally:
        query.stop()
    assert spark.read.parquet(f"{tmp_dir}/ckpt/listed").count() == 2
