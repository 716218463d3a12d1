"""JSON payload rows, positional CSV folders, state table, table write."""

import os

import pytest
from pyspark.sql import functions as F

from seqflow.operators import state as ST
from seqflow.plans import ingest as IG
from seqflow.sources import csv_folder as CSV
from seqflow.sources import json_source as J
from seqflow.sources import tables as TB

GOOD = ('[{"PART_NUMBER": "P1", "PROCESS_CYCLE_RUNNING_SUBPART_NUMBER": 0.3, "FEEDER_INTERNAL_FIRST_PARAM(0.01kPa)": 1.5,'
        ' "C_AXIS_MACHINE_POSITION(0.01deg)": "12.5"}, {"PART_NUMBER": "P1", "PROCESS_PART_TEMPERATURE_A": "x"}]')


def raw(spark):
    rows = [(10, "d1", GOOD), (11, "d1", None), (12, "d2", "[]"), (13, "d2", "not json"), (14, "d3", '{"k": 87}'),
            (20, "d1", '[{"PART_NUMBER": "P9"}]'), (20, "d0", '[{"PART_NUMBER": "P8"}, {"PART_NUMBER": "P7"}]')]
    return spark.createDataFrame(rows, "ts long, device string, payload string")


def test_unnest_outer_and_extract(spark):
    rows = J.extract_measurements(J.unnest_json(raw(spark))).orderBy("ts", "device", "pos").collect()
    assert len(rows) == 9  # 2 + null + [] + malformed + object + 1 + 2
    first = rows[0]
    assert first["part_number"] == "P1" and first["subpart_no"] == pytest.approx(0.3)
    assert first["machine_position"] == 12.5  # number held as text
    assert rows[1]["temp_a"] is None and rows[1]["first_param"] is None  # bad cast / missing key
    by_ts = {r["ts"]: r for r in rows}
    assert by_ts[11]["pos"] is None and by_ts[12]["pos"] is None and by_ts[13]["pos"] is None
    assert by_ts[14]["pos"] == 0 and by_ts[14]["part_number"] is None


def test_strict_parse_fails_on_malformed(spark):
    with pytest.raises(Exception):
        J.unnest_json(raw(spark).where(F.col("ts") == 13), strict=True).collect()


def test_incremental_and_watermark(spark):
    rows, wm = IG.ingest_json_with_watermark(raw(spark), 12)
    assert "ts" not in rows.columns and all(c == c.lower() for c in rows.columns)
    assert rows.count() == 5  # ts 13, 14, 20, 20, 20 (strictly newer than 12)
    w = wm.collect()[0]
    # ties at ts 20: lowest pos (0) then lowest device ('d0')
    assert w["last_ts"] == 20 and w["last_part"] == "P8"
    empty = IG.ingest_json_with_watermark(raw(spark), 99)[1]
    assert empty.count() == 0


def test_state_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "state")
    assert ST.set_value(spark, path, "T", 115)
    assert not ST.set_value(spark, path, "T", 115)  # same value: no new version
    assert ST.set_value(spark, path, "T", 120)
    st = spark.read.parquet(path)
    assert ST.get_value(st, "T") == 120
    with pytest.raises(KeyError):
        ST.get_value(st, "missing")


def test_write_modes(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "a int")
    path = os.path.join(tmp_dir, "t")
    TB.write_table(df, path=path)
    TB.write_table(df.where("a > 5"), path=path, mode="append")
    assert TB.read_table(spark, path=path).count() == 1
    t = TB.write_table(df.where("a > 5"), path=path, mode="overwrite")
    assert t.count() == 0 and t.columns == ["a"]


def _write(folder, name, lines, enc="latin-1"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding=enc, newline="") as fh:
        fh.write("".join(lines))


def test_csv_folder_edge_files(spark, tmp_dir):
    ng, ok = os.path.join(tmp_dir, "NG"), os.path.join(tmp_dir, "OK")
    head = ["Titel\r\n", "Nr,Achse,Leistung,Förderung,Druck,a,b,c,d,e,Temp A,Temp B\r\n"]
    row = lambda s, v: f"{s},1,2,3,{v},,,,,,20.5,21\r\n"
    _write(ng, "A_1_2_P1_3,4.csv", head + [row(3.0, 5), row(4.0, "bad"), row(5.0, 6)])
    _write(ng, "A_1_2_P2_x7.csv", head + [row(1.0, 1)])
    _write(ng, "A_1_2_P3.csv", head + [row(1.0, 1)])          # exactly 4 tokens
    _write(ng, "A_1_P4.csv", head + [row(1.0, 1)])            # 3 tokens: skipped
    _write(ng, "B_1_2_P5_3.csv", head + [row(3.0, 1)])        # not kind A in NG folder
    _write(ng, "notes.txt", ["x"])                            # not CSV
    _write(ok, "B_9_9_P6_z.csv", head + [row(2.0, 1), "\r\n"])
    rows = CSV.folder_ingest(spark, ng, "NG", device="M1").orderBy("part_number", "line_no").collect()
    got = [(r["part_number"], r["subpart_no"], r["first_param"], r["ng_valve_no"], r["subpart_label"]) for r in rows]
    assert got == [("P1", 3.0, 5.0, "3,4", "NG"), ("P1", 4.0, None, "3,4", "NG"), ("P1", 5.0, 6.0, "3,4", "OK_within_NG"),
                   ("P2", 1.0, 1.0, None, "NG"), ("P3", 1.0, 1.0, None, "NG")]
    assert rows[0]["temp_a"] == 20.5 and rows[0]["temp_b"] == 21.0 and rows[0]["device"] == "M1"
    okr = CSV.folder_ingest(spark, ok, "OK", device="M1").collect()
    assert [(r["part_number"], r["subpart_label"]) for r in okr] == [("P6", "OK")]


def test_csv_schema_collision_rejected():
    with pytest.raises(ValueError):
        CSV.column_positions(["device", "part_number"] + [f"f{i}" for i in range(11)])


def test_run_ingest_with_state(spark, tmp_dir):
    state, out = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "out")
    ST.set_value(spark, state, IG.LAST_TS_KEY, 12)
    assert IG.run_ingest(spark, raw(spark), state, out) == 20
    st = spark.read.parquet(state)
    assert ST.get_value(st, IG.LAST_TS_KEY) == 20 and ST.get_value(st, IG.LAST_PART_KEY) == "P8"
    assert spark.read.parquet(out).count() == 5
    assert IG.run_ingest(spark, raw(spark), state, out) is None  # nothing newer: no write, state kept
    assert spark.read.parquet(out).count() == 5


def test_set_value_after_a_failed_read_is_an_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "broken-state")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        ST.set_value(spark, path, "T", 1)


def test_increment_is_closed_and_repeatable(spark, tmp_dir):
    state, out = os.path.join(tmp_dir, "state2"), os.path.join(tmp_dir, "out2")
    ST.set_value(spark, state, IG.LAST_TS_KEY, 0)
    IG.run_ingest(spark, raw(spark).where("ts <= 12"), state, out)
    n = spark.read.parquet(out).count()
    # a crash after the write, before the state: the same increment again replaces its rows
    IG.run_ingest(spark, raw(spark).where("ts <= 12"), state, out, last_ts=0)
    assert spark.read.parquet(out).count() == n
    assert IG.run_ingest(spark, raw(spark), state, out) == 20
    assert spark.read.parquet(out).count() == n + 5


def test_nan_text_is_missing(spark):
    df = spark.createDataFrame([(1, "M", '[{"PART_NUMBER": "p", "PROCESS_PART_TEMPERATURE_A": "NaN", "PROCESS_PART_TEMPERATURE_B": "1.5"}]')],
                               "ts long, device string, payload string")
    from seqflow.sources import json_source as JS
    r = JS.extract_measurements(JS.unnest_json(df)).collect()[0]
    assert r["temp_a"] is None and r["temp_b"] == 1.5
