"""Quoted cells as pandas reads them; the stream of new CSV files equals one batch read."""

import io
import os
import random
import shutil

import pandas as pd
import pytest

from seqflow.sources import csv_folder as CSV
from seqflow.streaming import csv_ingest as CI

HEAD = "title\r\nh1,h2\r\n"


def read(spark, text):
    df = spark.createDataFrame([("p", bytearray(text.encode("latin-1")))], "path string, content binary")
    rows = CSV.read_positional(df).orderBy("line_no").collect()
    return [tuple(r[c] for _, c in CSV.column_positions(CSV.DEFAULT_SCHEMA)) for r in rows]


def by_pandas(text):
    places = dict(CSV.column_positions(CSV.DEFAULT_SCHEMA))
    df = pd.read_csv(io.StringIO(text), skiprows=2, usecols=list(places), names=[places.get(i, f"x{i}") for i in range(12)], dtype=str,
                     keep_default_na=False, header=None)
    return [tuple(x or None for x in r) for r in df[[n for _, n in CSV.column_positions(CSV.DEFAULT_SCHEMA)]].itertuples(index=False)]


@pytest.mark.parametrize("seed", range(8))
def test_cells_as_pandas_reads_them(spark, seed):
    rng = random.Random(seed)
    cells = ["1.5", "x", "", '"a,b"', '"say ""hi"""', '"two\r\nlines"', '"\n"', '"a""\n""b"', 'in"side', "é", '""""', '"é,\n,"']
    rows = [[rng.choice(cells) for _ in range(12)] for _ in range(25)]
    for r in rows:
        r[0] = rng.choice(["1", '"2\n3"', '"q"'])
    text = HEAD + rng.choice(["\r\n", "\n"]).join(",".join(r) for r in rows) + rng.choice(["", "\n"])
    norm = lambda rs: [tuple(x.replace("\r\n", "\n") if x else x for x in r) for r in rs]
    assert norm(read(spark, text)) == norm(by_pandas(text))


def test_long_quoted_cells_and_unclosed_quotes(spark):
    long = '"' + 'x,""\n' * 100_000 + '"'
    got = read(spark, HEAD + f"1,{long},3,4,5,,,,,,8,9\n2,b,3,4,5,,,,,,8,9\n")
    assert len(got) == 2 and got[0][1] == 'x,"\n' * 100_000 and got[1][:2] == ("2", "b")
    assert [r[0] for r in read(spark, HEAD + '1,"open,3\n2,b,3\n')] == ["1", "2"]


def test_stream_of_drops_equals_one_batch(spark, tmp_dir):
    """Two drops, one file sent again, one with a known name and another content, a restart."""
    def put(drop, name, values):
        os.makedirs(f"{tmp_dir}/in/{drop}", exist_ok=True)
        with open(f"{tmp_dir}/in/{drop}/{name}", "w", encoding="latin-1") as f:
            f.write(HEAD + "".join(f'{i + 1},0,0,0,{v},"a\nb",,,,,1,2\n' for i, v in enumerate(values)))

    def run():
        CI.start_folder_ingest(spark, f"{tmp_dir}/in/*", "NG", "M1", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt").awaitTermination()
        cols = ["part_number", "subpart_no", "first_param", "ng_valve_no", "subpart_label"]
        return sorted(map(repr, spark.read.parquet(f"{tmp_dir}/sink").select(cols).collect())), cols

    put("1", "A_0_1_p1_3,4.csv", [1, 2, 3])
    put("1", "B_0_1_p9_3.csv", [9])
    put("1", "A_short.csv", [9])
    assert len(run()[0]) == 3
    put("2", "A_0_1_p2_1.csv", [4, 5])
    put("2", "A_0_1_p1_3,4.csv", [7])
    os.makedirs(f"{tmp_dir}/in/3")
    shutil.copy(f"{tmp_dir}/in/1/A_0_1_p1_3,4.csv", f"{tmp_dir}/in/3/A_0_1_p1_3,4.csv")
    got, cols = run()
    shutil.copytree(f"{tmp_dir}/in", f"{tmp_dir}/all", ignore=lambda d, n: n if d.endswith("/3") else [])
    batch = CSV.folder_ingest(spark, f"{tmp_dir}/all", "NG", "M1")
    assert got == sorted(map(repr, batch.select(cols).collect())) and len(got) == 6
    assert run()[0] == got
