"""Smaller surfaces: matrix confusion, ordered write / read, strict extraction, model jobs."""

import os

import pytest
from pyspark.sql import functions as F

from seqflow.operators import metrics as ME
from seqflow.operators import ordering as OR
from seqflow.operators import sequences as SQ
from seqflow.plans import model as MD
from seqflow.sources import json_source as J

from .conftest import SF_SMALL


def test_confusion_matrix_pivot(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, p int")
    m = {r["label"]: (r["0"], r["1"]) for r in ME.confusion_matrix(df, "y", "p").collect()}
    assert m == {0: (2, 0), 1: (1, 1)}


def test_ordered_write_read_roundtrip(spark, tmp_dir):
    df = OR.add_row_index(spark.range(0, 300).withColumn("o", (F.col("id") * 37) % 301), ["o"])
    path = os.path.join(tmp_dir, "ordered")
    OR.write_ordered(df, path)
    back = [r["row_index"] for r in OR.read_ordered(spark, path).collect()]
    assert back == list(range(300))
    desc = [r["row_index"] for r in OR.sort_by_row_index(df, descending=True).take(3)]
    assert desc == [299, 298, 297]


def test_strict_extraction_fails_on_bad_cast(spark):
    raw = spark.createDataFrame([(1, "d", '[{"PROCESS_PART_TEMPERATURE_A": "hot"}]')], "ts long, device string, payload string")
    rows = J.unnest_json(raw)
    assert J.extract_measurements(rows).collect()[0]["temp_a"] is None
    with pytest.raises(Exception):
        J.extract_measurements(rows, strict=True).collect()


def test_model_fit_score_and_grid(spark):
    rows = []
    for i in range(80):
        y = float(i % 4 == 0)
        rows.append((f"p{i}", float(i), [[y * 3 + (i % 3) * 0.1, 1.0], [y * 2.0, 0.5]], y))
    nested = spark.createDataFrame(rows, "part_number string, subpart_no double, features array<array<double>>, "
                                         "subpart_label double")
    train = SQ.class_weights(nested)
    model = MD.fit_classifier(train, "logistic", {"maxIter": 30})
    scored = MD.score_sequences(model, nested, real_label="subpart_label")
    assert set(scored.columns) == {"machine", "part_number", "subpart_no", "real_label", "label", "prob_OK", "prob_NG"}
    rep = {r["class"]: r for r in ME.classification_report(scored, "real_label", "label").collect()}
    assert rep["1"]["recall"] == pytest.approx(1.0)
    cv = MD.grid_search(train, {"regParam": [0.0, 0.5]}, folds=2)
    assert len(cv.avgMetrics) == 2
    with pytest.raises(ValueError):
        MD.fit_classifier(train, "unknown")


def test_a_fit_holds_small_blocks_and_row_groups(spark, tmp_dir, monkeypatch):
    """Blocks of a fit stay under half of the smallest heap region (1 MB), and the nested table is written in small row groups."""
    import glob

    import pyarrow.parquet as pq

    from seqflow import catalog as C
    from seqflow.sources import tables as TB

    assert MD._estimator("logistic", {"maxIter": 3}, "y", "w").getMaxBlockSizeInMB() < 0.5
    assert MD._estimator("logistic", {"maxBlockSizeInMB": 2.0}, "y", None).getMaxBlockSizeInMB() == 2.0  # a number of the caller's own stays
    wide = spark.range(0, 400, 1, 1).select("id", F.transform(F.sequence(F.lit(1), F.lit(500)), lambda i: F.rand(1) + i).alias("x"))
    TB.write_table(wide, path=f"{tmp_dir}/t", options={"parquet.block.size": str(1 << 18)})
    found = pq.ParquetFile(glob.glob(f"{tmp_dir}/t/*.parquet")[0]).metadata
    assert found.num_row_groups > 1 and found.num_rows == 400
    seen = []
    monkeypatch.setattr(TB, "write_table", lambda df, f=TB.write_table, **k: seen.append(k.get("options") or {}) or f(df, **k))
    C._nested_with_split(spark, SF_SMALL, engineered=True)
    assert 0 < int(seen[-1]["parquet.block.size"]) <= 32 << 20
