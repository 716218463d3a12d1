"""Scaler, metrics, losses and run-log rules."""

import math

import pytest
from pyspark.sql import functions as F

from seqflow.functions.losses import bce_with_logits, focal_loss
from seqflow.operators import metrics as ME
from seqflow.operators import runlogs as RL
from seqflow.operators import scaling as SC


def test_scaler_fit_apply_properties(spark):
    df = spark.createDataFrame([(float(i), 5.0, None if i == 3 else float(i * i)) for i in range(10)],
                               "a double, c double, b double")
    params = SC.fit_scaler(df, ["a", "c", "b"], "s1")
    p = {r["feature"]: r for r in params.collect()}
    assert p["c"]["scale"] == 1.0 and p["a"]["mean"] == pytest.approx(4.5)
    out = SC.apply_scaler(df, params, ["a", "c", "b"])
    st = out.agg(F.avg("a"), F.stddev_pop("a"), F.max("c"), F.avg("b"), F.stddev_pop("b")).collect()[0]
    assert st[0] == pytest.approx(0, abs=1e-12) and st[1] == pytest.approx(1)
    assert st[2] == 0.0 and st[3] == pytest.approx(0, abs=1e-12) and st[4] == pytest.approx(1)


def test_scaler_save_load(spark, tmp_dir):
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    SC.save_scaler(SC.fit_scaler(df, ["a"], "s1"), tmp_dir)
    SC.save_scaler(SC.fit_scaler(df.withColumn("a", F.col("a") * 2), ["a"], "s2"), tmp_dir)
    got = SC.load_scaler(spark, tmp_dir, "s2").collect()
    assert len(got) == 1 and got[0]["mean"] == 4.0


def test_half_even_inverse(spark):
    params = spark.createDataFrame([("s", "f", 0.0, 1.0)], SC.SCALER_SCHEMA)
    df = spark.createDataFrame([(2.5,), (3.5,)], "m double")
    got = [r[0] for r in df.select(SC.inverse_mean(F.col("m"), params, "f")).collect()]
    assert got == [2.0, 4.0]


def test_report_and_fbeta(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 4
    df = spark.createDataFrame(pairs, "y int, p int")
    rep = {r["class"]: r for r in ME.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == pytest.approx(0.75) and rep["1"]["recall"] == pytest.approx(0.6)
    assert rep["accuracy"]["f1"] == pytest.approx(0.7) and rep["accuracy"]["support"] == 10
    f2 = ME.fbeta(df, "y", "p").collect()[0]["fbeta"]
    assert f2 == pytest.approx(5 * 3 / (5 * 3 + 4 * 2 + 1))
    zero = spark.createDataFrame([(0, 0)], "y int, p int")
    assert ME.fbeta(zero, "y", "p").collect()[0]["fbeta"] == 0.0
    cm = {(r[0], r[1]): r[2] for r in ME.confusion(df, "y", "p").collect()}
    assert cm[(1, 0)] == 2


def test_losses_stable_and_focal(spark):
    df = spark.createDataFrame([(-800.0, 1.0), (800.0, 0.0), (0.0, 1.0), (2.0, 0.0)], "z double, y double")
    r = df.select(bce_with_logits("z", "y").alias("b"), bce_with_logits("z", "y", 5.0).alias("w"),
                  focal_loss("z", "y").alias("f"), focal_loss("z", "y", dynamic_adjust=True, alpha=0.25).alias("d")
                  ).collect()
    assert r[0]["b"] == pytest.approx(800.0) and r[1]["b"] == pytest.approx(800.0)
    assert r[2]["b"] == pytest.approx(math.log(2)) and r[2]["w"] == pytest.approx(5 * math.log(2))
    b3 = 2.0 + math.log1p(math.exp(-2.0))
    assert r[3]["f"] == pytest.approx(0.5 * (1 - math.exp(-b3)) ** 2 * b3)
    assert r[3]["d"] == pytest.approx(0.75 * (1 - math.exp(-b3)) ** 2 * b3)
    sc = ME.score_rows(spark.createDataFrame([("m", "p", 1.0, 0.5), ("m", "p", 2.0, 0.7)],
                                             "machine string, part_number string, subpart_no double, prob double"))
    assert [r["label"] for r in sc.collect()] == [0, 1]


def _log(spark, losses, prec=None):
    prec = prec or [0.5] * len(losses)
    rows = [("r", i + 1, float(v), float(i) / 10, 0.95, float(p), 0.5) for i, (v, p) in enumerate(zip(losses, prec))]
    return spark.createDataFrame(rows, "run_id string, epoch int, val_loss double, f2_ng double, recall_ng double, "
                                       "precision_ng double, precision_ok double")


def test_early_stop_and_best_epoch(spark):
    log = _log(spark, [1.0, 0.9, 0.95, 0.96, 0.97, 0.98, 0.99, 0.5, 0.4])
    st = RL.early_stop(log, patience=5).collect()[0]
    assert st["stop_epoch"] == 7  # last improvement at epoch 2
    best = RL.best_epoch(log, patience=5).collect()[0]
    assert best["best_epoch"] == 7 and not best["zero_stop"]  # f2 grows with epoch, stop at 7 inclusive
    zlog = _log(spark, [1.0, 0.9, 0.8, 0.7], prec=[0.5, 0.5, 0.0, 0.5])
    zb = RL.best_epoch(zlog).collect()[0]
    assert zb["best_epoch"] == 2 and zb["f2_ng"] == 0.0 and zb["zero_stop"]
    # a zero precision after the early stop is never reached
    late = RL.best_epoch(_log(spark, [1.0, 1.1, 1.2, 1.3], prec=[0.5, 0.5, 0.5, 0.0]), patience=2).collect()[0]
    assert late["best_epoch"] == 3 and late["f2_ng"] == pytest.approx(0.2) and not late["zero_stop"]
    # a run that ends at once has epoch 0 and the initial metrics
    none = RL.best_epoch(_log(spark, [1.0, 0.9], prec=[0.0, 0.5])).collect()[0]
    assert none["best_epoch"] == 0 and none["f2_ng"] == 0.0 and none["val_loss"] == float("inf") and none["zero_stop"]
    assert "Join" not in RL.best_epoch(log)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bad", [(None, 1.0), (2.0, 1.0), (1.0, None), (0.0, 2.0)])
def test_report_rejects_other_labels(spark, bad):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), bad], "label double, prediction double")
    with pytest.raises(Exception, match="label and prediction must be 0 or 1"):
        ME.classification_report(df, "label", "prediction").collect()


def test_recall_trigger_and_rebalance(spark):
    log = _log(spark, [1.0] * 12)
    acts = {r["epoch"]: r["action"] for r in RL.recall_trigger(log).collect()}
    assert acts[7] == "lower" and acts[6] is None and acts[9] == "lower" and acts[8] is None
    w = spark.createDataFrame([(0.1,), (0.01,), (0.01,)], "weight double")
    got = sorted(r[0] for r in RL.rebalance_weights(w, factor=1.1).collect())
    assert got == [pytest.approx(0.009), pytest.approx(0.009), pytest.approx(0.11)]


def test_persist_fit_records_id(spark, tmp_dir):
    import os

    from seqflow.operators import state as ST
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    sid = SC.persist_fit(spark, SC.fit_scaler(df, ["a"]), os.path.join(tmp_dir, "sc"), os.path.join(tmp_dir, "st"))
    st = spark.read.parquet(os.path.join(tmp_dir, "st"))
    assert ST.get_value(st, "last_scaler_id") == sid
    assert SC.load_scaler(spark, os.path.join(tmp_dir, "sc"), sid).collect()[0]["mean"] == 2.0
