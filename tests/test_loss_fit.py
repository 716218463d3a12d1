"""Op 69 with the configured losses: against plain numpy on the same rows, the loss columns and the run-log rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqflow.functions.losses import bce_with_logits, focal_loss
from seqflow.operators import runlogs as RL
from seqflow.plans import loss_fit as LF


def rows(n=900, dim=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    z = x @ np.array([1.5, -1.0, 0.5, 0.0])[:dim] - 1.2
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)
    return x, y, rng.uniform(0.5, 2, n)


def frame(spark, x, y, w, parts=5):
    data = [(a.tolist(), float(b), float(c)) for a, b, c in zip(x, y, w, strict=True)]
    return spark.createDataFrame(data, "x array<double>, subpart_label double, w double").repartition(parts)


def newton(x, y, w, loss, reg):
    """Plain numpy: damped Newton steps with a Hessian by central differences of the gradient."""
    a = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.array([reg] * x.shape[1] + [0.0])

    def gradient(t):
        return a.T @ (w * loss(a @ t, y)[1]) / w.sum() + penalty * t

    def value(t):
        return (w * loss(a @ t, y)[0]).sum() / w.sum() + 0.5 * (penalty * t * t).sum()

    t = np.zeros(a.shape[1])
    for _ in range(200):
        g = gradient(t)
        h = np.stack([(gradient(t + e) - gradient(t - e)) / 2e-6 for e in 1e-6 * np.eye(len(t))])
        lam, v = np.linalg.eigh((h + h.T) / 2)
        step, size = -(v / np.maximum(np.abs(lam), 1e-6)) @ (v.T @ g), 1.0
        while value(t + size * step) > value(t) and size > 1e-9:
            size /= 2
        t = t + size * step
        if np.abs(g).max() < 1e-12:
            break
    return t


CASES = [("default", {}, LF.cross_entropy()), ("weighted", {"pos_weight": 4.0}, LF.cross_entropy(4.0)), ("focal", {"gamma": 2.0, "alpha": 0.5}, LF.focal(2.0, 0.5)),
         ("focal", {"gamma": 1.5, "alpha": 0.3, "by_label": True}, LF.focal(1.5, 0.3, True))]


@pytest.mark.parametrize("kind, options, loss", CASES)
def test_coefficients_as_a_plain_fit(spark, kind, options, loss):
    x, y, w = rows()
    fit = LF.fit_loss(frame(spark, x, y, w), kind, weight="w", reg=0.01, epochs=300, **options)
    expected = newton(x, y, w, loss, 0.01)
    assert np.abs(np.append(fit.model.coefficients, fit.model.intercept) - expected).max() < 1e-6
    losses = [e["train_loss"] for e in fit.epochs]
    assert losses == sorted(losses, reverse=True)


@pytest.mark.parametrize("kind, options, loss", CASES)
def test_losses_equal_the_columns_and_their_slopes(spark, kind, options, loss):
    z, y = np.repeat(np.linspace(-30, 30, 121), 2), np.tile([0.0, 1.0], 121)
    df = spark.createDataFrame(list(zip(z.tolist(), y.tolist(), strict=True)), "z double, y double")
    if kind == "focal":
        column = focal_loss("z", "y", options["gamma"], options["alpha"], options.get("by_label", False))
    else:
        column = bce_with_logits("z", "y", options.get("pos_weight"))
    got = {(r[0], r[1]): r[2] for r in df.select("z", "y", column).collect()}
    value, slope = loss(z, y)
    assert max(abs(got[a, b] - v) for a, b, v in zip(z.tolist(), y.tolist(), value, strict=True)) < 1e-9
    near = (loss(z + 1e-6, y)[0] - loss(z - 1e-6, y)[0]) / 2e-6
    assert np.abs(near - slope).max() < 1e-6


def test_run_log_feeds_the_run_rules(spark):
    x, y, w = rows(600)
    train, val = frame(spark, x[:400], y[:400], w[:400]), frame(spark, x[400:], y[400:], w[400:])
    fit = LF.fit_loss(train, "focal", val=val, reg=0.01, epochs=40, patience=3)
    log = fit.run_log(spark)
    got = RL.best_epoch(log, patience=3).first()
    epochs = {e["epoch"]: e for e in fit.epochs}
    best = max(epochs.values(), key=lambda e: (e["f2_ng"], -e["val_loss"], -e["epoch"]))
    assert got["best_epoch"] == best["epoch"] and got["f2_ng"] == pytest.approx(best["f2_ng"])
    stop = RL.early_stop(log, patience=3).first()
    assert stop["stop_epoch"] in (None, len(epochs))
    z = x[400:] @ fit.model.coefficients + fit.model.intercept
    tp, fp, fn = ((z > 0) & (y[400:] == 1)).sum(), ((z > 0) & (y[400:] == 0)).sum(), ((z <= 0) & (y[400:] == 1)).sum()
    assert best["f2_ng"] == pytest.approx(5 * tp / (5 * tp + 4 * fn + fp))
    assert best["recall_ng"] == pytest.approx(tp / (tp + fn)) and best["precision_ng"] == pytest.approx(tp / (tp + fp))


def test_dynamic_alpha_rises_while_recall_is_low(spark):
    x, y, w = rows(500, seed=4)
    train, val = frame(spark, x[:300], y[:300], w[:300]), frame(spark, x[300:], y[300:], w[300:])
    fit = LF.fit_loss(train, "focal", val=val, alpha=0.3, dynamic=True, reg=0.01, epochs=12, patience=50)
    low = [e["epoch"] for e in fit.epochs if e["epoch"] >= 7 and e["epoch"] % 2 == 1
           and all(r["recall_ng"] <= 0.9 for r in fit.epochs[e["epoch"] - 5:e["epoch"]])]
    assert low and fit.alpha == pytest.approx(min(0.9, 0.3 + 0.025 * len(low)))


def test_scores_and_stored_model(spark, tmp_dir):
    x, y, w = rows(200)
    df = frame(spark, x, y, w).withColumn("part_number", F.lit("p")).withColumn("subpart_no", F.lit(1.0))
    fit = LF.fit_loss(df, reg=0.1, epochs=20)
    fit.model.save(spark, f"{tmp_dir}/model")
    model = LF.LinearModel.load(spark, f"{tmp_dir}/model")
    assert (model.coefficients == fit.model.coefficients).all() and model.intercept == fit.model.intercept
    got = model.score(df.withColumn("row", F.col("x")), real_label="subpart_label").collect()
    assert len(got) == 200 and set(got[0].asDict()) == {"machine", "part_number", "subpart_no", "real_label", "label", "prob_OK", "prob_NG"}
    expected = np.sort(1 / (1 + np.exp(-(x @ model.coefficients + model.intercept))))
    assert np.abs(np.sort([r["prob_NG"] for r in got]) - expected).max() < 1e-12


def test_refused_rows_empty_table_and_unknown_loss(spark):
    schema = "x array<double>, subpart_label double"
    for bad in ([([1.0], None)], [([1.0], 2.0)], [([1.0], 1.0), ([1.0, 2.0], 0.0)], [([float("nan")], 1.0), ([1.0], 0.0)], [([None], 1.0)]):
        with pytest.raises(Exception, match="label must be|finite features"):
            LF.fit_loss(spark.createDataFrame(bad, schema))
    fit = LF.fit_loss(spark.createDataFrame([], schema))
    assert fit.epochs == [] and fit.model.intercept == 0.0 and fit.run_log(spark).count() == 0
    with pytest.raises(ValueError, match="unknown loss"):
        LF.fit_loss(spark.createDataFrame([([1.0], 1.0)], schema), "hinge")
