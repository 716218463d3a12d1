"""Scoring shape and imbalance-aware evaluation as aggregates.

Every metric is one partial aggregate of conditional sums over (label, prediction),
so the work is a single pass whatever the row count; zero divisions give 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.functions.losses import bce_with_logits, focal_loss
from seqflow.functions.scalar import threshold_label


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)).cast("double")


def score_rows(df: DataFrame, prob: str = "prob", threshold: float = 0.5, real_label: str | None = None,
               keep: tuple[str, ...] = ("machine", "part_number", "subpart_no")) -> DataFrame:
    """Ops 27 + 28: label = prob > threshold; prob_NG = p, prob_OK = 1 - p.
    With `real_label` (test mode) it is kept as `real_label`; scoring mode has `label` only."""
    p = F.col(prob).cast("double")
    cols = [F.col(c) for c in keep]
    if real_label is not None:
        cols.append(F.col(real_label).cast("double").alias("real_label"))
    cols += [threshold_label(p, threshold).alias("label"), (1 - p).alias("prob_OK"), p.alias("prob_NG")]
    return df.select(*cols)


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Op 39: counts per (label, prediction)."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes=(0, 1)) -> DataFrame:
    """Op 39, matrix form: one row per true class, one column per predicted class."""
    return df.groupBy(F.col(label).alias("label")).pivot(pred, list(classes)).agg(F.count(F.lit(1))).na.fill(0)


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    # a NULL or third class would otherwise drop out of every count: it is an error
    bad = ~(F.coalesce(y.isin(0.0, 1.0), F.lit(False)) & F.coalesce(p.isin(0.0, 1.0), F.lit(False)))
    refuse = F.raise_error(F.concat(F.lit("label and prediction must be 0 or 1, got: "),
                                    F.coalesce(y.cast("string"), F.lit("NULL")), F.lit(", "),
                                    F.coalesce(p.cast("string"), F.lit("NULL")))).cast("int")
    s = lambda c: F.sum(F.when(bad, refuse).when(c, 1).otherwise(0)).cast("long")
    return df.agg(
        s((y == 1) & (p == 1)).alias("tp"), s((y == 0) & (p == 1)).alias("fp"),
        s((y == 1) & (p == 0)).alias("fn"), s((y == 0) & (p == 0)).alias("tn"),
    )


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Op 40 (a label or prediction that is NULL or neither 0 nor 1 fails the query): rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' with precision,
    recall, f1 and support; the accuracy row carries the accuracy in f1 (as the usual
    text report prints it) and NULL precision / recall."""
    c = _counts(df, label, pred)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_1, f1_0 = _div(2 * p1 * r1, p1 + r1), _div(2 * p0 * r0, p0 + r0)
    s1, s0 = (tp + fn), (tn + fp)
    total = s0 + s1
    acc = _div(tp + tn, total)
    w = lambda a, b: _div(a * s0 + b * s1, total)
    def row(name, p, r, f, n):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"), n.cast("long").alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", none, none, acc, total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, total),
        row("weighted avg", w(p0, p1), w(r0, r1), w(f1_0, f1_1), total),
    )
    return c.select(F.inline(rows))


def fbeta(df: DataFrame, label: str, pred: str, beta: float = 2.0) -> DataFrame:
    """Op 41: F-beta of the positive class, zero division -> 0; with its recall and precision."""
    c = _counts(df, label, pred)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    b2 = F.lit(float(beta) ** 2)
    return c.select(
        _div((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp).alias("fbeta"),
        _div(tp, tp + fn).alias("recall"), _div(tp, tp + fp).alias("precision"))


def loss_columns(df: DataFrame, logit: str, target: str, pos_weight: float = 5.0, gamma: float = 2.0,
                 alpha: float = 0.5) -> DataFrame:
    """Ops 29 + 30 per row: plain and positive-weighted BCE on logits, static and
    label-dependent focal loss."""
    return df.select(
        "*",
        bce_with_logits(logit, target).alias("bce"),
        bce_with_logits(logit, target, pos_weight).alias("bce_weighted"),
        focal_loss(logit, target, gamma, alpha).alias("focal"),
        focal_loss(logit, target, gamma, alpha, dynamic_adjust=True).alias("focal_dynamic"),
    )


def reduce_loss(loss: Column, reduction: str = "mean") -> Column | None:
    """Reduction of a per-row loss: 'mean', 'sum' or 'none' (keep the column)."""
    if reduction == "mean":
        return F.avg(loss)
    if reduction == "sum":
        return F.sum(loss)
    if reduction == "none":
        return loss
    raise ValueError(f"unknown reduction {reduction!r}")


def loss_means(df: DataFrame, loss: str, run: str = "run_id", epoch: str = "epoch") -> DataFrame:
    """Op 42: per (run, epoch) mean of batch losses."""
    return df.groupBy(run, epoch).agg(F.avg(loss).alias("mean_loss"))
