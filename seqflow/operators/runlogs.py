"""Training-run logs: early stopping, best epoch, recall trigger, weight rebalance.

A run log has one row per (run, epoch), epochs numbered from 1; every rule is a window per run ordered by
epoch (runs are small, bounded by the epoch limit) or a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN, EPOCH = "run_id", "epoch"


def early_stop(df: DataFrame, patience: int = 5, loss: str = "val_loss", run: str = RUN,
               epoch: str = EPOCH) -> DataFrame:
    """Op 73: per run, the first epoch whose counter (epochs since the last strict
    improvement of the best loss) reaches `patience`; NULL when it never does."""
    w = Window.partitionBy(run).orderBy(epoch)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.nanvl(F.col(loss).cast("double"), F.lit(float("inf")))
    improved = v < F.coalesce(F.min(v).over(before), F.lit(float("inf")))
    staged = df.select(run, epoch, F.when(improved, F.col(epoch)).alias("__sf_imp"))
    counter = F.col(epoch) - F.coalesce(F.max("__sf_imp").over(upto), F.lit(0))
    staged = staged.select(run, epoch, counter.alias("counter"))
    return staged.groupBy(run).agg(
        F.min(F.when(F.col("counter") >= patience, F.col(epoch))).alias("stop_epoch"),
        F.max(epoch).alias("last_epoch"))


#: metrics of the best epoch, and what they are where no epoch is best
BEST_METRICS = {"f2_ng": -1.0, "recall_ng": 0.0, "precision_ng": 0.0, "f1_ng": 0.0, "recall_ok": 0.0, "precision_ok": 0.0,
                "f1_ok": 0.0, "val_loss": float("inf")}


def best_epoch(df: DataFrame, patience: int = 5, run: str = RUN, epoch: str = EPOCH,
               f2: str = "f2_ng", loss: str = "val_loss",
               precision_cols: tuple[str, str] = ("precision_ng", "precision_ok")) -> DataFrame:
    """Op 72: best epoch per run = max F2, ties -> lower val_loss, then earlier epoch,
    over the epochs the loop reaches: up to the early-stop epoch (inclusive) and before
    the first epoch with a zero precision in either class. Such an epoch ends the run with F2
    reported as 0, but only if the loop reaches it; later ones don't count. NaN losses count as
    +inf. A run without a best epoch has epoch 0 and the initial metrics. Returns the
    metrics of `BEST_METRICS` that the log has; one window per run and one aggregate."""
    v = F.nanvl(F.col(loss).cast("double"), F.lit(float("inf")))
    w = Window.partitionBy(run).orderBy(epoch)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    improved = v < F.coalesce(F.min(v).over(before), F.lit(float("inf")))
    zero = F.coalesce((F.col(precision_cols[0]) == 0) | (F.col(precision_cols[1]) == 0), F.lit(False))
    s = df.select("*", F.when(improved, F.col(epoch)).alias("__sf_imp"), zero.alias("__sf_zero"), v.alias("__sf_v"))
    counter = F.col(epoch) - F.coalesce(F.max("__sf_imp").over(upto), F.lit(0))
    s = s.withColumn("__sf_over", (counter >= patience).cast("int"))
    # an epoch is reached if no earlier one ended the run, by its counter or by a zero precision
    ended = F.coalesce(F.max(F.greatest("__sf_over", F.col("__sf_zero").cast("int"))).over(before), F.lit(0))
    s = s.withColumn("__sf_reached", ended == 0)
    metrics = [c for c in BEST_METRICS if c in df.columns]
    cand = F.col("__sf_reached") & ~F.col("__sf_zero")
    key = F.when(cand, F.struct(F.col(f2).cast("double"), -F.col("__sf_v"), -F.col(epoch).cast("long")))
    best = F.max_by(F.struct(F.col(epoch).alias("best_epoch"), *[F.col(c).cast("double").alias(c) for c in metrics]), key)
    out = s.groupBy(run).agg(best.alias("b"), F.max(F.col("__sf_reached") & F.col("__sf_zero")).alias("zero_stop"),
                             F.max(cand).alias("__sf_any"))
    pick = {c: F.when(F.col("__sf_any"), F.col(f"b.{c}")).otherwise(F.lit(BEST_METRICS[c])) for c in metrics}
    if f2 in pick:
        pick[f2] = F.when(F.col("zero_stop"), F.lit(0.0)).otherwise(pick[f2])
    best_col = F.when(F.col("__sf_any"), F.col("b.best_epoch")).otherwise(F.lit(0)).cast(df.schema[epoch].dataType)
    return out.select(run, best_col.alias("best_epoch"), *[pick[c].alias(c) for c in metrics], "zero_stop")


def recall_trigger(df: DataFrame, recall: str = "recall_ng", run: str = RUN, epoch: str = EPOCH,
                   threshold: float = 0.9, branch: str = "sampler") -> DataFrame:
    """Op 75: at 0-based epochs >= 5 and even, 'raise' when no recent recall exceeds the
    threshold (last 10 epochs for the sampler branch, last 5 for the focal branch),
    'lower' when all of the last 5 do, else NULL."""
    w = Window.partitionBy(run).orderBy(epoch)
    hit = F.when(F.col(recall) > threshold, 1).otherwise(0)
    none_span = 9 if branch == "sampler" else 4
    hits_none = F.sum(hit).over(w.rowsBetween(-none_span, 0))
    hits5 = F.sum(hit).over(w.rowsBetween(-4, 0))
    e0 = F.col(epoch) - 1  # epochs are 1-based in the log; the rule counts from 0
    due = (e0 >= 5) & (e0 % 2 == 0)
    act = F.when(due & (hits_none == 0), F.lit("raise")).when(due & (hits5 == 5), F.lit("lower"))
    return df.select(run, epoch, act.alias("action"))


def rebalance_weights(df: DataFrame, weight: str = "weight", factor: float = 1.1) -> DataFrame:
    """Op 74: weights above the mean weight x factor, others x (2 - factor)."""
    mean_w = df.select(F.avg(weight)).scalar()
    w = F.col(weight)
    return df.withColumn(weight, F.when(w > mean_w, w * factor).otherwise(w * (2 - factor)))
