"""Standard scaling with a tidy parameter table.

Fit is one aggregate pass (mean and population std per feature, constant -> scale 1).
Parameters live in a table `scaler_id, feature, mean, scale`; applying them reads the
whole (features-sized) table as one scalar subquery, so no join of data is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALER_SCHEMA = "scaler_id STRING, feature STRING, mean DOUBLE, scale DOUBLE"


def fit_scaler(df: DataFrame, features: Sequence[str], scaler_id: str = "default") -> DataFrame:
    """Op 36: per feature mean and population std over all rows; NULLs ignored;
    zero std -> scale 1 (a constant feature is only centred)."""
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        aggs += [F.avg(x).alias(f"m{len(aggs)}"), F.stddev_pop(x).alias(f"s{len(aggs) + 1}")]
    row = df.agg(*aggs)
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f"m{2 * i}").alias("mean"),
                      F.col(f"s{2 * i + 1}").alias("std")) for i, f in enumerate(features)]
    tidy = row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    return tidy.select(F.lit(scaler_id).alias("scaler_id"), "feature", "mean",
                       F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("scale"))


MOMENT_SCHEMA = "scaler_id STRING, feature STRING, n BIGINT, mean DOUBLE, m2 DOUBLE"


def fit_moments(df: DataFrame, features: Sequence[str], scaler_id: str = "default") -> DataFrame:
    """Op 36, mergeable: count, mean and sum of squared deviations per feature, in one pass; NULLs ignored."""
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("n"), F.coalesce(F.col(f"m{i}"), F.lit(0.0)).alias("mean"),
                              F.coalesce(F.col(f"v{i}") * F.col(f"n{i}"), F.lit(0.0)).alias("m2")) for i, f in enumerate(features)])
    return df.agg(*aggs).select(F.explode(rows).alias("p")).select(F.lit(scaler_id).alias("scaler_id"), "p.*")


def merge_moments(moments: DataFrame, scaler_id: str = "default") -> DataFrame:
    """The moments of all rows from those of their parts, by the parallel variance rule: two parts of a and b rows whose
    means are d apart have the sum of their squared deviations plus d * d * a * b / (a + b). The parts of a feature, one
    row per stored batch, are folded in the order of their mean and count, so the result doesn't depend on
    the order of arrival."""
    part = F.struct("mean", "n", "m2")
    start = F.struct(F.lit(0.0).alias("mean"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n, d = a["n"] + b["n"], b["mean"] - a["mean"]
        share = F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
        return F.struct((a["mean"] + d * share).alias("mean"), n.alias("n"), (a["m2"] + b["m2"] + d * d * a["n"] * share).alias("m2"))

    whole = moments.where("n > 0").groupBy("feature").agg(F.aggregate(F.array_sort(F.collect_list(part)), start, add).alias("p"))
    empty = moments.select("feature").distinct()
    out = empty.join(whole, "feature", "left").select("feature", F.coalesce("p", start).alias("p"))
    return out.select(F.lit(scaler_id).alias("scaler_id"), "feature", "p.n", "p.mean", "p.m2")


def scaler_from_moments(moments: DataFrame) -> DataFrame:
    """The parameters that `fit_scaler` gives on the rows behind the moments (features without values: NULL)."""
    std = F.sqrt(F.col("m2") / F.col("n"))
    return moments.select("scaler_id", "feature", F.when(F.col("n") > 0, F.col("mean")).alias("mean"),
                          F.when(F.col("n") > 0, F.when(F.col("m2") == 0, F.lit(1.0)).otherwise(std)).alias("scale"))


def param_map(params: DataFrame, scaler_id: str | None = None) -> Column:
    """All parameters of a fit as one scalar subquery: MAP<feature, STRUCT<mean, scale>>.
    One small job serves every feature reference (identical subqueries are reused)."""
    p = params if scaler_id is None else params.where(F.col("scaler_id") == scaler_id)
    return p.select(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.struct(F.col("mean").cast("double").alias("mean"),
                            F.col("scale").cast("double").alias("scale")))))).scalar()


def apply_scaler(df: DataFrame, params: DataFrame, features: Sequence[str], scaler_id: str | None = None) -> DataFrame:
    """Op 25: (x - mean) / scale for each feature, parameters read by one scalar subquery."""
    m = param_map(params, scaler_id)
    return df.withColumns({f: (F.col(f).cast("double") - m[f]["mean"]) / m[f]["scale"] for f in features})


def inverse_mean(df_nested_avg: Column, params: DataFrame, feature: str, scaler_id: str | None = None) -> Column:
    """Op 26: bround(avg_scaled * scale + mean, 0), half-even."""
    m = param_map(params, scaler_id)
    return F.bround(df_nested_avg * m[feature]["scale"] + m[feature]["mean"], 0)


def save_scaler(params: DataFrame, path: str, mode: str = "append") -> None:
    """Op 37: persist parameters (append keeps history; `scaler_id` names the fit)."""
    params.write.mode(mode).parquet(path)


def load_scaler(spark, path: str, scaler_id: str) -> DataFrame:
    """Op 37: the parameters of one fit."""
    return spark.read.schema(SCALER_SCHEMA).parquet(path).where(F.col("scaler_id") == scaler_id)


def persist_fit(spark, params: DataFrame, path: str, state_path: str, key: str = "last_scaler_id",
                scaler_id: str | None = None) -> str:
    """Op 37: store a fit under a timestamped id (ddmmYYYY_HHMMSS_microseconds) and record the id in
    the state table; later modes load it with `load_scaler(spark, path, id)`."""
    import datetime

    from seqflow.operators.state import set_value

    sid = scaler_id or datetime.datetime.now().strftime("%d%m%Y_%H%M%S_%f")
    save_scaler(params.withColumn("scaler_id", F.lit(sid)), path)
    set_value(spark, state_path, key, sid)
    return sid
