"""Op 77: streaming prepare + features + score with `foreachBatch`.

The files of a run may fall into several micro-batches, and the length filter, the indices and the windows
need whole runs. Rows therefore wait in a pending table until their run is whole: with `time_col` and `delay`, when
its newest row is older than the newest row seen by more than the delay (a watermark); the others when
`finish_scoring` says that the source is complete. Rows of a run that come after it was scored form a
run of their own, which the length filter drops as any incomplete run.

Each micro-batch writes its own `batch_id=` partition and its own pending table, and reads the one before it, so a
retried batch replaces its output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqflow.operators.features import add_all_features
from seqflow.operators.prepare import PART
from seqflow.operators.state import table_exists
from seqflow.plans.prepare import prepare_job

FINAL = -1  # the partition of the runs that `finish_scoring` scores


def score_batch(batch: DataFrame, order_by: Sequence[str | Column], target_len: int, steps: int,
                scorer: Callable[[DataFrame], DataFrame] | None = None, n_subparts: int = 6) -> DataFrame:
    """The batch logic on whole runs: prepare (score mode) -> features -> score. `steps` is the number stored by the
    training run: the minimum of a part of the stream must not choose it."""
    prepared = prepare_job(batch, order_by=order_by, mode="score", target_len=target_len,
                           n_subparts=n_subparts, steps=steps)
    feats = add_all_features(prepared)
    return scorer(feats) if scorer is not None else feats


def _pending(spark: SparkSession, pending_dir: str, batch_id: int, schema) -> DataFrame:
    path = f"{pending_dir}/after_batch={batch_id}"
    if batch_id >= 0 and table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _newest(spark: SparkSession, pending_dir: str, batch_id: int, kind: str) -> DataFrame:
    path = f"{pending_dir}/newest/after_batch={batch_id}"
    if batch_id >= 0 and table_exists(spark, path):
        return spark.read.schema(f"newest {kind}").parquet(path)
    return spark.createDataFrame([], f"newest {kind}")


def start_scoring(stream: DataFrame, sink_dir: str, checkpoint_dir: str, order_by: Sequence[str | Column],
                  target_len: int, steps: int, scorer: Callable[[DataFrame], DataFrame] | None = None,
                  n_subparts: int = 6, pending_dir: str | None = None, time_col: str | None = None,
                  delay: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Scores runs as they become whole. `delay`: an interval text such as '2 hours', with `time_col`."""
    sink, pending = sink_dir.rstrip("/"), (pending_dir or f"{sink_dir.rstrip('/')}_pending").rstrip("/")
    schema = stream.schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(schema.names).unionByName(_pending(spark, pending, batch_id - 1, schema))
        if time_col is not None and delay is not None:
            kind = schema[time_col].dataType.simpleString()
            seen = rows.select(F.col(time_col).alias("newest")).unionByName(_newest(spark, pending, batch_id - 1, kind))
            path = f"{pending}/newest/after_batch={batch_id}"
            seen.agg(F.max("newest").alias("newest")).write.mode("overwrite").parquet(path)
            limit = spark.read.schema(f"newest {kind}").parquet(path).select(F.col("newest") - F.expr(f"interval {delay}")).scalar()
            last = rows.groupBy(PART).agg(F.max(time_col).alias("__sf_last"))
            whole = last.where(F.col("__sf_last") < limit).select(PART)
            out = score_batch(rows.join(whole, PART, "left_semi").select(schema.names), order_by, target_len, steps, scorer, n_subparts)
            out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
            # a NULL part never is whole, and the length filter would drop it: it isn't kept
            rows = rows.where(F.col(PART).isNotNull()).join(whole, PART, "left_anti").select(schema.names)
        rows.write.mode("overwrite").parquet(f"{pending}/after_batch={batch_id}")

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def finish_scoring(spark: SparkSession, schema, sink_dir: str, order_by: Sequence[str | Column], target_len: int, steps: int,
                   scorer: Callable[[DataFrame], DataFrame] | None = None, n_subparts: int = 6, pending_dir: str | None = None) -> None:
    """The source is complete: scores the runs that still wait, into the partition `FINAL`."""
    sink, pending = sink_dir.rstrip("/"), (pending_dir or f"{sink_dir.rstrip('/')}_pending").rstrip("/")
    if not table_exists(spark, pending):
        return
    names = [f.getPath().getName() for f in _listed(spark, pending)]
    last = max((int(n.partition("=")[2]) for n in names if n.startswith("after_batch=")), default=-1)
    rows = _pending(spark, pending, last, schema)
    score_batch(rows, order_by, target_len, steps, scorer, n_subparts).write.mode("overwrite").parquet(f"{sink}/batch_id={FINAL}")


def _listed(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
