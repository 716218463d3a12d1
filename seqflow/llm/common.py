"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqflow.session import scratch_path

#: a word: a run of characters that are no white space (space, tab to carriage return)
WORD = r"[^\x20\x09-\x0D]+"
BATCH, DEFAULT_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows may hold long texts: unless the session sets a number of its own, Python functions get at most `rows`
    rows at a time (Spark's default of 10,000 takes hundreds of MB in the executor and its Python worker)."""
    if spark.conf.get(BATCH, DEFAULT_BATCH) == DEFAULT_BATCH:
        spark.conf.set(BATCH, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """The rows of `df`, written as Parquet to the shared scratch folder and read back.

    Cuts the lineage: later readers, and tasks rerun after an executor is lost, read the table.
    batch_rows: rows that Python functions in `df` get at a time, for rows that may be long.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(BATCH, None)
    try:
        if batch_rows:
            spark.conf.set(BATCH, str(batch_rows))
        df.write.parquet(path)
    finally:
        if batch_rows:
            spark.conf.set(BATCH, before) if before else spark.conf.unset(BATCH)
    return spark.read.schema(df.schema).parquet(path)


def join_checked(left: DataFrame, small: DataFrame, on: Column | Sequence[str], how: str,
                 max_rows: int = 100_000) -> DataFrame:
    """Join with a side that is small as a rule: broadcast if a count proves at most `max_rows` rows,
    else an ordinary join, whose skew adaptive execution splits. `small` should be a written table."""
    if small.limit(max_rows + 1).count() <= max_rows:
        small = F.broadcast(small)
    return left.join(small, on, how)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; all other characters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def hash_sample(df: DataFrame, keys: Sequence[str], rows: int, total: int, seed: str) -> DataFrame:
    """About `rows` of the `total` rows, and never more: those with the smallest seeded hashes of `keys`. The
    hash also bounds what each task offers, so that the driver merges little more than the sample."""
    h = F.xxhash64(F.lit(seed), *keys)
    share = min(1.0, 1.1 * rows / max(total, 1))
    below = -(1 << 63) + int(share * ((1 << 64) - 1))
    return df.where(h <= F.lit(min(below, (1 << 63) - 1)).cast("long")).orderBy(h, *keys).limit(rows)
