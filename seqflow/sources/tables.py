"""Table scan and write (ops 1, 11)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str | None = None, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Op 1: a lazy table by catalog name or by path; error when neither resolves."""
    if name:
        return spark.table(name)
    if path:
        return spark.read.format(fmt).load(path)
    raise ValueError("a table name or a path is required")


def write_table(df: DataFrame, name: str | None = None, path: str | None = None, mode: str = "overwrite",
                fmt: str = "parquet", partition_by: tuple[str, ...] = (), options: Mapping[str, str] | None = None) -> DataFrame:
    """Op 11: overwrite or append, then return the written table (lazy). An empty frame
    with append adds nothing; with overwrite it leaves a typed empty table (Spark writes
    the schema). `options`: of the writer. No count()."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unsupported write mode {mode!r}")
    w = df.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w.saveAsTable(name)
    elif path:
        w.save(path)
    else:
        raise ValueError("a table name or a path is required")
    return read_table(df.sparkSession, name=name, path=path, fmt=fmt)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """Op 11, laid out for the jobs that follow: a catalog table bucketed on `keys`, sorted inside its files, and read
    back. Joins, aggregates and windows on the keys (or on more columns than these) then need no exchange.

    Rows reach their bucket's writer through a rebalance, so that a bucket is a few files whatever the number of
    input tasks, and adaptive execution splits a bucket with a hot key over several writers. Choose `buckets` so that
    one holds a few hundred MB at most. NULL keys share a bucket; an empty frame leaves an empty table. An existing
    table of that name is replaced.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    w = df.hint("rebalance", buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)
