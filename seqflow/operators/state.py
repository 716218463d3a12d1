"""Pipeline state as an append-only table `key, value (JSON text), version`.

Reads take the latest version per key with `max_by`; writes append a new version only
when the JSON text differs from the latest. The high watermark of incremental ingest
is one such key.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = "key STRING, value STRING, version BIGINT"


def latest_state(state: DataFrame) -> DataFrame:
    """Op 14 (read): one row per key with its latest value."""
    return state.groupBy("key").agg(F.max_by("value", "version").alias("value"), F.max("version").alias("version"))


def get_value(state: DataFrame, key: str):
    """Op 14 (get): the latest value of `key`, decoded from JSON; error if missing.
    A single small row reaches the driver."""
    rows = latest_state(state.where(F.col("key") == key)).select("value").take(1)
    if not rows:
        raise KeyError(f"state key {key!r} is missing")
    return json.loads(rows[0][0])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at `path`, asked of the file system that holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _create_if_absent(spark: SparkSession, path: str) -> bool:
    """Makes an empty file; False if there is one. Only one of several callers can make it."""
    from py4j.protocol import Py4JJavaError
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    try:
        if fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
            local = spark._jvm.java.io.File(p.toUri().getPath()).toPath()
            spark._jvm.java.nio.file.Files.createFile(local, spark.sparkContext._gateway.new_array(spark._jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            fs.create(p, False).close()
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _claimed(spark: SparkSession, folder: str) -> int:
    """The highest version that a writer has claimed; 0 without any."""
    if not table_exists(spark, folder):
        return 0
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def _append(df: DataFrame, path: str) -> None:
    """Appends rows that are written aside first, by moving their files into the table. Appends that Spark writes into one
    folder at a time share its `_temporary`, which the first to end removes under the others."""
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}_rows/{uuid.uuid4().hex}"
    df.write.parquet(aside)
    source, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path))
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to)
    for f in fs.listStatus(source):
        name = f.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(f.getPath(), spark._jvm.org.apache.hadoop.fs.Path(to, name)):
            raise OSError(f"{f.getPath()} could not be moved into {path}")
    fs.delete(source, True)


def set_value(spark: SparkSession, path: str, key: str, value) -> bool:
    """Op 14 (set): append a new version unless the JSON text equals the latest; returns
    whether a row was written.

    Safe with several writers: a version is first claimed by a file that only one of them can create, next to the table,
    and a writer that loses the claim looks again and takes a later one. A writer that dies between claim and append
    leaves a gap in the versions, nothing else."""
    text = json.dumps(value, sort_keys=True)
    claims = f"{path.rstrip('/')}_claims/{hashlib.sha256(key.encode()).hexdigest()}"
    while True:
        cur = []
        if table_exists(spark, path):  # any other failure to read is an error: a new version 1 would be lost
            cur = latest_state(spark.read.schema(STATE_SCHEMA).parquet(path).where(F.col("key") == key)).take(1)
        if cur and cur[0]["value"] == text:
            return False
        version = max(cur[0]["version"] if cur else 0, _claimed(spark, claims)) + 1
        if _create_if_absent(spark, f"{claims}/{version}"):
            break
    _append(spark.createDataFrame([(key, text, version)], STATE_SCHEMA), path)
    return True


def watermark_advance(rows: DataFrame, ts: str = "ts", part: str = "part_number", pos: str = "pos",
                      device: str = "device") -> DataFrame:
    """Op 6: new high watermark = max(ts); last part = the part of the first row at that
    ts (lowest `pos`, then device, then part). One row; empty input gives no row.
    Both are partial aggregates; the max is a scalar subquery. The rows need no more than one ts:
    callers that have the raw rows take the max there, see `raw_watermark`."""
    top = rows.select(F.max(ts)).scalar()
    at_max = rows.where(F.col(ts) == top)
    out = at_max.agg(F.max(ts).alias("last_ts"),
                     F.min_by(F.col(part), F.struct(F.col(pos), F.col(device), F.col(part))).alias("last_part"))
    return out.where(F.col("last_ts").isNotNull())
