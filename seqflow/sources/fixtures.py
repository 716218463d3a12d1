"""Map the driver's tables onto the measurement model.

`lineitem` -> measurement rows (part = supplier, subpart = line number, four signals),
`events` -> one signal per user ordered by time, `labels` -> binary label / prediction.
These are plain projections, so Catalyst prunes the Parquet scan to the used columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The order key that is unique within (part, subpart) on lineitem.
ORDER_KEY = ("l_shipdate", "l_orderkey", "l_partkey", "l_extendedprice")


def epoch_millis(df: DataFrame, column: str):
    """Epoch milliseconds of a timestamp column, independent of the session time zone:
    a TIMESTAMP_NTZ (wall clock as stored) is measured from the NTZ epoch, a TIMESTAMP
    (an instant) with unix_millis."""
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    return F.unix_millis(F.col(column))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Op 1 on the fixture layout: one Parquet file per table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str, raw_subpart: bool = False) -> DataFrame:
    """lineitem -> F3 rows, with file type and raw valve text of the CSV path.

    `raw_subpart=True` stores the subpart as tenths (0.1 .. 0.7), the encoding that
    subpart normalisation undoes.
    """
    li = table(spark, sf_dir, "lineitem")
    sub = F.col("l_linenumber").cast("double")
    m5 = F.col("l_suppkey") % 5
    return li.select(
        F.col("l_suppkey").cast("string").alias("part_number"),
        (sub / 10 if raw_subpart else sub).alias("subpart_no"),
        *[F.col(c) for c in ORDER_KEY if c != "l_extendedprice"],
        F.col("l_quantity").alias("first_param"),
        F.col("l_extendedprice").alias("second_param"),
        F.col("l_discount").alias("third_param"),
        F.col("l_tax").alias("machine_position"),
        F.when(m5.isin(0, 1, 2), F.lit("NG")).otherwise(F.lit("OK")).alias("files_type"),
        F.when(m5 == 0, F.lit("3,4")).when(m5 == 1, F.lit("3")).when(m5 == 2, F.lit("x7")).alias("valve_raw"),
    )


# The order key of a measurement row after the mapping above.
MEASUREMENT_ORDER = ("l_shipdate", "l_orderkey", "l_partkey", "second_param")


def event_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> one signal per user: (user_id, ts, event_id, value)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("user_id", "ts", "event_id", F.col("value").cast("double").alias("value"))


def json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 raw source rows built from lineitem: one row per (supplier, order) 'file'.

    payload = JSON array of that order's lines for the supplier (at most 7 objects, the
    line count of an order, so no group is unbounded); ts = latest ship time in epoch
    ms; device = 'M' || supplier % 10.
    """
    li = table(spark, sf_dir, "lineitem")
    obj = F.struct(
        F.col("l_suppkey").cast("string").alias("PART_NUMBER"),
        F.col("l_linenumber").cast("double").alias("PROCESS_CYCLE_RUNNING_SUBPART_NUMBER"),
        F.col("l_tax").alias("C_AXIS_MACHINE_POSITION(0.01deg)"),
        F.col("l_discount").alias("THIRD_PARAM_OUTPUT_MONITOR_VALUE(10W)"),
        F.col("l_extendedprice").alias("FEEDER_SECOND_PARAM(0.01g/sec)"),
        F.col("l_quantity").alias("FEEDER_INTERNAL_FIRST_PARAM(0.01kPa)"),
        F.col("l_partkey").cast("double").alias("PROCESS_PART_TEMPERATURE_A"),
        F.col("l_orderkey").cast("double").alias("PROCESS_PART_TEMPERATURE_B"),
    )
    ms = epoch_millis(li, "l_shipdate")
    # a group has few rows, so collecting them before the exchange would save nothing
    rows = li.select("l_suppkey", "l_orderkey", "l_linenumber", "l_tax", "l_discount", "l_extendedprice", "l_quantity", "l_partkey", "l_shipdate")
    return (
        rows.repartition("l_suppkey", "l_orderkey").groupBy("l_suppkey", "l_orderkey")
        .agg(
            F.max(ms).alias("ts"),
            F.to_json(F.transform(
                F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("k"), obj.alias("v")))),
                lambda e: e["v"])).alias("payload"),
        )
        .select("ts", F.concat(F.lit("M"), (F.col("l_suppkey") % 10).cast("string")).alias("device"), "payload")
    )


# Header lines of the generated CSV files (Latin-1, one non-ASCII header).
CSV_TITLE = "Messprotokoll Anlage"
CSV_HEADER = "Teil-Nr,C-Achse,Leistung,Förderung,Druck,r1,r2,r3,r4,r5,Temperatur A,Temperatur B"


def write_csv_folders(spark: SparkSession, sf_dir: str, root: str, only: Column | None = None) -> tuple[str, str]:
    """Write lineitem (or the measurements that `only` selects) as positional CSV files, one file per (supplier, line number) and
    task: `<root>/OK/B_<task>_<line>_<supplier>_z.csv` and
    `<root>/NG/A_<task>_<line>_<supplier>_<valves>.csv` (header line + column line).

    Lines are built by Spark; rows are hash-partitioned by file key and sorted, then streamed by `mapInArrow` into
    one open file at a time through `pyarrow.fs` (local, HDFS or object-store URIs); no
    group is buffered, and a task that re-runs rewrites its own files.
    Returns (ok_folder, ng_folder)."""
    m = measurements(spark, sf_dir)
    if only is not None:
        m = m.where(only)
    number = lambda c: F.col(c).cast("double").cast("string")
    # one reserved cell is quoted text with a comma, doubled quotes and a line break
    line = F.concat_ws(",", *map(number, ("subpart_no", "machine_position", "third_param", "second_param", "first_param")),
                       F.lit('"1,5 ""a""\r\nb",,,,'), number("l_partkey"), number("l_orderkey"))
    name = F.when(F.col("files_type") == "NG", F.concat_ws("_", F.col("subpart_no").cast("int"), "part_number", F.concat("valve_raw", F.lit(".csv"))))
    name = F.coalesce(name, F.concat_ws("_", F.col("subpart_no").cast("int"), "part_number", F.lit("z.csv")))
    src = (m.repartition("part_number", "subpart_no")
           .sortWithinPartitions("part_number", "subpart_no", *MEASUREMENT_ORDER)
           .select("files_type", name.alias("name"), line.alias("line")))
    ok_dir, ng_dir = f"{root.rstrip('/')}/OK", f"{root.rstrip('/')}/NG"

    def write(batches):
        from itertools import groupby

        import pyarrow as pa
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        filesystem, ok_path = pafs.FileSystem.from_uri(ok_dir)
        ng_path = pafs.FileSystem.from_uri(ng_dir)[1]
        filesystem.create_dir(ok_path, recursive=True)
        filesystem.create_dir(ng_path, recursive=True)
        pid = TaskContext.get().partitionId()
        current, stream, written = None, None, 0
        for b in batches:
            at, keys = 0, zip(b.column("files_type").to_pylist(), b.column("name").to_pylist())
            for key, rows in groupby(keys):  # a file's lines of the batch are written at once
                n = sum(1 for _ in rows)
                if key != current:
                    if stream is not None:
                        stream.close()
                    folder, kind = (ng_path, "A") if key[0] == "NG" else (ok_path, "B")
                    stream = filesystem.open_output_stream(f"{folder}/{kind}_{pid}_{key[1]}")
                    stream.write((CSV_TITLE + "\r\n" + CSV_HEADER + "\r\n").encode("latin-1"))
                    current, written = key, written + 1
                stream.write(("\r\n".join(b.column("line").slice(at, n).to_pylist()) + "\r\n").encode("latin-1"))
                at += n
        if stream is not None:
            stream.close()
        yield pa.RecordBatch.from_pydict({"files": [written]})

    src.mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()
    return ok_dir, ng_dir
