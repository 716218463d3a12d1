"""Op 15: warehouse-style ingest of JSON-payload rows, as one lazy plan.

incremental filter -> outer unnest -> extraction -> watermark (separate one-row frame)
-> drop ts -> lower-case names. An empty increment yields a typed empty frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqflow.operators.state import watermark_advance
from seqflow.sources import json_source as J


def ingest_json(raw: DataFrame, last_ts: int, keep_ts: bool = False) -> DataFrame:
    rows = J.extract_measurements(J.unnest_json(J.incremental_filter(raw, last_ts)))
    if not keep_ts:
        rows = rows.drop("ts")
    return J.lower_columns(rows)


def ingest_json_with_watermark(raw: DataFrame, last_ts: int) -> tuple[DataFrame, DataFrame]:
    """(measurement rows without ts, one-row watermark frame `last_ts, last_part`)."""
    new = J.incremental_filter(raw, last_ts)
    rows = J.extract_measurements(J.unnest_json(new))
    # the outer unnest keeps every ts, so the newest raw rows hold the watermark
    at_top = J.extract_measurements(J.unnest_json(J.newest(new)))
    return J.lower_columns(rows.drop("ts")), watermark_advance(at_top)


# State keys of the incremental ingest.
LAST_TS_KEY = "last_file_timestamp_ms"
LAST_PART_KEY = "last_file_part_number"


def run_ingest(spark, raw: DataFrame, state_path: str, out_path: str, last_ts: int | None = None,
               mode: str = "append") -> int | None:
    """Op 15 as a job: watermark from the state table (or `last_ts`), ingest the newer
    rows, write them, then store the new watermark (one row reaches the driver). An empty
    increment writes nothing and leaves the state as it is. A missing part keeps the
    stored part (D8). Returns the new watermark or None.

    The watermark is read first and bounds the rows that are written, so rows that arrive meanwhile wait
    for the next increment. With `append`, an increment is the partition `after_ts=<old watermark>` of the
    output: a run repeated after a crash overwrites what the first attempt left."""
    from seqflow.operators import state as ST
    from seqflow.sources.tables import write_table

    if last_ts is None:
        last_ts = int(ST.get_value(spark.read.schema(ST.STATE_SCHEMA).parquet(state_path), LAST_TS_KEY))
    _, wm = ingest_json_with_watermark(raw, last_ts)
    top = wm.take(1)
    if not top:
        return None
    rows = ingest_json(raw.where(F.col("ts") <= int(top[0]["last_ts"])), last_ts)
    if mode == "append":
        write_table(rows, path=f"{out_path.rstrip('/')}/after_ts={last_ts}", mode="overwrite")
    else:
        write_table(rows, path=out_path, mode=mode)
    ST.set_value(spark, state_path, LAST_TS_KEY, int(top[0]["last_ts"]))
    if top[0]["last_part"] is not None:
        ST.set_value(spark, state_path, LAST_PART_KEY, top[0]["last_part"])
    return int(top[0]["last_ts"])
