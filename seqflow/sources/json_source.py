"""Raw JSON-payload source: one row per source file (ts, device, payload).

Incremental filter -> outer unnest of the JSON array (VARIANT, lateral explode) ->
key extraction with casts -> lower-case names. Filters on `ts` reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Source keys -> (output column, type).
KEY_MAP = (
    ("PART_NUMBER", "part_number", "string"),
    ("PROCESS_CYCLE_RUNNING_SUBPART_NUMBER", "subpart_no", "double"),
    ("C_AXIS_MACHINE_POSITION(0.01deg)", "machine_position", "double"),
    ("THIRD_PARAM_OUTPUT_MONITOR_VALUE(10W)", "third_param", "double"),
    ("FEEDER_SECOND_PARAM(0.01g/sec)", "second_param", "double"),
    ("FEEDER_INTERNAL_FIRST_PARAM(0.01kPa)", "first_param", "double"),
    ("PROCESS_PART_TEMPERATURE_A", "temp_a", "double"),
    ("PROCESS_PART_TEMPERATURE_B", "temp_b", "double"),
)


def incremental_filter(df: DataFrame, last_ts: int, ts: str = "ts") -> DataFrame:
    """Op 2: rows strictly newer than the stored high watermark (pushed to the scan)."""
    return df.where(F.col(ts) > F.lit(int(last_ts)))


def unnest_json(df: DataFrame, payload: str = "payload", strict: bool = False, keep_key: bool = False) -> DataFrame:
    """Ops 3 + 57: one row per element of the JSON array in `payload` (an object gives
    one row per field), outer: NULL, '[]' and unparsable text keep one row with NULL
    `value`. Adds `pos` (element position, the order key inside a source row) and
    `value` (VARIANT), and with `keep_key` the field name of object elements.
    `strict=True` fails on malformed text instead."""
    spark = df.sparkSession
    parsed = F.parse_json(F.col(payload).outer()) if strict else F.try_parse_json(F.col(payload).outer())
    ex = spark.tvf.variant_explode_outer(parsed)
    out = df.lateralJoin(ex)
    return out if keep_key else out.drop("key")


def extract_measurements(df: DataFrame, value: str = "value", keep=("ts", "device"), strict: bool = False,
                         keep_pos: bool = True) -> DataFrame:
    """Op 4: typed columns from each element; missing key, bad cast or NaN -> NULL
    (`strict=True`: bad cast fails). Bracket paths, since keys contain '(' and '.'."""
    get = F.variant_get if strict else F.try_variant_get
    kept = [*keep, *(["pos"] if keep_pos and "pos" in df.columns else [])]
    rows = df.select(*kept, *[get(F.col(value), '$["' + k + '"]', t).alias(name) for k, name, t in KEY_MAP])
    # a projection of its own, so that a value used twice is looked up once; NaN is a missing value
    return rows.select(*kept, *[F.when(~F.isnan(name), F.col(name)).alias(name) if t == "double" else name for _, name, t in KEY_MAP])


def newest(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The raw rows at the largest `ts`: all that the watermark needs, found before anything is unnested."""
    return df.where(F.col(ts) == df.select(F.max(ts)).scalar())


def lower_columns(df: DataFrame) -> DataFrame:
    """Op 5: every column name lower-cased; names that would become equal are an error."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"names clash in lower case: {sorted({c for c in names if names.count(c) > 1})}")
    return df.toDF(*[c.lower() for c in df.columns])
