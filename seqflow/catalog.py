"""Registered queries: each maps (spark, sf_dir) -> DataFrame over the driver's tables,
paired with DuckDB SQL that computes the same result (see `seqflow.oracle`).

Every query reads whole tables; doubles are rounded to 6 places in the output so the
oracle comparison is insensitive to summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqflow import oracle as O
from seqflow.functions.scalar import subpart_status, valid_valve
from seqflow.operators import features as FE
from seqflow.operators import metrics as ME
from seqflow.operators import prepare as P
from seqflow.operators import runlogs as RL
from seqflow.operators import scaling as SC
from seqflow.operators import sequences as SQ
from seqflow.operators import state as ST
from seqflow.operators import ordering as ORD
from seqflow.operators.ordering import add_row_index
from seqflow.plans import features as PF
from seqflow.plans import ingest as IG
from seqflow.plans import model as MD
from seqflow.plans import sequences as PS
from seqflow.plans.prepare import prepare_job, prepare_job_with_length
from seqflow.sources import csv_folder as CSV
from seqflow.sources import fixtures as FX
from seqflow.sources import json_source as J
from seqflow.sources import tables as TB
from seqflow.streaming import csv_ingest as SC_IN
from seqflow.streaming import ingest as SI
from seqflow.streaming import runs as SR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

R = O.R
# Fixed test parameters for the lineitem mapping: 7 subparts of about 86 steps.
K_SUBPARTS, STEPS = 7, 86


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Round every DOUBLE column to R places (sample std columns: see `oracle.R_STD`)."""
    return df.select(*[F.round(F.col(f.name), O.places(f.name)).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def labelled(spark: SparkSession, sf_dir: str, raw: bool = True) -> DataFrame:
    """Folder-ingest shaped rows: measurements + validated valve + text label."""
    m = FX.measurements(spark, sf_dir, raw_subpart=raw)
    v = valid_valve("valve_raw")
    return m.select(
        "part_number", "subpart_no", "l_shipdate", "l_orderkey", "l_partkey", "first_param", "second_param",
        "third_param", "machine_position", v.alias("ng_valve_no"),
        subpart_status("files_type", v, "subpart_no").alias("subpart_label"))


def prepared_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_job(labelled(spark, sf_dir), order_by=FX.MEASUREMENT_ORDER, mode="train",
                       n_subparts=K_SUBPARTS, steps=STEPS)


def prepared_table(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The prepared layer: the named columns of the prepared train table, written once as
    Parquet (op 11) in the scratch folder, for queries that read it more than once (fit then apply)."""
    import uuid

    from seqflow.session import scratch_path
    from seqflow.sources.tables import write_table
    return write_table(prepared_train(spark, sf_dir).select(*columns), path=scratch_path(spark, f"prepared-{uuid.uuid4().hex}"))


# ---------------------------------------------------------------- flagship

_SUMMARY_SQL_COLS = """part_number,
  count(*) AS n_rows,
  count(DISTINCT subpart_no) AS n_sequences,
  round(sum(subpart_label), 6) AS ng_rows,
  round(max(part_index), 6) AS max_part_index,
  round(avg(first_param_velocity), 6) AS avg_first_velocity,
  round(avg(second_param_acceleration), 6) AS avg_second_acceleration,
  round(avg(third_param_moving_average), 6) AS avg_third_moving_average,
  round(max(first_param_moving_std), 4) AS max_first_moving_std,
  round(sum(second_param_neighbor_diff), 6) AS sum_second_neighbor_diff,
  round(max(first_param_neighbor_diff_cumsum), 6) AS max_first_diff_cumsum,
  round(avg(magnitude), 6) AS avg_magnitude"""


def _summary(df: DataFrame) -> DataFrame:
    return rounded(df.groupBy("part_number").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("subpart_no").alias("n_sequences"),
        F.sum("subpart_label").alias("ng_rows"),
        F.max("part_index").alias("max_part_index"),
        F.avg("first_param_velocity").alias("avg_first_velocity"),
        F.avg("second_param_acceleration").alias("avg_second_acceleration"),
        F.avg("third_param_moving_average").alias("avg_third_moving_average"),
        F.max("first_param_moving_std").alias("max_first_moving_std"),
        F.sum("second_param_neighbor_diff").alias("sum_second_neighbor_diff"),
        F.max("first_param_neighbor_diff_cumsum").alias("max_first_diff_cumsum"),
        F.avg("magnitude").alias("avg_magnitude"),
    ))


@register("prepare_features_summary",
          f"SELECT {_SUMMARY_SQL_COLS} FROM ({O.all_features(O.prepared_train())}) GROUP BY part_number")
def q_prepare_features_summary(spark, sf_dir):
    """Flagship: prepare job (train) -> 19 features -> per-part summary."""
    return _summary(FE.add_all_features(prepared_train(spark, sf_dir)))


def bucketed_source(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """The labelled source as a catalog table, bucketed on the part and sorted by part and subpart."""
    import uuid

    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return TB.write_bucketed(labelled(spark, sf_dir), f"seqflow_source_{uuid.uuid4().hex}", [P.PART], buckets, [P.PART, P.SUBPART])


@register("prepare_bucketed",
          f"SELECT {_SUMMARY_SQL_COLS} FROM ({O.all_features(O.prepared_train())}) GROUP BY part_number")
def q_prepare_bucketed(spark, sf_dir):
    """Ops 11 + 31: the flagship on a source bucketed on the part, where no row is exchanged."""
    prepared = prepare_job(bucketed_source(spark, sf_dir), order_by=FX.MEASUREMENT_ORDER, mode="train",
                           n_subparts=K_SUBPARTS, steps=STEPS, co_located=True)
    return _summary(FE.add_all_features(prepared))


# ---------------------------------------------------------------- preparation ops

@register("normalize_subpart",
          f"SELECT part_number, l_orderkey, l_partkey, round(subpart_no, 6) AS subpart_no "
          f"FROM ({O.normalized(O.measure(True))})")
def q_normalize_subpart(spark, sf_dir):
    m = FX.measurements(spark, sf_dir, raw_subpart=True)
    return rounded(P.normalize_subparts(m).select("part_number", "l_orderkey", "l_partkey", "subpart_no"))


@register("normalize_subpart_zero",
          "SELECT part_number, l_orderkey, l_partkey, round(subpart_no, 6) AS subpart_no FROM ("
          + O.normalized("SELECT * REPLACE (CASE WHEN subpart_no > 0.65 THEN 0.0 ELSE subpart_no END AS subpart_no) "
                         f"FROM ({O.measure(True)})") + ")")
def q_normalize_subpart_zero(spark, sf_dir):
    """Line number 7 stands for subpart 0, whose rows go (op 18)."""
    m = FX.measurements(spark, sf_dir, raw_subpart=True)
    m = m.withColumn("subpart_no", F.when(F.col("subpart_no") > 0.65, 0.0).otherwise(F.col("subpart_no")))
    return rounded(P.normalize_subparts(m).select("part_number", "l_orderkey", "l_partkey", "subpart_no"))


@register("valve_label",
          f"SELECT part_number, subpart_no, ng_valve_no, subpart_label, count(*) AS n_rows "
          f"FROM ({O.labelled(False)}) GROUP BY ALL")
def q_valve_label(spark, sf_dir):
    return (labelled(spark, sf_dir, raw=False)
            .groupBy("part_number", "subpart_no", "ng_valve_no", "subpart_label")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("label_binary",
          "SELECT CASE subpart_label WHEN 'NG' THEN 1.0 WHEN 'OK' THEN 0.0 END::DOUBLE AS subpart_label, "
          f"count(*) AS n_rows FROM ({O.labelled(False)}) "
          "WHERE subpart_label IS DISTINCT FROM 'OK_within_NG' GROUP BY 1")
def q_label_binary(spark, sf_dir):
    df = P.labels_to_binary(P.exclude_ambiguous(labelled(spark, sf_dir, raw=False)))
    return df.groupBy("subpart_label").agg(F.count(F.lit(1)).alias("n_rows"))


@register("length_filter",
          f"SELECT part_number, count(*) AS n_rows FROM ({O.length_filtered(O.measure())}) GROUP BY part_number")
def q_length_filter(spark, sf_dir):
    df = P.filter_by_length(FX.measurements(spark, sf_dir), n_subparts=K_SUBPARTS, steps=STEPS)
    return df.groupBy("part_number").agg(F.count(F.lit(1)).alias("n_rows"))


@register("subpart_index",
          f"SELECT part_number, subpart_no, l_orderkey, l_partkey, subpart_index FROM ({O.indexed(O.measure())})")
def q_subpart_index(spark, sf_dir):
    df = P.add_subpart_index(FX.measurements(spark, sf_dir), FX.MEASUREMENT_ORDER, skew_safe=True)
    return df.select("part_number", "subpart_no", "l_orderkey", "l_partkey", "subpart_index")


_T_SQL = f"SELECT CAST(coalesce(max(subpart_index), 0) AS INTEGER) FROM ({O.indexed(O.measure())})"


@register("pad_last",
          f"SELECT part_number, subpart_no, subpart_index, l_orderkey, round(first_param, 6) AS first_param "
          f"FROM ({O.padded_clean(O.indexed(O.measure()), _T_SQL)})")
def q_pad_last(spark, sf_dir):
    df = P.add_subpart_index(FX.measurements(spark, sf_dir), FX.MEASUREMENT_ORDER, skew_safe=True)
    out = P.pad_to_length(df, P.max_sequence_length(FX.measurements(spark, sf_dir)), skew_safe=True)
    return rounded(out.select("part_number", "subpart_no", "subpart_index", "l_orderkey", "first_param"))


@register("align_ffill",
          "WITH s AS (" + O.indexed(O.measure()) + "), "
          "g AS (SELECT DISTINCT part_number, subpart_no FROM s), "
          "grid AS (SELECT part_number, subpart_no, CAST(i AS DOUBLE) AS subpart_index FROM g, "
          f"range(1, ({_T_SQL}) + 1) t(i)), "
          "j AS (SELECT grid.*, s.first_param, s.machine_position FROM grid LEFT JOIN s USING "
          "(part_number, subpart_no, subpart_index)) "
          "SELECT part_number, subpart_no, subpart_index, "
          "round(coalesce(last_value(first_param IGNORE NULLS) OVER w, 0), 6) AS first_param, "
          "round(coalesce(last_value(machine_position IGNORE NULLS) OVER w, 0), 6) AS machine_position "
          "FROM j WINDOW w AS (PARTITION BY part_number, subpart_no ORDER BY subpart_index "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def q_align_ffill(spark, sf_dir):
    df = P.add_subpart_index(FX.measurements(spark, sf_dir), FX.MEASUREMENT_ORDER, skew_safe=True)
    out = P.align_to_grid(df, P.max_sequence_length(df), ["first_param", "machine_position"], skew_safe=True)
    return rounded(out)


@register("part_index",
          f"SELECT part_number, subpart_no, subpart_index, part_index FROM "
          f"({O.part_indexed(O.padded_clean(O.indexed(O.measure()), _T_SQL))})")
def q_part_index(spark, sf_dir):
    df = P.add_subpart_index(FX.measurements(spark, sf_dir), FX.MEASUREMENT_ORDER, skew_safe=True)
    padded = P.pad_to_length(df, P.max_sequence_length(FX.measurements(spark, sf_dir)), skew_safe=True)
    out = P.add_part_index(padded, skew_safe=True)
    return out.select("part_number", "subpart_no", "subpart_index", "part_index")


# ---------------------------------------------------------------- signal features

def _feature_query(feature: str, abs_cumsum=()):
    cols = [f"{s}_{feature}" for s in O.SIGNALS]
    sql = (f"SELECT part_number, subpart_no, l_orderkey, l_partkey, "
           + ", ".join(O.rnd(c, c) for c in cols)
           + f" FROM ({O.signal_features(O.measure(), order=O.ORDER, abs_cumsum=abs_cumsum)})")

    def q(spark, sf_dir):
        # raw rows may hold hot sequences: the blocked operator, whose windows never hold a whole one
        df = FE.add_signal_features_skew_safe(FX.measurements(spark, sf_dir), order=FX.MEASUREMENT_ORDER,
                                              abs_cumsum=abs_cumsum)
        return rounded(df.select("part_number", "subpart_no", "l_orderkey", "l_partkey", *cols))
    return q, sql


for _name, _feat, _abs in [
    ("gradient", "velocity", ()),
    ("acceleration", "acceleration", ()),
    ("moving_avg", "moving_average", ()),
    ("moving_std", "moving_std", ()),
    ("neighbor_diff", "neighbor_diff", ()),
    ("diff_cumsum", "neighbor_diff_cumsum", ()),
    ("abs_diff_cumsum", "neighbor_diff_cumsum", O.SIGNALS),
]:
    _q, _sql = _feature_query(_feat, _abs)
    register(_name, _sql)(_q)


@register("magnitude",
          "SELECT part_number, l_orderkey, l_partkey, round(sqrt(third_param * third_param + second_param * "
          f"second_param + first_param * first_param), 6) AS magnitude FROM ({O.measure()})")
def q_magnitude(spark, sf_dir):
    df = FE.add_magnitude(FX.measurements(spark, sf_dir))
    return rounded(df.select("part_number", "l_orderkey", "l_partkey", "magnitude"))


_EVENT_SRC = "SELECT user_id, ts, event_id, value FROM events"


@register("event_features",
          "SELECT user_id, event_id, " + ", ".join(
              O.rnd(f"value_{f}", f"value_{f}") for f in FE.FEATURES)
          + f" FROM ({O.signal_features(_EVENT_SRC, ('value',), 'user_id', 'ts, event_id')})")
def q_event_features(spark, sf_dir):
    """Single-signal features on events: user = sequence, time = order."""
    df = FE.add_signal_features(FX.event_signal(spark, sf_dir), signals=("value",), keys=("user_id",),
                                order=("ts", "event_id"))
    return rounded(df.select("user_id", "event_id", *[f"value_{f}" for f in FE.FEATURES]))


@register("relative",
          "SELECT part_number, l_orderkey, l_partkey, " + ", ".join(
              f"round({s} / (median(CASE WHEN subpart_index BETWEEN 75 AND 125 THEN {s} END) "
              f"OVER (PARTITION BY part_number) + 1e-9), 6) AS relative_{s}" for s in O.SIGNALS)
          + f" FROM ({O.indexed(O.measure())})")
def q_relative(spark, sf_dir):
    df = P.add_subpart_index(FX.measurements(spark, sf_dir), FX.MEASUREMENT_ORDER, skew_safe=True)
    df = FE.add_relative_features(df, 75, 125, skew_safe=True)
    return rounded(df.select("part_number", "l_orderkey", "l_partkey", *[f"relative_{s}" for s in O.SIGNALS]))


_FEATURE_COLS = [f"{s}_{f}" for s in FE.SIGNALS for f in FE.FEATURES] + ["magnitude"]


@register("feature_set",
          "SELECT part_number, subpart_no, subpart_index, part_index, subpart_label, "
          + ", ".join(O.rnd(c, c) for c in _FEATURE_COLS)
          + f" FROM ({O.all_features(O.prepared_train())})")
def q_feature_set(spark, sf_dir):
    """The 19 engineered columns on the prepared train table, row level."""
    df = FE.add_all_features(prepared_train(spark, sf_dir))
    return rounded(df.select("part_number", "subpart_no", "subpart_index", "part_index", "subpart_label",
                             *_FEATURE_COLS))


# ---------------------------------------------------------------- whole preparation job

@register("prepare_job",
          "SELECT part_number, subpart_no, subpart_index, part_index, subpart_label, "
          f"round(first_param, 6) AS first_param, ng_valve_no FROM ({O.prepared_train()})")
def q_prepare_job(spark, sf_dir):
    df = prepared_train(spark, sf_dir)
    return rounded(df.select("part_number", "subpart_no", "subpart_index", "part_index", "subpart_label",
                             "first_param", "ng_valve_no"))


@register("column_max",
          f"SELECT CAST(coalesce(max(subpart_index), 0) AS INTEGER) AS max_len FROM ({O.indexed(O.measure())})")
def q_column_max(spark, sf_dir):
    df = P.add_subpart_index(FX.measurements(spark, sf_dir), FX.MEASUREMENT_ORDER)
    return spark.range(1).select(P.column_max(df, "subpart_index").alias("max_len"))


@register("distinct_groups", f"SELECT DISTINCT part_number, subpart_no, subpart_label FROM ({O.labelled(False)})")
def q_distinct_groups(spark, sf_dir):
    return P.distinct_groups(labelled(spark, sf_dir, raw=False), ["part_number", "subpart_no", "subpart_label"])


@register("count_sequences",
          f"SELECT count(*) AS n_sequences FROM (SELECT DISTINCT part_number, subpart_no FROM ({O.measure()}))")
def q_count_sequences(spark, sf_dir):
    return FE.count_sequences(FX.measurements(spark, sf_dir))


@register("union_sources",
          "SELECT source_rank, files_type, (valve_raw IS NULL) AS no_valve, count(*) AS n_rows FROM ("
          f"SELECT 0 AS source_rank, * EXCLUDE (valve_raw), NULL AS valve_raw FROM ({O.measure()}) WHERE files_type = 'OK' "
          f"UNION ALL SELECT 1 AS source_rank, * FROM ({O.measure()}) WHERE files_type = 'NG') GROUP BY ALL")
def q_union_sources(spark, sf_dir):
    m = FX.measurements(spark, sf_dir)
    ok = m.where(F.col("files_type") == "OK").drop("valve_raw")
    ng = m.where(F.col("files_type") == "NG")
    u = P.union_sources(ok, ng)
    return u.groupBy("source_rank", "files_type", F.col("valve_raw").isNull().alias("no_valve")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("row_index",
          "SELECT part_number, l_orderkey, l_partkey, row_number() OVER (ORDER BY part_number, subpart_no, "
          f"l_shipdate, l_orderkey, l_partkey, second_param) - 1 AS row_index FROM ({O.measure()})")
def q_row_index(spark, sf_dir):
    order = ["part_number", "subpart_no", *FX.MEASUREMENT_ORDER]
    df = add_row_index(FX.measurements(spark, sf_dir).select(*order), order)
    return df.select("part_number", "l_orderkey", "l_partkey", "row_index")


def _scratch(spark, name: str) -> str:
    import uuid

    from seqflow.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("ordered_write_read",
          "SELECT part_number, l_orderkey, row_number() OVER (ORDER BY part_number, subpart_no, l_shipdate, l_orderkey, "
          f"l_partkey, second_param) - 1 AS row_index FROM ({O.measure()})")
def q_ordered_write_read(spark, sf_dir):
    """Ops 13 + 60: the row order is written, read back and kept by a sort on the index."""
    path = _scratch(spark, "ordered")
    order = ["part_number", "subpart_no", *FX.MEASUREMENT_ORDER]
    df = add_row_index(FX.measurements(spark, sf_dir).select(*order), order)
    ORD.write_ordered(df.select("part_number", "l_orderkey", "row_index"), path)
    return ORD.sort_by_row_index(ORD.read_ordered(spark, path))


@register("table_write",
          "SELECT files_type, count(*) AS n_rows, round(sum(first_param), 6) AS sum_first FROM ("
          f"SELECT * FROM ({O.measure()}) UNION ALL SELECT * FROM ({O.measure()}) WHERE files_type = 'NG') GROUP BY 1")
def q_table_write(spark, sf_dir):
    """Ops 1 + 11: overwrite, append the NG rows once more, read the table."""
    path = _scratch(spark, "table")
    m = FX.measurements(spark, sf_dir).select("files_type", "first_param")
    TB.write_table(m, path=path)
    TB.write_table(m.where("files_type = 'NG'"), path=path, mode="append")
    df = TB.read_table(spark, path=path)
    return rounded(df.groupBy("files_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("first_param").alias("sum_first")))


@register("lower_names", f"SELECT part_number, subpart_no, round(first_param, 6) AS first_param FROM ({O.measure()})")
def q_lower_names(spark, sf_dir):
    m = FX.measurements(spark, sf_dir)
    return rounded(J.lower_columns(m.select(F.col("part_number").alias("PART_Number"), F.col("subpart_no").alias("SubPart_No"),
                                            F.col("first_param").alias("FIRST_PARAM"))))


@register("feature_job",
          "SELECT part_number, subpart_no, subpart_index, " + ", ".join(O.rnd(c, c) for c in _FEATURE_COLS)
          + f", NULL::DOUBLE AS temp_a FROM ({O.all_features(O.prepared_train())})")
def q_feature_job(spark, sf_dir):
    """Op 54: the job on the prepared table, projected on the configured schema."""
    out = PF.feature_job(prepared_train(spark, sf_dir), ["temp_a"])
    return rounded(out.select("part_number", "subpart_no", "subpart_index", *_FEATURE_COLS, "temp_a"))


@register("conform_schema",
          "SELECT part_number, subpart_no, round(first_param, 6) AS first_param, NULL::DOUBLE AS row_index, "
          "NULL::VARCHAR AS ng_valve_no, NULL::DOUBLE AS temp_a, NULL::DOUBLE AS first_param_velocity "
          f"FROM ({O.measure()})")
def q_conform_schema(spark, sf_dir):
    m = FX.measurements(spark, sf_dir).select("part_number", "subpart_no", "first_param")
    schema = FE.feature_schema(m, ["row_index", "ng_valve_no", "temp_a", "first_param_velocity", "first_param"])
    return rounded(FE.conform_to_schema(m, schema))


# ---------------------------------------------------------------- sequences and splits


_PREP = O.prepared_train()
_T_PREP = f"SELECT max(subpart_index) FROM ({_PREP})"
_SEQ_FEATURES = ["first_param", "second_param", "third_param"]


def _chunked(spark, sf_dir):
    # T = the padding length of the prepare job (every prepared sequence has T rows)
    df, t = prepare_job_with_length(labelled(spark, sf_dir), order_by=FX.MEASUREMENT_ORDER, mode="train",
                                    n_subparts=K_SUBPARTS, steps=STEPS)
    return SQ.chunk_rows(df, t, by=("part_number",))  # the part as one stream (source-compatible)


@register("chunk_sequences",
          "SELECT part_number, chunk, count(*) AS n_steps, max(subpart_label) AS subpart_label, max(group_id) AS "
          f"group_id, round(sum(first_param), 6) AS sum_first FROM ({O.chunked(_PREP, _T_PREP)}) GROUP BY 1, 2")
def q_chunk_sequences(spark, sf_dir):
    nested = SQ.nest_sequences(_chunked(spark, sf_dir), _SEQ_FEATURES, by=("part_number",))
    return rounded(nested.select(
        "part_number", "chunk", F.size("features").cast("long").alias("n_steps"), "subpart_label", "group_id",
        F.aggregate("features", F.lit(0.0), lambda acc, v: acc + v[0]).alias("sum_first")))


@register("chunk_sequences_by_subpart",
          "SELECT part_number, subpart_no, chunk, count(*) AS n_steps, max(subpart_label) AS subpart_label, max(group_id) AS "
          f"group_id, round(sum(first_param), 6) AS sum_first FROM ({O.chunked(_PREP, '50', 'part_number, subpart_no')}) GROUP BY 1, 2, 3")
def q_chunk_sequences_by_subpart(spark, sf_dir):
    """The default: each (part, subpart) sequence cut on its own, here every 50 steps."""
    nested = SQ.nest_sequences(SQ.chunk_rows(prepared_train(spark, sf_dir), 50), _SEQ_FEATURES)
    return rounded(nested.select(
        "part_number", "subpart_no", "chunk", F.size("features").cast("long").alias("n_steps"), "subpart_label", "group_id",
        F.aggregate("features", F.lit(0.0), lambda acc, v: acc + v[0]).alias("sum_first")))


@register("unnest_sequences",
          "SELECT part_number, chunk, step, subpart_label, group_id, " + ", ".join(O.rnd(f, f) for f in _SEQ_FEATURES)
          + f" FROM ({O.chunked(_PREP, _T_PREP)})")
def q_unnest_sequences(spark, sf_dir):
    nested = SQ.nest_sequences(_chunked(spark, sf_dir), _SEQ_FEATURES, by=("part_number",))
    return rounded(SQ.unnest_sequences(nested, _SEQ_FEATURES))


# 75 % train, then 0.1 of the remaining 0.1 + 0.15 val, the rest test
_P_TRAIN, _P_VAL = 0.75, 0.1 / (0.1 + (1.0 - 0.75 - 0.1))


@register("split_groups", O.split(_PREP, _P_TRAIN, _P_VAL))
def q_split_groups(spark, sf_dir):
    return SQ.split_groups(prepared_train(spark, sf_dir))


def _prepared_groups(spark, sf_dir):
    """(part_number, subpart_no, subpart_label): all that weights and draws need of the prepared table."""
    return prepared_train(spark, sf_dir).groupBy("part_number", "subpart_no").agg(
        F.max("subpart_label").alias("subpart_label"))


@register("class_weights",
          "SELECT part_number, subpart_no, round(1.0 / count(*) OVER (PARTITION BY subpart_label), 6) AS weight "
          f"FROM ({O.groups_of(_PREP)})")
def q_class_weights(spark, sf_dir):
    g = _prepared_groups(spark, sf_dir)
    return rounded(SQ.class_weights(g).select("part_number", "subpart_no", "weight"))


@register("rebalance_weights",
          "WITH w AS (SELECT part_number, subpart_no, 1.0 / count(*) OVER (PARTITION BY subpart_label) AS weight "
          f"FROM ({O.groups_of(_PREP)})) SELECT part_number, subpart_no, round(CASE WHEN weight > (SELECT avg(weight) "
          "FROM w) THEN weight * 1.1 ELSE weight * (2 - 1.1) END, 6) AS weight FROM w")
def q_rebalance_weights(spark, sf_dir):
    g = _prepared_groups(spark, sf_dir)
    w = SQ.class_weights(g).select("part_number", "subpart_no", "weight")
    return rounded(RL.rebalance_weights(w, "weight", 1.1))


@register("resample",
          "SELECT part_number, subpart_no, subpart_label, CAST(copy AS BIGINT) AS copy FROM ("
          "SELECT *, unnest(generate_series(1, copies)) AS copy FROM ("
          "SELECT *, CAST(floor(e) + CASE WHEN u < e - floor(e) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM ("
          f"SELECT *, {O.uniform()} AS u, (1.0 / count(*) OVER (PARTITION BY subpart_label)) * "
          "(count(*) OVER ()) / (SELECT count(DISTINCT coalesce(CAST(subpart_label AS VARCHAR), '<null>')) FROM "
          f"({O.groups_of(_PREP)})) AS e FROM ({O.groups_of(_PREP)}))) WHERE copies > 0)")
def q_resample(spark, sf_dir):
    g = _prepared_groups(spark, sf_dir)
    out = SQ.resample_balanced(g, ["part_number", "subpart_no"], seed=42)
    return out.select("part_number", "subpart_no", "subpart_label", F.col("copy").cast("long").alias("copy"))


_DRAWS = 1001


@register("resample_exact", f"""WITH g AS ({O.groups_of(_PREP)}), w AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY subpart_label) AS w FROM g),
u AS (SELECT *, CAST(floor(w / (SELECT max(w) FROM w) * {1 << 44}.0::DOUBLE) AS HUGEINT) AS u FROM w),
c AS (SELECT *, CAST(sum(u) OVER (ORDER BY subpart_label NULLS FIRST, {O.md5_key()}, part_number, subpart_no) AS HUGEINT) AS c, CAST(sum(u) OVER () AS HUGEINT) AS t FROM u)
SELECT part_number, subpart_no, subpart_label, CAST(copies AS BIGINT) AS copies FROM (
  SELECT *, (2 * {_DRAWS} * c + t) // (2 * t) - (2 * {_DRAWS} * (c - u) + t) // (2 * t) AS copies FROM c) WHERE copies > 0""")
def q_resample_exact(spark, sf_dir):
    """Exactly 1,001 class-balanced draws with replacement: how often each group is drawn."""
    out = SQ.resample_exact(_prepared_groups(spark, sf_dir), ["part_number", "subpart_no"], _DRAWS)
    return out.groupBy("part_number", "subpart_no", "subpart_label").agg(F.count(F.lit(1)).alias("copies"))


# ---------------------------------------------------------------- scaling

def _scaler_sql(src: str, feats) -> str:
    return " UNION ALL ".join(
        f"SELECT 'train' AS scaler_id, '{f}' AS feature, avg({f}) AS mean, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 "
        f"ELSE stddev_pop({f}) END AS scale FROM ({src})" for f in feats)


_SCALE_FEATS = ["subpart_no", "first_param", "second_param", "third_param"]


@register("scaler_fit",
          f"SELECT scaler_id, feature, round(mean, 6) AS mean, round(scale, 6) AS scale FROM "
          f"({_scaler_sql(_PREP, _SCALE_FEATS)})")
def q_scaler_fit(spark, sf_dir):
    return rounded(SC.fit_scaler(prepared_train(spark, sf_dir), _SCALE_FEATS, "train"))


@register("scaler_merge", ORACLE["scaler_fit"])
def q_scaler_merge(spark, sf_dir):
    """The moments of three batches, stored one after the other, merged into the scaler of all rows."""
    path, rows = _scratch(spark, "moments"), prepared_train(spark, sf_dir)
    batch = F.pmod(F.xxhash64("part_number"), F.lit(3))
    for k in range(3):
        SC.fit_moments(rows.where(batch == k), _SCALE_FEATS).write.mode("append").parquet(path)
    stored = spark.read.schema(SC.MOMENT_SCHEMA).parquet(path)
    return rounded(SC.scaler_from_moments(SC.merge_moments(stored, "train")))


@register("scaler_persist",
          f"SELECT feature, round(mean, 6) AS mean, round(scale, 6) AS scale FROM ({_scaler_sql(_PREP, _SCALE_FEATS)})")
def q_scaler_persist(spark, sf_dir):
    """Op 37: two fits are stored; the id in the state table loads the second."""
    table, state = _scratch(spark, "scaler"), _scratch(spark, "state")
    SC.persist_fit(spark, SC.fit_scaler(FX.measurements(spark, sf_dir), ["first_param"]), table, state)
    SC.persist_fit(spark, SC.fit_scaler(prepared_train(spark, sf_dir), _SCALE_FEATS), table, state)
    sid = ST.get_value(spark.read.schema(ST.STATE_SCHEMA).parquet(state), "last_scaler_id")
    return rounded(SC.load_scaler(spark, table, sid).select("feature", "mean", "scale"))


def _scaled_sql() -> str:
    stats = ", ".join(f"avg({f}) AS {f}_m, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS {f}_s"
                      for f in _SCALE_FEATS)
    return (f"SELECT p.* REPLACE (" + ", ".join(f"(p.{f} - s.{f}_m) / s.{f}_s AS {f}" for f in _SCALE_FEATS)
            + f") FROM ({_PREP}) p CROSS JOIN (SELECT {stats} FROM ({_PREP})) s")


@register("scaler_apply",
          "SELECT part_number, subpart_index, " + ", ".join(O.rnd(f, f) for f in _SCALE_FEATS)
          + f" FROM ({_scaled_sql()})")
def q_scaler_apply(spark, sf_dir):
    df = prepared_table(spark, sf_dir, "part_number", "subpart_index", *_SCALE_FEATS)
    params = SC.fit_scaler(df, _SCALE_FEATS, "train")
    out = SC.apply_scaler(df.withColumn("__raw_subpart", F.col("subpart_no")), params, _SCALE_FEATS)
    return rounded(out.select("part_number", "subpart_index", *_SCALE_FEATS))


@register("scaler_inverse",
          f"WITH p AS ({_PREP}), s AS (SELECT avg(subpart_no) AS m, CASE WHEN stddev_pop(subpart_no) = 0 THEN 1.0 "
          "ELSE stddev_pop(subpart_no) END AS sd FROM p) SELECT part_number, p.subpart_no AS subpart_no, "
          "round_even(avg((p.subpart_no - s.m) / s.sd) * s.sd + s.m, 0) AS subpart_no_inv "
          "FROM p CROSS JOIN s GROUP BY part_number, p.subpart_no, s.m, s.sd")
def q_scaler_inverse(spark, sf_dir):
    df = prepared_table(spark, sf_dir, "part_number", "subpart_no").withColumn("raw_subpart", F.col("subpart_no"))
    params = SC.fit_scaler(df, ["subpart_no"], "train")
    scaled = SC.apply_scaler(df, params, ["subpart_no"])
    per_seq = scaled.groupBy("part_number", "raw_subpart").agg(F.avg("subpart_no").alias("m"))
    return per_seq.select("part_number", F.col("raw_subpart").alias("subpart_no"),
                          SC.inverse_mean(F.col("m"), params, "subpart_no").alias("subpart_no_inv"))


# ---------------------------------------------------------------- scores, metrics, losses

def _labels(spark, sf_dir):
    return FX.table(spark, sf_dir, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


@register("confusion", "SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL")
def q_confusion(spark, sf_dir):
    return ME.confusion(_labels(spark, sf_dir), "label", "prediction")


_CNT = ("SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality = 0 AND "
        "toxic = 1) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn, count(*) FILTER (WHERE "
        "quality = 0 AND toxic = 0) AS tn FROM labels")


def _d(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(({b}), 0), 0.0)"


_REPORT = f"""WITH c AS ({_CNT}), m AS (SELECT *, {_d('tp', 'tp + fp')} AS p1, {_d('tp', 'tp + fn')} AS r1,
  {_d('tn', 'tn + fn')} AS p0, {_d('tn', 'tn + fp')} AS r0, tp + fn AS s1, tn + fp AS s0 FROM c),
f AS (SELECT *, {_d('2 * p1 * r1', 'p1 + r1')} AS f1, {_d('2 * p0 * r0', 'p0 + r0')} AS f0, s0 + s1 AS tot FROM m)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round({_d('tp + tn', 'tot')}, 6), tot FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), tot FROM f
UNION ALL SELECT 'weighted avg', round({_d('p0 * s0 + p1 * s1', 'tot')}, 6), round({_d('r0 * s0 + r1 * s1', 'tot')}, 6),
  round({_d('f0 * s0 + f1 * s1', 'tot')}, 6), tot FROM f"""


@register("class_report", _REPORT)
def q_class_report(spark, sf_dir):
    return rounded(ME.classification_report(_labels(spark, sf_dir), "label", "prediction"))


@register("fbeta",
          f"WITH c AS ({_CNT}) SELECT round({_d('5.0 * tp', '5.0 * tp + 4.0 * fn + fp')}, 6) AS fbeta, "
          f"round({_d('tp', 'tp + fn')}, 6) AS recall, round({_d('tp', 'tp + fp')}, 6) AS precision FROM c")
def q_fbeta(spark, sf_dir):
    return rounded(ME.fbeta(_labels(spark, sf_dir), "label", "prediction", 2.0))


def _scored(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events")
    v = F.col("value").cast("double")
    return ev.select(
        F.col("event_type").alias("machine"), F.col("user_id").cast("string").alias("part_number"),
        (F.col("event_id") % 7 + 1).cast("double").alias("subpart_no"), (v / (1 + v)).alias("prob"),
        # logit of p = v / (1 + v), undefined (NULL) at v = 0
        F.when(v > 0, F.log(v)).alias("logit"),
        F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("real_label"),
        "user_id", "ts", "event_id")


@register("score_shape",
          "SELECT machine, part_number, subpart_no, real_label, CAST(prob > 0.5 AS INTEGER) AS label, "
          f"round(1 - prob, 6) AS prob_OK, round(prob, 6) AS prob_NG FROM ({O.scored_events()})")
def q_score_shape(spark, sf_dir):
    return rounded(ME.score_rows(_scored(spark, sf_dir), "prob", 0.5, real_label="real_label"))


@register("bce_loss",
          f"SELECT user_id, round(avg({O.bce('logit', 'real_label')}), 6) AS bce, "
          f"round(avg({O.bce('logit', 'real_label', 5.0)}), 6) AS bce_weighted FROM ({O.scored_events()}) GROUP BY 1")
def q_bce_loss(spark, sf_dir):
    df = ME.loss_columns(_scored(spark, sf_dir), "logit", "real_label", pos_weight=5.0)
    return rounded(df.groupBy("user_id").agg(ME.reduce_loss(F.col("bce")).alias("bce"),
                                             ME.reduce_loss(F.col("bce_weighted")).alias("bce_weighted")))


@register("focal_loss",
          f"SELECT user_id, round(avg({O.focal('logit', 'real_label')}), 6) AS focal, "
          f"round(sum({O.focal('logit', 'real_label', dynamic=True)}), 6) AS focal_dynamic_sum "
          f"FROM ({O.scored_events()}) GROUP BY 1")
def q_focal_loss(spark, sf_dir):
    df = ME.loss_columns(_scored(spark, sf_dir), "logit", "real_label")
    return rounded(df.groupBy("user_id").agg(ME.reduce_loss(F.col("focal"), "mean").alias("focal"),
                                             ME.reduce_loss(F.col("focal_dynamic"), "sum").alias("focal_dynamic_sum")))


@register("loss_means",
          f"SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(dayofmonth(ts) AS INTEGER) AS epoch, "
          f"round(avg({O.bce('logit', 'real_label')}), 6) AS mean_loss FROM ({O.scored_events()}) GROUP BY 1, 2")
def q_loss_means(spark, sf_dir):
    df = ME.loss_columns(_scored(spark, sf_dir), "logit", "real_label").select(
        F.col("user_id").cast("string").alias("run_id"), F.dayofmonth("ts").alias("epoch"), "bce")
    return rounded(ME.loss_means(df, "bce"))


# ---------------------------------------------------------------- run logs

def _runlog(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events")
    w = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    e = F.col("event_id")
    return ev.select(
        F.col("user_id").cast("string").alias("run_id"), w.cast("long").alias("epoch"),
        (F.col("value") / 100.0).alias("val_loss"), (F.col("value") / 90.0).alias("train_loss"),
        ((e * 7) % 100 / 100.0).alias("f2_ng"), ((e * 13) % 100 / 100.0).alias("recall_ng"),
        ((e * 17) % 50 / 50.0).alias("precision_ng"), ((e * 19) % 40 / 40.0).alias("precision_ok"))


_RUNLOG_STEPS = f"""WITH r AS ({O.runlog()}),
a AS (SELECT *, CASE WHEN isnan(val_loss) THEN 'inf'::DOUBLE ELSE val_loss END AS v FROM r),
b AS (SELECT *, CASE WHEN v < coalesce(min(v) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED
        PRECEDING AND 1 PRECEDING), 'inf'::DOUBLE) THEN epoch END AS imp,
        (precision_ng = 0 OR precision_ok = 0) AS zero FROM a),
c AS (SELECT *, epoch - coalesce(max(imp) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING
        AND CURRENT ROW), 0) AS counter FROM b),
d AS (SELECT *, min(CASE WHEN counter >= 5 THEN epoch END) OVER (PARTITION BY run_id) AS stop_e,
        min(CASE WHEN zero THEN epoch END) OVER (PARTITION BY run_id) AS zstop FROM c)"""


@register("early_stop",
          _RUNLOG_STEPS + " SELECT run_id, min(CASE WHEN counter >= 5 THEN epoch END) AS stop_epoch, "
          "max(epoch) AS last_epoch FROM d GROUP BY run_id")
def q_early_stop(spark, sf_dir):
    return RL.early_stop(_runlog(spark, sf_dir), patience=5)


@register("best_epoch",
          _RUNLOG_STEPS + """, e AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY f2_ng DESC, v ASC,
        epoch ASC) AS rk FROM d WHERE (stop_e IS NULL OR epoch <= stop_e) AND (zstop IS NULL OR epoch < zstop)),
z AS (SELECT run_id, bool_or(zstop IS NOT NULL AND (stop_e IS NULL OR zstop <= stop_e)) AS zero_stop FROM d GROUP BY run_id)
SELECT z.run_id, coalesce(e.epoch, 0)::BIGINT AS best_epoch,
  round(CASE WHEN z.zero_stop THEN 0.0 ELSE coalesce(e.f2_ng, -1.0) END, 6) AS f2_ng, round(coalesce(e.recall_ng, 0.0), 6) AS recall_ng,
  round(coalesce(e.precision_ng, 0.0), 6) AS precision_ng, round(coalesce(e.precision_ok, 0.0), 6) AS precision_ok,
  round(CASE WHEN e.epoch IS NULL THEN 'inf'::DOUBLE ELSE e.val_loss END, 6) AS val_loss, z.zero_stop
FROM z LEFT JOIN (SELECT * FROM e WHERE rk = 1) e USING (run_id)""")
def q_best_epoch(spark, sf_dir):
    return rounded(RL.best_epoch(_runlog(spark, sf_dir), patience=5))


@register("recall_trigger",
          f"""SELECT run_id, epoch, CASE WHEN (epoch - 1) >= 5 AND (epoch - 1) % 2 = 0 AND sum(CASE WHEN recall_ng > 0.9
  THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) = 0 THEN 'raise'
  WHEN (epoch - 1) >= 5 AND (epoch - 1) % 2 = 0 AND sum(CASE WHEN recall_ng > 0.9 THEN 1 ELSE 0 END) OVER
  (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) = 5 THEN 'lower' END AS action
FROM ({O.runlog()}) WINDOW w AS (PARTITION BY run_id ORDER BY epoch)""")
def q_recall_trigger(spark, sf_dir):
    return RL.recall_trigger(_runlog(spark, sf_dir), branch="sampler")


# ---------------------------------------------------------------- state and JSON ingest

@register("state_latest",
          "SELECT event_type AS key, arg_max(CAST(value AS VARCHAR), event_id) AS value, max(event_id) AS version "
          "FROM events GROUP BY 1")
def q_state_latest(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events")
    state = ev.select(F.col("event_type").alias("key"), F.col("value").cast("string").alias("value"),
                      F.col("event_id").alias("version"))
    return ST.latest_state(state)


# Fixed test parameter: high watermark 1998-06-01T00:00:00Z in epoch ms.
CUTOFF_MS = 896659200000

_JSON_ROWS = """SELECT epoch_ms(max(l_shipdate) OVER (PARTITION BY l_suppkey, l_orderkey)) AS ts,
  'M' || CAST(l_suppkey % 10 AS VARCHAR) AS device,
  CAST(row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY l_linenumber, l_tax, l_discount,
       l_extendedprice, l_quantity, l_partkey) - 1 AS INTEGER) AS pos,
  CAST(l_suppkey AS VARCHAR) AS part_number, CAST(l_linenumber AS DOUBLE) AS subpart_no,
  l_tax AS machine_position, l_discount AS third_param, l_extendedprice AS second_param,
  l_quantity AS first_param, CAST(l_partkey AS DOUBLE) AS temp_a, CAST(l_orderkey AS DOUBLE) AS temp_b
FROM lineitem"""


@register("incremental_filter",
          f"SELECT ts, device, CAST(count(*) AS INTEGER) AS n_items FROM ({_JSON_ROWS}) WHERE ts > {CUTOFF_MS} "
          "GROUP BY ts, device, part_number, temp_b")
def q_incremental_filter(spark, sf_dir):
    src = J.incremental_filter(FX.json_source(spark, sf_dir), CUTOFF_MS)
    return src.select("ts", "device", F.json_array_length("payload").alias("n_items"))


@register("json_unnest",
          f"SELECT ts, device, pos, part_number FROM ({_JSON_ROWS})")
def q_json_unnest(spark, sf_dir):
    rows = J.unnest_json(FX.json_source(spark, sf_dir))
    return rows.select("ts", "device", "pos", F.try_variant_get("value", '$["PART_NUMBER"]', "string").alias(
        "part_number"))


@register("json_object_unnest",
          "SELECT event_id, CAST(0 AS INTEGER) AS pos, 'k' AS key, CAST(props->>'$.k' AS BIGINT) AS v FROM events")
def q_json_object_unnest(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("payload"))
    rows = J.unnest_json(ev, keep_key=True)
    return rows.select("event_id", "pos", "key",
                       F.try_variant_get("value", "$", "bigint").alias("v"))


_EXTRACT_COLS = ("device, pos, part_number, subpart_no, machine_position, third_param, second_param, first_param, "
                 "temp_a, temp_b")


@register("json_extract", f"SELECT ts, {_EXTRACT_COLS} FROM ({_JSON_ROWS})")
def q_json_extract(spark, sf_dir):
    rows = J.extract_measurements(J.unnest_json(FX.json_source(spark, sf_dir)))
    return J.lower_columns(rows)


@register("ingest_job", f"SELECT {_EXTRACT_COLS} FROM ({_JSON_ROWS}) WHERE ts > {CUTOFF_MS}")
def q_ingest_job(spark, sf_dir):
    return IG.ingest_json(FX.json_source(spark, sf_dir), CUTOFF_MS)


@register("watermark_advance",
          f"SELECT max(ts) AS last_ts, arg_min(part_number, (pos, device, part_number)) AS last_part FROM "
          f"({_JSON_ROWS}) WHERE ts = (SELECT max(ts) FROM ({_JSON_ROWS}) WHERE ts > {CUTOFF_MS}) AND ts > {CUTOFF_MS}")
def q_watermark_advance(spark, sf_dir):
    new = J.incremental_filter(FX.json_source(spark, sf_dir), CUTOFF_MS)
    return ST.watermark_advance(J.extract_measurements(J.unnest_json(J.newest(new))))


@register("run_ingest_state", f"SELECT {_EXTRACT_COLS} FROM ({_JSON_ROWS}) WHERE ts > {CUTOFF_MS}")
def q_run_ingest_state(spark, sf_dir):
    """Two increments of a growing source: the second run starts at the stored watermark."""
    state, out, mid = _scratch(spark, "state"), _scratch(spark, "ingest"), CUTOFF_MS + 40 * 86_400_000
    raw = FX.json_source(spark, sf_dir)
    ST.set_value(spark, state, IG.LAST_TS_KEY, CUTOFF_MS)
    IG.run_ingest(spark, raw.where(F.col("ts") <= mid), state, out)
    IG.run_ingest(spark, raw, state, out)
    return spark.read.parquet(out).drop("after_ts")


# ---------------------------------------------------------------- positional CSV folders



@register("csv_folder_ingest",
          "SELECT CASE WHEN files_type = 'OK' THEN 0 ELSE 1 END AS source_rank, part_number, subpart_no, ng_valve_no, "
          "subpart_label, count(*) AS n_rows, round(sum(first_param), 6) AS sum_first, "
          "round(sum(CAST(l_orderkey AS DOUBLE)), 6) AS sum_temp_b "
          f"FROM (SELECT *, {O.VALVE} AS ng_valve_no, {O.status()} AS subpart_label FROM ({O.measure()})) GROUP BY ALL")
def q_csv_folder_ingest(spark, sf_dir):
    """lineitem written as positional CSV files (OK and NG folders), read back by the
    folder ingest job and stacked by name."""
    import uuid

    from seqflow.session import scratch_path
    root = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    ok_dir, ng_dir = FX.write_csv_folders(spark, sf_dir, root)
    ok = CSV.folder_ingest(spark, ok_dir, "OK", device="M1", source_rank=0)
    ng = CSV.folder_ingest(spark, ng_dir, "NG", device="M1", source_rank=1)
    rows = P.union_sources(ok, ng)
    return rounded(rows.groupBy("source_rank", "part_number", "subpart_no", "ng_valve_no", "subpart_label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("first_param").alias("sum_first"),
        F.sum("temp_b").alias("sum_temp_b")))


# ---------------------------------------------------------------- streaming


@register("stream_csv_ingest", ORACLE["csv_folder_ingest"])
def q_stream_csv_ingest(spark, sf_dir):
    """The CSV folders as a stream: a first drop, then a second one together with the first sent again."""
    import uuid

    from seqflow.session import scratch_path
    root = scratch_path(spark, f"csv-stream-{uuid.uuid4().hex}")
    first = F.pmod(F.xxhash64("part_number"), F.lit(2)) == 0
    for drops in ([("a", first)], [("b", ~first), ("c", first)]):
        for name, rows in drops:
            FX.write_csv_folders(spark, sf_dir, f"{root}/in/{name}", rows)
        for kind, rank in (("OK", 0), ("NG", 1)):
            SC_IN.start_folder_ingest(spark, f"{root}/in/*/{kind}", kind, "M1", f"{root}/sink/{kind}", f"{root}/checkpoint/{kind}",
                                      source_rank=rank).awaitTermination()
    rows = spark.read.parquet(f"{root}/sink/OK").unionByName(spark.read.parquet(f"{root}/sink/NG"))
    return rounded(rows.groupBy("source_rank", "part_number", "subpart_no", "ng_valve_no", "subpart_label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("first_param").alias("sum_first"),
        F.sum("temp_b").alias("sum_temp_b")))



@register("stream_ingest", ORACLE["json_extract"])
def q_stream_ingest(spark, sf_dir):
    """Raw JSON-payload rows (from lineitem) land as two files (before / after the
    watermark); an availableNow stream ingests both; the sink is read back."""
    import uuid

    from seqflow.session import scratch_path
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    src = FX.json_source(spark, sf_dir)  # built once for both
    src.withColumn("late", F.col("ts") > CUTOFF_MS).where("late is not null").write.partitionBy("late").parquet(f"{root}/source")
    q = SI.start_ingest(spark, f"{root}/source/late=*", f"{root}/sink", f"{root}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/sink")


_STREAM_BASE = O.length_filtered(O.normalized(O.labelled(True)))
_STREAM_T = f"SELECT max(c) FROM (SELECT count(*) AS c FROM ({_STREAM_BASE}) GROUP BY part_number, subpart_no)"
_STREAM_COLS = _SUMMARY_SQL_COLS.replace("round(sum(subpart_label), 6) AS ng_rows",
                                         "count(*) FILTER (WHERE subpart_label = 'NG') AS ng_rows")


@register("stream_prepare_features",
          f"SELECT {_STREAM_COLS} FROM ("
          + O.all_features(O.part_indexed(O.padded_clean(O.indexed(_STREAM_BASE), _STREAM_T)))
          + ") GROUP BY part_number")
def q_stream_prepare_features(spark, sf_dir):
    """Labelled measurement rows stream through event-time state to prepare (score mode, stored T) -> features -> per-part
    summary. Each part is measured within an hour of its own; the rows arrive in three drops, cut inside runs, which are
    streamed one after the other with one checkpoint. A clock row closes the last runs."""
    import uuid
    from datetime import timedelta

    from seqflow.session import scratch_path
    root = scratch_path(spark, f"score-{uuid.uuid4().hex}")
    seconds = F.col("part_number").cast("long") * 3600 + F.datediff("l_shipdate", F.lit("1992-01-01").cast("date"))
    src = TB.write_table(labelled(spark, sf_dir).withColumn("ts", F.timestamp_seconds(seconds)), path=f"{root}/all")
    # the stored padding length of the train run (one integer through the driver), and the times where drops are cut
    kept = P.filter_by_length(P.normalize_subparts(src), K_SUBPARTS, STEPS)
    t = spark.range(1).select(P.max_sequence_length(kept)).first()[0]
    cuts = src.agg(F.percentile_approx("ts", [0.3, 0.6]).alias("c"), F.max("ts").alias("last")).first()
    drop = F.when(F.col("ts") < F.lit(cuts["c"][0]), 0).when(F.col("ts") < F.lit(cuts["c"][1]), 1).otherwise(2)
    stream = spark.readStream.schema(src.schema).parquet(f"{root}/source/*")

    def summary(feats):
        return _summary(feats.withColumn("subpart_label", (F.col("subpart_label") == "NG").cast("long")))

    gap, last = timedelta(hours=1), cuts["last"] + timedelta(hours=3)
    drops = [*[src.where(drop == k) for k in range(3)], SR.clock_row(spark, src.schema, "ts", last)]
    for k, rows in enumerate(drops):
        rows.write.parquet(f"{root}/source/{k}")
        SR.start_scoring_runs(stream, f"{root}/sink", f"{root}/checkpoint", "ts", "10 minutes", gap, order_by=FX.MEASUREMENT_ORDER, target_len=t,
                              steps=STEPS, scorer=summary, n_subparts=K_SUBPARTS).awaitTermination()
    return spark.read.parquet(f"{root}/sink").drop("batch_id")


# ---------------------------------------------------------------- model jobs and pandas UDF surface



#: of tables of long arrays: a scan turns up to 4,096 rows of a row group into vectors at once, which took about 500 MB a
#: task with row groups of 128 MB
_WIDE_ROWS = {"parquet.block.size": str(16 << 20)}


def _nested_with_split(spark, sf_dir, engineered: bool = False):
    """Nested sequences with their split; written first, as the split and the jobs after it read them. A fit's tasks then
    hold what a split of the files holds, and not a share of the rows that depends on the shuffle partitions."""
    if engineered:
        df, t = prepare_job_with_length(labelled(spark, sf_dir), order_by=FX.MEASUREMENT_ORDER, mode="train",
                                        n_subparts=K_SUBPARTS, steps=STEPS)
        rows = FE.add_all_features(df).na.fill(0.0, _FEATURE_COLS)
        nested = SQ.nest_sequences(SQ.chunk_rows(rows, t, by=("part_number",)), _FEATURE_COLS, by=("part_number",))
    else:
        nested = SQ.nest_sequences(_chunked(spark, sf_dir), _SEQ_FEATURES, by=("part_number",))
    nested = TB.write_table(nested, path=_scratch(spark, "nested"), options=_WIDE_ROWS)
    groups = SQ.split_groups(nested, keys=("part_number", "chunk"), train_size=0.75, val_size=0.1)
    return SQ.with_split(nested, groups, keys=("part_number", "chunk"))


@register("fit_score_report")
def q_fit_score_report(spark, sf_dir):
    """Weighted logistic regression on train sequences, scored on the test split, with
    the classification report (model output: no SQL oracle)."""
    data = _nested_with_split(spark, sf_dir)
    train = SQ.class_weights(data.where(F.col("split") == "train"))
    model = MD.fit_classifier(train, "logistic", {"maxIter": 20, "regParam": 0.01})
    scored = MD.score_sequences(model, data.where(F.col("split") == "test"), keys=("part_number", "chunk"),
                                real_label="subpart_label")
    return ME.classification_report(scored, "real_label", "label")


@register("fit_score_properties",
          f"""WITH g AS (SELECT part_number, chunk, max(subpart_label) AS subpart_label FROM ({O.chunked(_PREP, _T_PREP)}) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY subpart_label ORDER BY md5('42#' || part_number || '#' || chunk), part_number, chunk) AS rk,
  count(*) OVER (PARTITION BY subpart_label) AS tot FROM g),
s AS (SELECT *, floor(tot * {_P_TRAIN!r}) AS ntr FROM r)
SELECT subpart_label AS real_label, count(*) AS support, count(*) AS in_range FROM s
WHERE rk > ntr + floor((tot - ntr) * {_P_VAL!r}) GROUP BY 1""")
def q_fit_score_properties(spark, sf_dir):
    """Ops 69 + 71 end to end on the 19 engineered columns: fit on train, save, load in another
    place, score the test split. Per true class: sequences, and those with probabilities that
    add up to one and a label that follows from them."""
    from pyspark.ml import PipelineModel
    data = _nested_with_split(spark, sf_dir, engineered=True)
    path = _scratch(spark, "model")
    MD.fit_classifier(SQ.class_weights(data.where(F.col("split") == "train")), "logistic",
                      {"maxIter": 10, "regParam": 0.01}).write().overwrite().save(path)
    scored = MD.score_sequences(PipelineModel.load(path), data.where(F.col("split") == "test"),
                                keys=("part_number", "chunk"), real_label="subpart_label")
    p, q = F.col("prob_NG"), F.col("prob_OK")
    ok = p.between(0, 1) & (F.abs(p + q - 1) < 1e-9) & (F.col("label") == (p > 0.5).cast("int"))
    return scored.groupBy("real_label").agg(F.count(F.lit(1)).alias("support"), F.sum(ok.cast("long")).alias("in_range"))


@register("grid_search_properties", "SELECT unnest([0.01, 0.1])::DOUBLE AS reg_param, true AS f2_in_range")
def q_grid_search_properties(spark, sf_dir):
    """Op 70: one row per grid point, its mean F2 within 0..1."""
    return q_grid_search_f2(spark, sf_dir).select("reg_param", F.col("mean_f2").between(0, 1).alias("f2_in_range"))


@register("grid_search_f2")
def q_grid_search_f2(spark, sf_dir):
    """Cross-validated grid on F2 (NG); one row per grid point with its mean metric."""
    data = _nested_with_split(spark, sf_dir)
    train = SQ.class_weights(data.where(F.col("split") != "test"))
    grid = {"regParam": [0.01, 0.1]}
    cv = MD.grid_search(train, grid, folds=2)
    rows = [(float(pm[list(pm)[0]]), float(m)) for pm, m in zip(cv.getEstimatorParamMaps(), cv.avgMetrics)]
    return spark.createDataFrame(rows, "reg_param DOUBLE, mean_f2 DOUBLE")


_LOSSES = {"default": {}, "weighted": {"pos_weight": 3.0}, "focal": {"gamma": 2.0, "alpha": 0.25, "by_label": True}}
_LOSS_REG = 0.001


def _loss_slopes(kind: str) -> tuple[str, str]:
    """SQL derivatives by the logit z of a positive's and a negative's loss."""
    p, q = "(1 / (1 + exp(-z)))", "(1 / (1 + exp(z)))"
    if kind == "focal":  # d/dz of a * (1 - p)^2 * -ln(p), and the same for the negative with p and q swapped
        return f"0.25 * (2 * {q} * {q} * {p} * ln({p}) - {q} * {q} * {q})", f"0.75 * (-2 * {p} * {p} * {q} * ln({q}) + {p} * {p} * {p})"
    return f"{3.0 if kind == 'weighted' else 1.0!r} * -{q}", p


# a coefficient per group: with one feature per group each solves an equation of its own, by halving an interval
_LOSS_SQL = " UNION ALL ".join(f"""SELECT '{kind}' AS loss, g AS line, round((lo + hi) / 2, 6) AS coefficient FROM (
  WITH RECURSIVE t AS (SELECT l_linenumber AS g, count(*) FILTER (WHERE l_returnflag = 'R') AS n1, count(*) FILTER (WHERE l_returnflag <> 'R') AS n0,
      (SELECT count(*) FROM lineitem)::DOUBLE AS n FROM lineitem GROUP BY 1),
    it AS (SELECT g, n1, n0, n, -9.0::DOUBLE AS lo, 9.0::DOUBLE AS hi, 0 AS step FROM t
      UNION ALL SELECT g, n1, n0, n, CASE WHEN slope < 0 THEN z ELSE lo END, CASE WHEN slope < 0 THEN hi ELSE z END, step + 1 FROM (
        SELECT *, (n1 * ({_loss_slopes(kind)[0]}) + n0 * ({_loss_slopes(kind)[1]})) / n + {_LOSS_REG} * z AS slope FROM (SELECT *, (lo + hi) / 2 AS z FROM it WHERE step < 60)))
  SELECT * FROM it WHERE step = 60)""" for kind in _LOSSES)


@register("fit_loss", _LOSS_SQL)
def q_fit_loss(spark, sf_dir):
    """Op 69 with each of the losses: whether a line is returned, by a coefficient per line number."""
    from seqflow.plans.loss_fit import fit_loss
    lines = FX.table(spark, sf_dir, "lineitem").select("l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    numbers = [r[0] for r in lines.select("l_linenumber").distinct().orderBy("l_linenumber").collect()]  # 1 to 7
    x = F.array(*[(F.col("l_linenumber") == n).cast("double") for n in numbers])
    rows = lines.select(x.alias("x"), "returned")
    out = []
    for kind, options in _LOSSES.items():
        fit = fit_loss(rows, kind, label="returned", reg=_LOSS_REG, intercept=False, epochs=200, **options)
        out += [(kind, n, round(c, 6)) for n, c in zip(numbers, fit.model.coefficients.tolist(), strict=True)]
    return spark.createDataFrame(out, "loss string, line int, coefficient double")


_FOLDS = 3


@register("grid_search_folds", f"""WITH g AS (SELECT part_number, chunk, max(subpart_label) AS y FROM ({O.chunked(_PREP, _T_PREP)}) GROUP BY 1, 2)
SELECT CAST(('0x' || substr(md5('42#' || part_number), 1, 8))::BIGINT % {_FOLDS} AS INTEGER) AS fold, count(DISTINCT part_number) AS n_parts,
  count(*) AS n_sequences, CAST(sum(y) AS BIGINT) AS n_ng, true AS f2_recomputed FROM g GROUP BY 1""")
def q_grid_search_folds(spark, sf_dir):
    """Op 70 with folds by part: per fold its parts and sequences, and whether the search's mean F2 equals, for every grid
    point, the one recomputed from the scores of the sequences that the fold's models have not seen."""
    nested = TB.write_table(SQ.nest_sequences(_chunked(spark, sf_dir), _SEQ_FEATURES, by=("part_number",)), path=_scratch(spark, "nested"))
    train = SQ.class_weights(nested)
    cv = MD.grid_search(train, {"regParam": [0.01, 0.1]}, folds=_FOLDS, fold_by=("part_number",), keep_models=True)
    rows = MD.materialize(train.withColumn(MD.FOLD, MD.fold_number(("part_number",), _FOLDS)))
    means = []
    for i in range(len(cv.avgMetrics)):
        scores = []
        for k in range(_FOLDS):
            scored = MD.score_sequences(cv.subModels[k][i], rows.where(F.col(MD.FOLD) == k), keys=("part_number", "chunk"), real_label="subpart_label")
            scores.append(ME.fbeta(scored, "real_label", "label").first()["fbeta"])
        means.append(sum(scores) / _FOLDS)
    same = all(abs(a - b) < 1e-9 for a, b in zip(cv.avgMetrics, means, strict=True))
    return rows.groupBy(MD.FOLD).agg(F.count_distinct("part_number").alias("n_parts"), F.count(F.lit(1)).alias("n_sequences"),
                                     F.sum("subpart_label").cast("long").alias("n_ng"), F.lit(same).alias("f2_recomputed"))


def _seq_stats(pdf):
    import pandas as pd
    x = pdf["first_param"].take(pdf["subpart_index"].to_numpy().argsort(kind="stable"))
    return pd.DataFrame({"part_number": [pdf["part_number"].iloc[0]], "subpart_no": [pdf["subpart_no"].iloc[0]],
                         "first_range": [float(x.max() - x.min())], "first_median": [float(x.median())],
                         "n_rows": [len(pdf)]})


@register("grouped_pandas",
          "SELECT part_number, subpart_no, round(max(first_param) - min(first_param), 6) AS first_range, "
          "round(median(first_param), 6) AS first_median, count(*) AS n_rows "
          f"FROM ({O.indexed(O.length_filtered(O.measure()))}) GROUP BY 1, 2")
def q_grouped_pandas(spark, sf_dir):
    """A user-supplied per-sequence pandas function (applyInPandas) on bounded sequences."""
    df = P.add_subpart_index(P.filter_by_length(FX.measurements(spark, sf_dir), K_SUBPARTS, STEPS),
                             FX.MEASUREMENT_ORDER)
    out = FE.apply_grouped_pandas(df.select("part_number", "subpart_no", "subpart_index", "first_param"), _seq_stats,
                                  "part_number string, subpart_no double, first_range double, first_median double, "
                                  "n_rows long")
    return rounded(out)


@register("event_features_skew_safe", ORACLE["event_features"])
def q_event_features_skew_safe(spark, sf_dir):
    """Single-signal features per user with the blocked, skew-safe operator (no window
    ever holds a whole user; blocks of 16 rows here so every user spans several)."""
    df = FE.add_signal_features_skew_safe(FX.event_signal(spark, sf_dir), signals=("value",), keys=("user_id",),
                                          order=("ts", "event_id"), block_rows=16)
    return rounded(df.select("user_id", "event_id", *[f"value_{f}" for f in FE.FEATURES]))


# ---------------------------------------------------------------- mode-dependent sequence preparation



@register("prepare_sequences_train", O.sequences_train(_PREP, _T_PREP, _SEQ_FEATURES))
def q_prepare_sequences_train(spark, sf_dir):
    """Train mode: chunk the prepared rows into T-step sequences, fit and apply the
    scaler, nest, weight by class."""
    # read three times: T, the scaler fit, the rows
    df = prepared_table(spark, sf_dir, "part_number", "subpart_no", "subpart_index", "part_index", "subpart_label", *_SEQ_FEATURES)
    seqs, _ = PS.prepare_sequences(df, "train", _SEQ_FEATURES, P.column_max(df, "subpart_index"),
                                   by=("part_number",))
    return rounded(seqs.select(
        "part_number", "chunk", "subpart_label", "group_id", F.size("features").cast("long").alias("n_steps"),
        F.aggregate("features", F.lit(0.0), lambda acc, v: acc + v[0]).alias("sum_first_scaled"), "weight"))


_MODE_SQL = f"""WITH c AS ({O.chunked(_PREP, _T_PREP)}), s AS (SELECT avg(first_param) AS m, CASE WHEN stddev_pop(first_param) = 0 THEN 1.0
  ELSE stddev_pop(first_param) END AS sd FROM c)
SELECT part_number, chunk, {{label}} AS subpart_label, count(*) AS n_steps, round(sum((first_param - s.m) / s.sd), 6) AS sum_first_scaled
FROM c CROSS JOIN s GROUP BY part_number, chunk"""


def _sequences_in_mode(spark, sf_dir, mode: str):
    """A training run stores T and the scaler; the given mode reads both from the state table."""
    table, state = _scratch(spark, "scaler"), _scratch(spark, "state")
    df = prepared_table(spark, sf_dir, "part_number", "subpart_no", "subpart_index", "part_index", "subpart_label", *_SEQ_FEATURES)
    t = spark.range(1).select(P.column_max(df, "subpart_index")).first()[0]
    _, params = PS.prepare_sequences(df, "train", _SEQ_FEATURES, t, by=("part_number",))
    ST.set_value(spark, state, "padding_length", t)
    SC.persist_fit(spark, params, table, state)
    stored = spark.read.schema(ST.STATE_SCHEMA).parquet(state)
    scaler = SC.load_scaler(spark, table, ST.get_value(stored, "last_scaler_id"))
    seqs, _ = PS.prepare_sequences(df, mode, _SEQ_FEATURES, ST.get_value(stored, "padding_length"), scaler, by=("part_number",))
    return rounded(seqs.select("part_number", "chunk", "subpart_label", F.size("features").cast("long").alias("n_steps"),
                               F.aggregate("features", F.lit(0.0), lambda acc, v: acc + v[0]).alias("sum_first_scaled")))


@register("prepare_sequences_val", _MODE_SQL.format(label="max(subpart_label)"))
def q_prepare_sequences_val(spark, sf_dir):
    return _sequences_in_mode(spark, sf_dir, "val")


@register("prepare_sequences_score", _MODE_SQL.format(label="0.0::DOUBLE"))
def q_prepare_sequences_score(spark, sf_dir):
    """Score mode: no labels are read, all are 0."""
    return _sequences_in_mode(spark, sf_dir, "score")
