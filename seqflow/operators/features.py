"""Per-sequence signal features as native window expressions.

All features of all signals are computed with two Window operators over one
partitioning (part, subpart) ordered by the sequence index: level 1 holds neighbours,
centred frames and differences, level 2 the features of features (acceleration and
running sums). No Python UDF is involved; `apply_grouped_pandas` exists only for
user-supplied per-sequence functions.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqflow.functions.scalar import magnitude
from seqflow.operators.ordering import ordered_index
from seqflow.operators.prepare import INDEX, PART, SUBPART, require

# Signal names, feature suffixes and their order in the feature set.
SIGNALS = ("first_param", "second_param", "third_param")
FEATURES = ("velocity", "acceleration", "moving_average", "moving_std", "neighbor_diff", "neighbor_diff_cumsum")
MAGNITUDE_INPUTS = ("third_param", "second_param", "first_param")
DEFAULT_KEYS = (PART, SUBPART)


def centred_frame(window_size: int) -> tuple[int, int]:
    """Rows frame of a centred rolling window: odd w -> +-(w-1)/2; even w -> i-w/2 .. i+w/2-1."""
    return -(window_size // 2), (window_size - 1) // 2


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _frame(lo: int, hi: int) -> str:
    a = "CURRENT ROW" if lo == 0 else f"{-lo} PRECEDING" if lo < 0 else f"{lo} FOLLOWING"
    b = "CURRENT ROW" if hi == 0 else f"{hi} FOLLOWING" if hi > 0 else f"{-hi} PRECEDING"
    return f"ROWS BETWEEN {a} AND {b}"


def _gradient_sql(x: str, prev: str, nxt: str) -> str:
    return (f"CASE WHEN __sf_n = 1 THEN CAST(NULL AS DOUBLE) WHEN __sf_rn = 1 THEN {nxt} - {x} "
            f"WHEN __sf_rn = __sf_n THEN {x} - {prev} ELSE ({nxt} - {prev}) / 2 END")


def add_signal_features(
    df: DataFrame,
    signals: Sequence[str] = SIGNALS,
    keys: Sequence[str] = DEFAULT_KEYS,
    order: Sequence[str] = (INDEX,),
    window_size: int = 3,
    features: Sequence[str] = FEATURES,
    abs_cumsum: Sequence[str] = (),
    prefix_sep: str = "_",
) -> DataFrame:
    """Ops 45-52: for each signal add `{signal}_{feature}` for the requested features.

    velocity: gradient; acceleration: gradient of the velocity; moving_average /
    moving_std: centred rows frame, missing values skipped, sample std (one value ->
    NULL); neighbor_diff: x[i] - x[i-1], first row x - x; neighbor_diff_cumsum: running
    sum of the differences, NULL where the difference is NULL (signals listed in
    `abs_cumsum` sum absolute differences instead).

    The window expressions are written as Spark SQL text (`selectExpr`): one call per
    level instead of hundreds of small Column calls; the plan is the same.
    """
    keys, order = list(keys), list(order)
    require(df, *keys, *signals, *order)
    lo, hi = centred_frame(window_size)
    spec = f"PARTITION BY {', '.join(map(_q, keys))} ORDER BY {', '.join(map(_q, order))}"
    over = f"OVER ({spec})"
    whole = f"OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    moving = f"OVER ({spec} {_frame(lo, hi)})"
    running = f"OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    want = set(features)
    grad = bool(want & {"velocity", "acceleration"})
    name = lambda s, f: _q(f"{s}{prefix_sep}{f}")

    lvl1 = ["*", f"row_number() {over} AS __sf_rn", f"count(1) {whole} AS __sf_n"]
    for s in signals:
        x = f"CAST({_q(s)} AS DOUBLE)"
        if grad:
            lvl1 += [f"lag({x}, 1) {over} AS {_q('__sf_' + s + '_prev')}",
                     f"lead({x}, 1) {over} AS {_q('__sf_' + s + '_next')}"]
        if "moving_average" in want:
            lvl1.append(f"avg({x}) {moving} AS {name(s, 'moving_average')}")
        if "moving_std" in want:
            lvl1.append(f"stddev_samp({x}) {moving} AS {name(s, 'moving_std')}")
        if want & {"neighbor_diff", "neighbor_diff_cumsum"}:
            lvl1.append(f"CASE WHEN row_number() {over} = 1 THEN {x} - {x} ELSE {x} - lag({x}, 1) {over} END "
                        f"AS {name(s, 'neighbor_diff')}")
    staged = df.selectExpr(*lvl1)

    lvl2 = ["*"]
    for s in signals:
        x = f"CAST({_q(s)} AS DOUBLE)"
        if grad:
            lvl2.append(f"{_gradient_sql(x, _q('__sf_' + s + '_prev'), _q('__sf_' + s + '_next'))} "
                        f"AS {name(s, 'velocity')}")
        if "neighbor_diff_cumsum" in want:
            d = name(s, "neighbor_diff")
            term = f"abs({d})" if s in abs_cumsum else d
            lvl2.append(f"CASE WHEN {d} IS NOT NULL THEN sum({term}) {running} END AS {name(s, 'neighbor_diff_cumsum')}")
    staged = staged.selectExpr(*lvl2)

    if "acceleration" in want:
        lvl3 = ["*"]
        for s in signals:
            v = name(s, "velocity")
            lvl3.append(f"{_gradient_sql(v, f'lag({v}, 1) {over}', f'lead({v}, 1) {over}')} "
                        f"AS {name(s, 'acceleration')}")
        staged = staged.selectExpr(*lvl3)

    out_cols = list(df.columns) + [f"{s}{prefix_sep}{f}" for s in signals for f in FEATURES if f in want]
    return staged.select(*[F.col(_q(c)) for c in out_cols])


def add_signal_features_skew_safe(
    df: DataFrame,
    signals: Sequence[str] = SIGNALS,
    keys: Sequence[str] = DEFAULT_KEYS,
    order: Sequence[str | Column] = (INDEX,),
    window_size: int = 3,
    abs_cumsum: Sequence[str] = (),
    block_rows: int = 1 << 16,
    prefix_sep: str = "_",
) -> DataFrame:
    """The six features of `add_signal_features` for groups of any size.

    No window sees a whole group: rows get a dense position from the skew-safe
    `ordered_index`, are cut into blocks of `block_rows` per group, and each block also
    receives a halo of neighbouring rows on each side: 2 for the gradient of the gradient, or
    as many as the centred frame of `window_size` rows needs. Windows run per (group, block); the
    group's last row is the one without a successor. Running sums add per-block offsets
    (a window over the small block-sum table, joined back on (group, block)).
    Results equal the plain operator up to floating-point summation order.
    """
    keys = list(keys)
    require(df, *keys, *signals)
    lo, hi = centred_frame(window_size)
    halo = max(2, -lo, hi)
    if block_rows <= 2 * halo:
        raise ValueError(f"block_rows must be more than {2 * halo} for window_size {window_size}")
    cols = list(df.columns)
    b = ordered_index(df, list(order), keys, name="__sf_i")
    off = (F.col("__sf_i") - 1) % block_rows
    empty = F.array().cast("array<int>")
    shifts = F.concat(F.array(F.lit(0)), F.when(off < halo, F.array(F.lit(-1))).otherwise(empty),
                      F.when(off >= block_rows - halo, F.array(F.lit(1))).otherwise(empty))
    home_blk = F.floor((F.col("__sf_i") - 1) / block_rows).cast("long")
    ex = (b.withColumn("__sf_home", home_blk).withColumn("__sf_shift", F.explode(shifts))
          .withColumn("__sf_blk", F.col("__sf_home") + F.col("__sf_shift")).where(F.col("__sf_blk") >= 0))
    wo = Window.partitionBy(*keys, "__sf_blk").orderBy("__sf_i")
    wm = wo.rowsBetween(lo, hi)
    first = F.col("__sf_i") == 1
    last = F.lead(F.lit(1), 1).over(wo).isNull()
    lvl1 = [F.col(c) for c in ex.columns] + [first.alias("__sf_first"), last.alias("__sf_last")]
    for s in signals:
        x = F.col(s).cast("double")
        lvl1 += [F.lag(x, 1).over(wo).alias(f"__sf_{s}_prev"), F.lead(x, 1).over(wo).alias(f"__sf_{s}_next"),
                 F.avg(x).over(wm).alias(f"{s}{prefix_sep}moving_average"),
                 F.stddev_samp(x).over(wm).alias(f"{s}{prefix_sep}moving_std"),
                 F.when(first, x - x).otherwise(x - F.lag(x, 1).over(wo)).alias(f"{s}{prefix_sep}neighbor_diff")]
    st = ex.select(*lvl1)

    def grad(x, prev, nxt, fst, lst):
        return (F.when(fst & lst, F.lit(None).cast("double")).when(fst, nxt - x).when(lst, x - prev)
                .otherwise((nxt - prev) / 2))

    fst, lst = F.col("__sf_first"), F.col("__sf_last")
    st = st.select("*", *[grad(F.col(s).cast("double"), F.col(f"__sf_{s}_prev"), F.col(f"__sf_{s}_next"), fst, lst)
                          .alias(f"{s}{prefix_sep}velocity") for s in signals])
    st = st.select("*", *[grad(F.col(f"{s}{prefix_sep}velocity"), F.lag(f"{s}{prefix_sep}velocity", 1).over(wo),
                               F.lead(f"{s}{prefix_sep}velocity", 1).over(wo), fst, lst)
                          .alias(f"{s}{prefix_sep}acceleration") for s in signals])
    home = st.where(F.col("__sf_shift") == 0)
    terms = {s: (F.abs(F.col(f"{s}{prefix_sep}neighbor_diff")) if s in abs_cumsum
                 else F.col(f"{s}{prefix_sep}neighbor_diff")) for s in signals}
    sums = home.groupBy(*keys, "__sf_blk").agg(*[F.sum(t).alias(f"__sf_{s}_bs") for s, t in terms.items()])
    wb = Window.partitionBy(*keys).orderBy("__sf_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(*keys, "__sf_blk", *[F.coalesce(F.sum(f"__sf_{s}_bs").over(wb), F.lit(0.0))
                                             .alias(f"__sf_{s}_off") for s in signals])
    h, o = home.alias("__sf_h"), offs.alias("__sf_o")
    cond = F.col("__sf_h.__sf_blk") == F.col("__sf_o.__sf_blk")
    for k in keys:
        cond = cond & F.col(f"__sf_h.`{k}`").eqNullSafe(F.col(f"__sf_o.`{k}`"))
    j = h.join(o, cond, "inner").select("__sf_h.*", *[F.col(f"__sf_o.__sf_{s}_off") for s in signals])
    run = Window.partitionBy(*keys, "__sf_blk").orderBy("__sf_i").rowsBetween(Window.unboundedPreceding,
                                                                              Window.currentRow)
    out = j.select("*", *[F.when(F.col(f"{s}{prefix_sep}neighbor_diff").isNotNull(),
                                 F.col(f"__sf_{s}_off") + F.sum(terms[s]).over(run))
                          .alias(f"{s}{prefix_sep}neighbor_diff_cumsum") for s in signals])
    out_cols = cols + [f"{s}{prefix_sep}{f}" for s in signals for f in FEATURES]
    return out.select(*out_cols)


def add_magnitude(df: DataFrame, inputs: Sequence[str] = MAGNITUDE_INPUTS, name: str = "magnitude") -> DataFrame:
    """Op 23: sqrt(a^2 + b^2 + c^2); NULL propagates."""
    require(df, *inputs)
    a, b, c = (F.col(x).cast("double") for x in inputs)
    return df.withColumn(name, magnitude(a, b, c))


def add_all_features(
    df: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    order: Sequence[str | Column] = (INDEX,),
    window_size: int = 3,
) -> DataFrame:
    """Op 53: three signals x six features + magnitude = 19 DOUBLE columns."""
    out = add_signal_features(df, SIGNALS, keys, order, window_size)
    return add_magnitude(out)


def add_relative_features(
    df: DataFrame,
    start_index: int = 75,
    end_index: int = 125,
    feature_list: Sequence[str] = SIGNALS,
    part: str = PART,
    index: str = INDEX,
    skew_safe: bool = False,
) -> DataFrame:
    """Ops 33 + 34 + 55: relative_f = f / (median setpoint of f in the part + 1e-9).

    The setpoint is the exact median of f over rows with start <= index <= end in the
    part: an aggregate over these rows only, joined back (AQE broadcasts it or splits a hot
    part); parts without rows in range get NULL. `skew_safe=True` selects the medians by rank, for parts of any size.
    """
    require(df, part, index, *feature_list)
    medians = median_setpoints_by_rank if skew_safe else median_setpoints
    points = medians(df, start_index, end_index, feature_list, part, index)
    points = points.select(F.col(part).alias("__sf_part"), *[F.col(f"{f}_setpoint").alias(f"__sf_{f}_setpoint") for f in feature_list])
    out = df.join(points, F.col(part).eqNullSafe(F.col("__sf_part")), "left")
    rel = [(F.col(f) / (F.col(f"__sf_{f}_setpoint") + F.lit(1e-9))).alias(f"relative_{f}") for f in feature_list]
    return out.select(*[F.col(c) for c in df.columns], *rel)


def median_setpoints(
    df: DataFrame,
    start_index: int = 75,
    end_index: int = 125,
    feature_list: Sequence[str] = SIGNALS,
    part: str = PART,
    index: str = INDEX,
) -> DataFrame:
    """Op 33 on its own: one row per part that has rows in range, with `{f}_setpoint` (exact median)."""
    require(df, part, index, *feature_list)
    return df.where(F.col(index).between(start_index, end_index)).groupBy(part).agg(
        *[F.median(F.col(f).cast("double")).alias(f"{f}_setpoint") for f in feature_list])


def median_setpoints_by_rank(
    df: DataFrame,
    start_index: int = 75,
    end_index: int = 125,
    feature_list: Sequence[str] = SIGNALS,
    part: str = PART,
    index: str = INDEX,
) -> DataFrame:
    """`median_setpoints` for parts of any size. The values of all features are sorted into ranges and numbered per
    (part, feature) by `ordered_index`; the one or two in the middle are picked. A median aggregate keeps all
    distinct values of a part in one buffer."""
    from seqflow.operators.ordering import ordered_index
    require(df, part, index, *feature_list)
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("double").alias("v")) for f in feature_list])
    inside = df.where(F.col(index).between(start_index, end_index))
    values = inside.select(F.col(part), F.explode(pairs).alias("x")).select(part, F.col("x.f").alias("__sf_f"), F.col("x.v").alias("__sf_v"))
    ranked = ordered_index(values.where(F.col("__sf_v").isNotNull()), ["__sf_v"], [part, "__sf_f"], name="__sf_r")
    sizes = ranked.groupBy(F.col(part).alias("__sf_p"), F.col("__sf_f").alias("__sf_g")).agg(F.max("__sf_r").alias("__sf_n"))
    n, r = F.col("__sf_n"), F.col("__sf_r")
    middle = ranked.join(sizes, F.col(part).eqNullSafe(F.col("__sf_p")) & (F.col("__sf_f") == F.col("__sf_g")))
    middle = middle.where((r == F.floor((n + 1) / 2)) | (r == F.floor((n + 2) / 2)))
    parts = inside.select(part).distinct()  # also those whose values are all NULL
    found = middle.groupBy(F.col(part).alias("__sf_p")).agg(*[F.avg(F.when(F.col("__sf_f") == f, F.col("__sf_v"))).alias(f"{f}_setpoint") for f in feature_list])
    return parts.join(found, F.col(part).eqNullSafe(F.col("__sf_p")), "left").select(part, *[f"{f}_setpoint" for f in feature_list])


# Column types of the engineered schema; other names default to DOUBLE.
TYPE_OVERRIDES = {
    "row_index": T.DoubleType(),
    "device": T.StringType(),
    "part_number": T.StringType(),
    "part_index": T.DoubleType(),
    "subpart_index": T.DoubleType(),
    "subpart_no": T.DoubleType(),
    "machine_position": T.DoubleType(),
    "third_param": T.DoubleType(),
    "second_param": T.DoubleType(),
    "first_param": T.DoubleType(),
    "temp_a": T.DoubleType(),
    "temp_b": T.DoubleType(),
    "ng_valve_no": T.StringType(),
    "subpart_label": T.DoubleType(),
}


def feature_schema(df: DataFrame, names: Sequence[str], overrides: dict | None = None) -> T.StructType:
    """Op 24: existing fields, then configured names not present, typed by override or DOUBLE."""
    ov = TYPE_OVERRIDES if overrides is None else overrides
    fields = list(df.schema.fields)
    have = set(df.columns)
    for n in names:
        if n not in have:
            fields.append(T.StructField(n, ov.get(n, T.DoubleType()), True))
    return T.StructType(fields)


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto `schema`: present columns cast, absent ones typed NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def count_sequences(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Op 35: number of distinct (part, subpart) pairs, one row `n_sequences`."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_sequences"))


def apply_grouped_pandas(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    keys: Sequence[str] = DEFAULT_KEYS,
) -> DataFrame:
    """Op 78: user-supplied per-sequence pandas function with a declared output schema.

    Meant for bounded groups (sequences after the length filter). Short groups cost more to send one by one than to
    work on: the rows of many come in one batch, sorted by the keys, and are cut into groups there, at rows that Spark has
    numbered 1. Columns whose pandas type depends on whether a group holds a NULL, and functions that take the
    key, go to `applyInPandas`. Built-in features never go through here.
    """
    keys = list(keys)
    plain = all(f.dataType.typeName() in ("string", "double", "float") for f in df.schema.fields)
    if not plain or len(inspect.getfullargspec(fn).args) != 1:
        return df.groupBy(*keys).applyInPandas(fn, schema)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) == 1
    return df.withColumn(_FIRST_ROW, first).mapInPandas(lambda batches: _results(fn, _groups(batches)), schema)


_FIRST_ROW = "__sf_first_row"


def _joined(frames: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0].reset_index(drop=True)


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The groups of batches in which a group's rows lie one behind the other."""
    held: list[pd.DataFrame] = []  # of the group that may go on in the next batch
    for batch in batches:
        begins = batch[_FIRST_ROW].to_numpy().nonzero()[0].tolist()
        rows = batch.drop(columns=_FIRST_ROW)
        for a, b in zip([0, *begins], [*begins, len(rows)], strict=True):
            if b > a:
                if held and a in begins[:1]:
                    yield _joined(held)
                    held = []
                if b < len(rows):
                    yield _joined([*held, rows.iloc[a:b]])
                    held = []
                else:
                    held.append(rows.iloc[a:b])
    if held:
        yield _joined(held)


def _results(fn: Callable[[pd.DataFrame], pd.DataFrame], groups: Iterator[pd.DataFrame], most: int = 1000) -> Iterator[pd.DataFrame]:
    """`fn` of each group; results of the same columns and types are put together, up to `most` frames."""
    held: list[pd.DataFrame] = []
    kind = None
    for group in groups:
        out = fn(group)
        plain = isinstance(out, pd.DataFrame) and out.columns.is_unique and len(out) > 0
        now = ([*out.columns], [*out.dtypes]) if plain else None
        if held and (len(held) == most or now != kind):
            yield _joined(held)
            held = []
        if plain:
            held.append(out)
            kind = now
        else:
            yield out  # as it is: Spark checks it
    if held:
        yield _joined(held)
