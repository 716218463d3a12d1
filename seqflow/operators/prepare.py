"""Sequence preparation: clean ids, drop abnormal runs, index, pad, label.

Keys: a *part* (`part_number`) holds several *subparts* (`subpart_no`); one
(part, subpart) pair is one ordered *sequence*. Every window here is partitioned by
`part_number` first, so one hash exchange on the part serves the whole chain.
Groups are bounded once `filter_by_length` has run: a kept part has fewer than
`n_subparts * steps * 1.1` rows, so no later window can hold a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqflow.functions.scalar import LABEL_AMBIGUOUS, label_to_binary, normalize_subpart

PART, SUBPART, INDEX, PART_INDEX, LABEL = "part_number", "subpart_no", "subpart_index", "part_index", "subpart_label"


def require(df: DataFrame, *cols: str) -> None:
    """Raise at plan time when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"required column(s) not found: {missing}")


def normalize_subparts(df: DataFrame, subpart: str = SUBPART) -> DataFrame:
    """Ops 17 + 18: normalise tenths-encoded subpart ids, then drop subpart 0 (NULL kept)."""
    require(df, subpart)
    s = F.col(subpart)
    return df.withColumn(subpart, normalize_subpart(s)).where((s != 0) | s.isNull())


def length_bounds(n_subparts: int, steps: int) -> tuple[float, float]:
    """Strict bounds on rows per part, computed in doubles: 6*230 gives (1242.0, 1518.0000000000002)."""
    total = n_subparts * steps
    return total * 0.9, total * 1.1


def _bounds(df: DataFrame, n_subparts: int, steps: int | None, subpart: str) -> tuple[Column, Column]:
    if steps is None:
        min_sub = df.select(F.min(subpart)).scalar()
        lo230, hi230 = length_bounds(n_subparts, 230)
        lo200, hi200 = length_bounds(n_subparts, 200)
        return (F.when(min_sub == 0, F.lit(lo230)).otherwise(F.lit(lo200)),
                F.when(min_sub == 0, F.lit(hi230)).otherwise(F.lit(hi200)))
    lo_v, hi_v = length_bounds(n_subparts, steps)
    return F.lit(lo_v), F.lit(hi_v)


def filter_by_length_with_target(
    df: DataFrame,
    n_subparts: int = 6,
    steps: int | None = None,
    part: str = PART,
    subpart: str = SUBPART,
    co_located: bool = False,
) -> tuple[DataFrame, Column]:
    """Op 31 plus the longest kept sequence (the train padding length T).

    One partial aggregate of rows per (part, subpart) serves both: summed per part it
    gives the kept part set (semi-joined back), and its maximum over kept parts is T (a
    scalar subquery). Spark reuses the aggregate's exchange, so the counting pass runs once.
    `co_located=True` (a source bucketed on the part) joins the kept parts bucket by bucket, without an exchange.
    """
    require(df, part, subpart)
    lo, hi = _bounds(df, n_subparts, steps, subpart)
    seq_counts = (df.where(F.col(part).isNotNull()).groupBy(part, subpart)
                  .agg(F.count(F.lit(1)).alias("__sf_c")))
    n = F.col("__sf_n")
    kept = seq_counts.groupBy(part).agg(F.sum("__sf_c").alias("__sf_n")).where((n > lo) & (n < hi)).select(part)
    target = (seq_counts.join(kept, part, "left_semi")
              .select(F.coalesce(F.max("__sf_c"), F.lit(0)).cast("int")).scalar())
    return df.join(kept.hint("shuffle_hash") if co_located else kept, part, "left_semi"), target


def filter_by_length(
    df: DataFrame,
    n_subparts: int = 6,
    steps: int | None = None,
    part: str = PART,
    subpart: str = SUBPART,
) -> DataFrame:
    """Op 31: keep parts whose row count lies strictly inside k*steps*(0.9, 1.1).

    `steps=None` takes 230 when the table's minimum subpart is 0, else 200 (a scalar
    subquery, no action). Counts are a partial (map-side combined) aggregate, so a hot
    part costs one row per task; the kept keys are semi-joined back. AQE picks a
    broadcast at run time when the key set is small and splits skewed join partitions;
    over-long parts (the hot ones) never reach the windows that follow.
    Rows with a NULL part are dropped; rows with a NULL subpart count.
    """
    return filter_by_length_with_target(df, n_subparts, steps, part, subpart)[0]


def add_subpart_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    part: str = PART,
    subpart: str = SUBPART,
    name: str = INDEX,
    skew_safe: bool = False,
) -> DataFrame:
    """Op 43: 1-based position (DOUBLE) inside (part, subpart) by an explicit order key.

    The window assumes bounded sequences (as after `filter_by_length`); `skew_safe=True`
    numbers rows with the range-partitioned `ordered_index` for raw, possibly hot groups.
    """
    require(df, part, subpart)
    if skew_safe:
        from seqflow.operators.ordering import ordered_index
        return ordered_index(df, list(order_by), [part, subpart], name=name).withColumn(
            name, F.col(name).cast("double"))
    w = Window.partitionBy(part, subpart).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(w).cast("double"))


def add_part_index(
    df: DataFrame,
    part: str = PART,
    subpart: str = SUBPART,
    index: str = INDEX,
    name: str = PART_INDEX,
    skew_safe: bool = False,
) -> DataFrame:
    """Op 44: 1-based position (DOUBLE) inside the part, ordered by (subpart, index).
    `skew_safe=True` as in `add_subpart_index`."""
    require(df, part, subpart, index)
    if skew_safe:
        from seqflow.operators.ordering import ordered_index
        return ordered_index(df, [F.col(subpart).asc_nulls_first(), F.col(index)], [part], name=name).withColumn(
            name, F.col(name).cast("double"))
    w = Window.partitionBy(part).orderBy(F.col(subpart).asc_nulls_first(), F.col(index))
    return df.withColumn(name, F.row_number().over(w).cast("double"))


def max_sequence_length(df: DataFrame, keys: Sequence[str] = (PART, SUBPART)) -> Column:
    """Largest sequence, as a scalar subquery on per-sequence counts. Equal to the max of a
    dense 1-based index, but needs only a partial aggregate, no window or sort."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__sf_c"))
    return counts.select(F.coalesce(F.max("__sf_c"), F.lit(0)).cast("int")).scalar()


def column_max(df: DataFrame, column: str) -> Column:
    """Op 32: int(max(column)), 0 when empty, as a lazy scalar subquery column."""
    require(df, column)
    return df.select(F.coalesce(F.max(column), F.lit(0)).cast("int")).scalar()


def pad_to_length(
    df: DataFrame,
    target_len: int | Column,
    keys: Sequence[str] = (PART, SUBPART),
    index: str = INDEX,
    skew_safe: bool = False,
) -> DataFrame:
    """Op 61: sequences shorter than T get rows max_idx+1..T copying the last row.

    One pass: the last row of a short group explodes into sequence(idx, T); every other
    column is copied as is (NULLs too). Longer groups are untouched; NULL keys dropped.
    `target_len` may be a literal or a scalar-subquery column (see `column_max`). `skew_safe=True`, for groups of
    any size: count and last index come from a pre-aggregated table that is joined back, not from a window.
    """
    keys = list(keys)
    require(df, index, *keys)
    t = target_len if isinstance(target_len, Column) else F.lit(int(target_len))
    # count and max over the whole sequence need no ordering, so no extra sort
    w = Window.partitionBy(*keys)
    idx = F.col(index)
    n = F.count(F.lit(1)).over(w)
    last = F.max(idx).over(w)
    cols = [c for c in df.columns]
    not_null = None
    for k in keys:
        cond = F.col(k).isNotNull()
        not_null = cond if not_null is None else not_null & cond
    # T is referenced through one column, so a scalar subquery runs once
    kept = df.where(not_null)
    if skew_safe:
        counts = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("__sf_n"), F.max(idx).alias("__sf_last"))
        staged = kept.join(counts, keys).select(*cols, "__sf_n", "__sf_last", t.cast("int").alias("__sf_t"))
    else:
        staged = kept.select(*cols, n.alias("__sf_n"), last.alias("__sf_last"), t.cast("int").alias("__sf_t"))
    i, tc = idx.cast("int"), F.col("__sf_t")
    grow = (idx == F.col("__sf_last")) & (F.col("__sf_n") < tc) & (i < tc)
    steps = F.when(grow, F.sequence(i, tc)).otherwise(F.array(i))
    out = staged.withColumn("__sf_step", F.explode(steps))
    return out.select(*[F.col("__sf_step").cast(df.schema[index].dataType).alias(c) if c == index else F.col(c)
                        for c in cols])


def align_to_grid(
    df: DataFrame,
    target_len: int | Column,
    value_cols: Sequence[str],
    keys: Sequence[str] = (PART, SUBPART),
    index: str = INDEX,
    skew_safe: bool = False,
) -> DataFrame:
    """Op 62: reindex each observed group onto 1..T (truncating longer groups),
    forward-fill the last non-missing value, numeric columns still missing -> 0.

    Built per group without a join: every row explodes to the grid slots it owns
    (its index up to the next observed index, or T), carrying its values. `skew_safe=True`, for groups of any size: no
    window holds a whole group, the last values are carried from block to block (`ordering.carried_fill`).
    """
    keys = list(keys)
    require(df, index, *keys, *value_cols)
    t = target_len if isinstance(target_len, Column) else F.lit(int(target_len))
    w = Window.partitionBy(*keys).orderBy(index)
    wf = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    i = F.col(index).cast("int")
    nxt = F.lead(i).over(w)
    first = F.min(i).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    filled = [F.last(F.col(c), ignorenulls=True).over(wf).alias(c) for c in value_cols]
    if skew_safe:
        from seqflow.operators.ordering import carried_fill
        rows = df.where(F.col(index).isNotNull()).select(*keys, i.alias("__sf_i"), *value_cols)
        staged = carried_fill(rows, keys, "__sf_i", list(value_cols), "__sf_next", "__sf_first")
    else:
        staged = df.where(F.col(index).isNotNull()).select(
            *keys, i.alias("__sf_i"), nxt.alias("__sf_next"), first.alias("__sf_first"), *filled)
    # slots before the first observed index stay empty (-> 0); slots >= next belong to the next row
    start = F.when(F.col("__sf_i") == F.col("__sf_first"), F.least(F.lit(1), F.col("__sf_i"))).otherwise(
        F.col("__sf_i"))
    end = F.least(F.coalesce(F.col("__sf_next") - 1, t.cast("int")), t.cast("int"))
    head_empty = (F.col("__sf_i") == F.col("__sf_first")) & (F.col("__sf_i") > 1)
    slots = F.when((start <= end) & (start >= 1), F.sequence(F.greatest(start, F.lit(1)), end)).otherwise(
        F.array().cast("array<int>"))
    out = staged.select(*keys, "__sf_i", "__sf_first", *value_cols, F.explode(slots).alias("__sf_slot"))
    vals = []
    for c in value_cols:
        dt = df.schema[c].dataType
        v = F.when(head_empty & (F.col("__sf_slot") < F.col("__sf_i")), F.lit(None)).otherwise(F.col(c))
        if dt.typeName() in ("double", "float", "integer", "long", "short", "byte", "decimal"):
            v = F.coalesce(v, F.lit(0).cast(dt))
        vals.append(v.cast(dt).alias(c))
    return out.select(*keys, F.col("__sf_slot").cast(df.schema[index].dataType).alias(index), *vals)


def exclude_ambiguous(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Op 21: drop rows labelled OK_within_NG (NULL labels kept)."""
    require(df, label)
    return df.where(~F.col(label).eqNullSafe(F.lit(LABEL_AMBIGUOUS)))


def labels_to_binary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Op 22: NG -> 1.0, OK -> 0.0, other -> NULL."""
    require(df, label)
    return df.withColumn(label, label_to_binary(label))


def union_sources(*frames: DataFrame, rank_col: str = "source_rank") -> DataFrame:
    """Op 58: stack frames by column name (missing columns NULL); `source_rank`
    records the input position so that order keys stay total across sources."""
    out = None
    for i, f in enumerate(frames):
        if rank_col not in f.columns:
            f = f.withColumn(rank_col, F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def key_filter(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Op 56: rows whose key is in a key set; a semi join never duplicates rows."""
    return df.join(keys_df.select(*keys), list(keys), "left_semi")


def distinct_groups(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Op 59: distinct (keys, label) rows."""
    return df.select(*cols).distinct()
