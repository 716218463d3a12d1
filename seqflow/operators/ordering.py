"""Order-dependent positions that do not put a whole group into one task.

A window `row_number().over(partitionBy(k).orderBy(o))` sends every row of a key to one
task. For keys that can be hot (a label with two values, the whole table for a global row
index, a raw source key before any length filter) we number rows the way a Spark user
numbers a sorted dataset: range-partition on (k, o) so a hot key is cut into many
partitions, count rows per (partition, key), turn the counts into offsets on that small
table, and add the local position. Work is two scans of the data and one shuffle; the
offsets table has at most (partitions + keys) rows. The numbered rows are written once
(as Parquet, under `spark.checkpoint.dir`), so both uses see the same numbering.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqflow.session import scratch_path

_PID, _POS, _CNT, _FIRST, _OFF = "__sf_pid", "__sf_pos", "__sf_cnt", "__sf_first", "__sf_off"


def ordered_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    name: str = "idx",
    num_partitions: int | None = None,
    bounded_keys: bool = False,
) -> DataFrame:
    """Add `name`: 1-based LONG position of each row inside its `partition_by` group.

    `order_by` must be unique within a group (add tie breakers), so the result is
    deterministic and survives task re-execution.

    `bounded_keys=True` states that `partition_by` has a small, fixed number of values
    (for example a binary label); the offsets table is then bounded by
    partitions x keys and is broadcast. Otherwise it is joined by a shuffle on
    (partition id, key), which still spreads a hot key over all its partitions.
    """
    keys = list(partition_by)
    ranged = _ranged(df, order_by, keys, num_partitions)
    stats = ranged.groupBy(_PID, *keys).agg(F.count(F.lit(1)).alias(_CNT), F.min(_POS).alias(_FIRST))
    w = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(_PID, *keys, _FIRST, F.coalesce(F.sum(_CNT).over(w), F.lit(0)).alias(_OFF))
    if bounded_keys or not keys:
        offsets = F.broadcast(offsets)
    joined = _with_block(ranged, offsets, keys)
    idx = F.col(f"__sf_o.{_OFF}") + F.col(f"__sf_r.{_POS}") - F.col(f"__sf_o.{_FIRST}") + 1
    cols = [F.col(f"__sf_r.`{c}`") for c in df.columns]
    return joined.select(*cols, idx.cast("long").alias(name))


def _ranged(df: DataFrame, order_by: Sequence[str | Column], keys: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Rows sorted by (keys, order) and cut into ranges, with the range's number and the position in it."""
    # Without an explicit count the range exchange uses spark.sql.shuffle.partitions and AQE
    # may coalesce neighbouring ranges (still contiguous and ordered); size the shuffle
    # partitions to the data, or pass num_partitions.
    parts = (num_partitions,) if num_partitions else ()
    ranged = (
        df.repartitionByRange(*parts, *keys, *order_by)
        .sortWithinPartitions(*keys, *order_by)
        .withColumn(_PID, F.spark_partition_id())
        # monotonically_increasing_id = (partition << 33) + position in partition
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    )
    # The partition id and position must be the same values in all uses. Two executions of a
    # range exchange may cut ranges differently (column pruning can stop exchange reuse), so the
    # numbered rows are written once; as Parquet, of which the offsets read only the few columns they need.
    path = scratch_path(df.sparkSession, f"ranged-{uuid.uuid4().hex}")
    ranged.write.parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)


def _with_block(ranged: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (`__sf_r`) joined with the row of their (range, keys) in `blocks` (`__sf_o`)."""
    r, o = ranged.alias("__sf_r"), blocks.alias("__sf_o")
    cond = F.col(f"__sf_r.{_PID}") == F.col(f"__sf_o.{_PID}")
    for k in keys:
        cond = cond & F.col(f"__sf_r.`{k}`").eqNullSafe(F.col(f"__sf_o.`{k}`"))
    return r.join(o, cond, "inner")


def ordered_sum(df: DataFrame, value: str, order_by: Sequence[str | Column], name: str = "prefix_sum", num_partitions: int | None = None) -> DataFrame:
    """Add `name`: the sum of `value` over all rows up to and including this one, in the given order (unique).

    Running sums inside the ranges, and one offset per range from the ranges' totals. With a decimal `value` the sums
    are exact, so neighbouring rows' sums differ by exactly the row's value."""
    ranged = _ranged(df, order_by, [], num_partitions)
    local = F.sum(value).over(Window.partitionBy(_PID).orderBy(_POS))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(_PID).agg(F.sum(value).alias(_CNT))
    offsets = F.broadcast(totals.select(_PID, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF)))  # a row per range
    kind = df.schema[value].dataType
    joined = _with_block(ranged.withColumn("__sf_local", local), offsets, [])
    return joined.select(*[F.col(f"__sf_r.`{c}`") for c in df.columns], (F.col("__sf_r.__sf_local") + F.col(f"__sf_o.{_OFF}")).cast(
        "decimal(38,0)" if kind.typeName() == "decimal" else kind).alias(name))


def carried_fill(df: DataFrame, keys: Sequence[str], order: str, value_cols: Sequence[str], next_name: str, first_name: str) -> DataFrame:
    """`value_cols` filled with the last value that is not NULL up to the row, in `order` inside each `keys` group of any
    size; `next_name`: the order value of the group's next row, `first_name`: of its first.

    Fill and successor are found inside (range, keys) blocks; what a block takes over from those before it (its carry)
    and the first order value after it come from a table of one row per block."""
    keys = list(keys)
    ranged = _ranged(df, [order, *[c for c in value_cols if c != order]], keys)
    w = Window.partitionBy(_PID, *keys).orderBy(_POS)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", F.lead(order).over(w).alias("__sf_local_next"),
                          *[F.last(F.col(c), ignorenulls=True).over(upto).alias(f"__sf_fill_{i}") for i, c in enumerate(value_cols)])
    blocks = ranged.groupBy(_PID, *keys).agg(F.min(order).alias("__sf_lo"), *[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_POS))).alias(f"__sf_last_{i}") for i, c in enumerate(value_cols)])
    g = Window.partitionBy(*keys).orderBy(_PID)
    earlier, whole = g.rowsBetween(Window.unboundedPreceding, -1), g.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(_PID, *keys, F.lead("__sf_lo").over(g).alias("__sf_after"), F.min("__sf_lo").over(whole).alias("__sf_begin"),
                           *[F.last(F.col(f"__sf_last_{i}"), ignorenulls=True).over(earlier).alias(f"__sf_carry_{i}") for i in range(len(value_cols))])
    joined = _with_block(local, blocks, keys)
    cols = [F.coalesce(F.col(f"__sf_r.__sf_fill_{value_cols.index(c)}"), F.col(f"__sf_o.__sf_carry_{value_cols.index(c)}")).alias(c)
            if c in value_cols else F.col(f"__sf_r.`{c}`") for c in df.columns]
    return joined.select(*cols, F.coalesce(F.col("__sf_r.__sf_local_next"), F.col("__sf_o.__sf_after")).alias(next_name),
                         F.col("__sf_o.__sf_begin").alias(first_name))


def add_row_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "row_index",
) -> DataFrame:
    """Dense 0-based global row order (persisted row order) without a global window."""
    return (
        ordered_index(df, order_by, (), name=name)
        .withColumn(name, F.col(name) - 1)
    )


def sort_by_row_index(df: DataFrame, descending: bool = False, name: str = "row_index") -> DataFrame:
    """Total order on the row index (range partitioned sort, never a collect)."""
    c = F.col(name)
    return df.orderBy(c.desc() if descending else c.asc())


def write_ordered(df: DataFrame, path: str, mode: str = "overwrite", name: str = "row_index",
                  fmt: str = "parquet") -> None:
    """Write so that files hold contiguous, sorted `row_index` ranges."""
    (df.repartitionByRange(name).sortWithinPartitions(name)
       .write.mode(mode).format(fmt).save(path))


def read_ordered(spark, path: str, name: str = "row_index", fmt: str = "parquet") -> DataFrame:
    """Read back in ascending `row_index` order; an empty table gives an empty frame."""
    return spark.read.format(fmt).load(path).orderBy(name)
