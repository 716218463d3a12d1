"""Fixed-length sequences, group splits and class-balanced resampling.

Row-level chunking keeps the part's hash partitioning, so nesting rows into
ARRAY<ARRAY<DOUBLE>> is a grouped collect of at most T rows per group (bounded by
construction) with no extra exchange. Splits run on the distinct-group table and rank
groups with the skew-safe `ordered_index`, never with a window over the label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqflow.operators.ordering import ordered_index, ordered_sum
from seqflow.operators.prepare import LABEL, PART, PART_INDEX, SUBPART, require

CHUNK, STEP, GROUP_ID = "chunk", "step", "group_id"


def chunk_rows(
    df: DataFrame,
    seq_len: int | Column,
    by: Sequence[str] = (PART, SUBPART),
    order: Sequence[str | Column] = (PART_INDEX,),
    label: str | None = LABEL,
    subpart: str = SUBPART,
) -> DataFrame:
    """Op 63 at row level: number rows per `by` group, cut non-overlapping windows of T
    rows, drop the incomplete tail. Adds `chunk` (0-based), `step` (1..T), and when
    `label` is given the chunk's label and `group_id = part#subpart`, both taken from
    the chunk's last row.

    The row number (not `part_index`, which has gaps after label exclusion or a split)
    defines the windows. The default chunks each (part, subpart) sequence on its own, so a
    sequence longer than T never shifts the chunks of the next one; `by=("part_number",)`
    chunks the part as one stream, as the source system does.
    """
    by = list(by)
    require(df, *by)
    t = seq_len if isinstance(seq_len, Column) else F.lit(int(seq_len))
    w = Window.partitionBy(*by).orderBy(*order)
    whole = Window.partitionBy(*by)
    rn = F.row_number().over(w)
    staged = df.select("*", rn.alias("__sf_rn"), F.count(F.lit(1)).over(whole).alias("__sf_n"),
                       t.cast("long").alias("__sf_t"))
    tc = F.col("__sf_t")
    staged = (staged
              .withColumn(CHUNK, F.floor((F.col("__sf_rn") - 1) / tc).cast("long"))
              .withColumn(STEP, ((F.col("__sf_rn") - 1) % tc + 1).cast("long"))
              .where(F.col(CHUNK) < F.floor(F.col("__sf_n") / tc)))
    out = staged
    if label is not None:
        wc = Window.partitionBy(*by, CHUNK)
        last_label = F.max_by(F.col(label), F.col(STEP)).over(wc)
        last_sub = F.max_by(F.col(subpart), F.col(STEP)).over(wc)
        gid = F.concat_ws("#", F.col(by[0]).cast("string"), last_sub.cast("string"))
        out = out.withColumn(label, last_label).withColumn(GROUP_ID, gid)
    return out.drop("__sf_rn", "__sf_n", "__sf_t")


def nest_sequences(
    chunked: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (PART, SUBPART),
    label: str | None = LABEL,
) -> DataFrame:
    """Op 64 (2-D -> 3-D): one row per (by, chunk) with `features ARRAY<ARRAY<DOUBLE>>`
    ordered by step, plus label and group_id when present."""
    by = list(by)
    require(chunked, *by, CHUNK, STEP, *features)
    step_vec = F.struct(F.col(STEP).alias("s"), F.array(*[F.col(f).cast("double") for f in features]).alias("v"))
    aggs = [F.transform(F.array_sort(F.collect_list(step_vec)), lambda e: e["v"]).alias("features")]
    if label is not None and label in chunked.columns:
        aggs.append(F.first(label).alias(label))
    if GROUP_ID in chunked.columns:
        aggs.append(F.first(GROUP_ID).alias(GROUP_ID))
    return chunked.groupBy(*by, CHUNK).agg(*aggs)


def unnest_sequences(nested: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Op 64 (3-D -> 2-D): one row per step with named feature columns."""
    require(nested, "features")
    ex = nested.select(*[c for c in nested.columns if c != "features"],
                       F.posexplode("features").alias("__sf_pos", "__sf_vec"))
    cols = [F.col(c) for c in nested.columns if c != "features"]
    return ex.select(*cols, (F.col("__sf_pos") + 1).cast("long").alias(STEP),
                     *[F.col("__sf_vec")[i].alias(f) for i, f in enumerate(features)])


def split_fractions(train_size: float, val_size: float) -> tuple[float, float]:
    test_size = 1.0 - train_size - val_size
    if test_size < 0:
        raise ValueError("train_size + val_size cannot exceed 1.0")
    return train_size, val_size / (val_size + test_size)


def group_hash(keys: Sequence[str], seed: int) -> Column:
    """md5 of 'seed#k1#k2...' with keys printed as strings (equal in DuckDB)."""
    return F.md5(F.concat_ws("#", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def uniform(keys: Sequence[str | Column], seed: int | str) -> Column:
    """Reproducible uniform [0, 1) from the first 8 hex digits of md5('seed#keys')."""
    parts = [F.lit(str(seed))] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    h = F.md5(F.concat_ws("#", *parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def split_groups(
    df: DataFrame,
    label: str = LABEL,
    keys: Sequence[str] = (PART, SUBPART),
    train_size: float = 0.75,
    val_size: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Op 65 on groups: one row per group (keys, label, split).

    A group takes one label (the max; D14), so all its rows land in one split. Per
    label, groups are ordered by md5(seed#keys); the first floor(n * train_size) go to
    train, the first floor(rest * val / (val + test)) of the rest to val, the others to
    test. Quotas are exact per label; membership is reproducible across engines.
    """
    keys = list(keys)
    require(df, label, *keys)
    p_train, p_val = split_fractions(train_size, val_size)
    groups = df.groupBy(*keys).agg(F.max(label).alias(label)).withColumn("__sf_h", group_hash(keys, seed))
    ranked = ordered_index(groups, ["__sf_h", *keys], [label], name="__sf_rank", bounded_keys=True)
    # per-label totals, read off the numbered (written) rows instead of re-running the
    # upstream plan
    totals = _class_counts(ranked, label, "__sf_total")
    j = ranked.join(totals, ranked[label].eqNullSafe(totals[label]), "inner").drop(totals[label])
    n_train = F.floor(F.col("__sf_total") * F.lit(p_train))
    n_val = F.floor((F.col("__sf_total") - n_train) * F.lit(p_val))
    split = (F.when(F.col("__sf_rank") <= n_train, F.lit("train"))
             .when(F.col("__sf_rank") <= n_train + n_val, F.lit("val"))
             .otherwise(F.lit("test")))
    return j.select(*keys, label, split.alias("split"))


def assign_split(df: DataFrame, groups: DataFrame, which: str, keys: Sequence[str] = (PART, SUBPART)) -> DataFrame:
    """Rows of one split: semi join on the group keys (no row duplication)."""
    sel = groups.where(F.col("split") == which).select(*keys)
    return df.join(sel, list(keys), "left_semi")


def with_split(df: DataFrame, groups: DataFrame, label: str = LABEL, keys: Sequence[str] = (PART, SUBPART), seed: int = 42) -> DataFrame:
    """Adds `split` to the rows of `df`, one per group, from the `split_groups` of these rows with the same keys and seed;
    rows with a NULL key are left out, as by a join on the keys.

    Wide rows stay where they are, so a task holds a split of the scan whatever the number of shuffle partitions: a label's
    groups lie in the order of (hash, keys), train first, then val, so each label's last group of train and of val decide.
    They are a row per label, broadcast by name."""
    keys = list(keys)
    require(df, label, *keys)
    at = F.struct(group_hash(keys, seed).alias("h"), *[F.col(k) for k in keys])
    last = groups.groupBy(label).agg(*[F.max(F.when(F.col("split") == s, at)).alias(f"__sf_{s}") for s in ("train", "val")])
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    j = known.join(F.broadcast(last), known[label].eqNullSafe(last[label]), "inner").drop(last[label])
    split = F.when(at <= F.col("__sf_train"), "train").when(at <= F.col("__sf_val"), "val").otherwise("test")
    return j.withColumn("split", split).drop("__sf_train", "__sf_val")


def _class_counts(df: DataFrame, label: str, name: str = "__sf_cnt") -> DataFrame:
    """Rows per class: a row for each of a label's few values, broadcast by name. Left to AQE, a join on so few keys is
    not broadcast (most of its partitions are empty), and every row of a class meets in one task."""
    return F.broadcast(df.groupBy(label).agg(F.count(F.lit(1)).alias(name)))


def class_weights(df: DataFrame, label: str = LABEL, name: str = "weight") -> DataFrame:
    """Op 38: weight = 1 / count(rows of the same class). Class counts are a partial
    aggregate, broadcast and joined back; the rows stay where they are."""
    require(df, label)
    counts = _class_counts(df, label)
    j = df.join(counts, df[label].eqNullSafe(counts[label]), "inner").drop(counts[label])
    return j.withColumn(name, 1.0 / F.col("__sf_cnt")).drop("__sf_cnt")


def resample_balanced(
    df: DataFrame,
    keys: Sequence[str],
    label: str = LABEL,
    num_samples: int | Column | None = None,
    seed: int = 42,
) -> DataFrame:
    """Op 66: class-balanced draws with replacement, as expected-count replication.

    With class weights 1/n_c and N draws (default: number of rows), a row's expected
    copies are e = N / (K * n_c), K = classes present. Each row is copied
    floor(e) + (u < frac(e)) times, u a reproducible uniform of its key, and gets
    `copy` = 1..copies. Totals per class match N/K in expectation; no driver loop.
    """
    keys = list(keys)
    require(df, label, *keys)
    # one class-count aggregate gives the weights, the number of rows N and the number of
    # classes K; Spark reuses its exchange
    counts = _class_counts(df, label)
    n_rows = counts.select(F.sum("__sf_cnt")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    n_draws = (num_samples if isinstance(num_samples, Column)
               else F.lit(int(num_samples)) if num_samples is not None else n_rows)
    c = counts
    w = df.join(c, df[label].eqNullSafe(c[label]), "inner").drop(c[label])
    e = (1.0 / F.col("__sf_cnt")) * n_draws / k
    copies = (F.floor(e) + F.when(uniform(keys, seed) < (e - F.floor(e)), 1).otherwise(0)).cast("int")
    out = w.withColumn("__sf_copies", copies).where(F.col("__sf_copies") > 0).drop("__sf_cnt")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__sf_copies")))).drop("__sf_copies")


WEIGHT_UNITS = 1 << 44  # units of the largest weight; rows * draws may be up to 10**38 / 2**45


def resample_exact(
    df: DataFrame,
    keys: Sequence[str],
    num_samples: int,
    label: str | None = LABEL,
    weight: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """Op 66 with exactly `num_samples` draws: systematic sampling with replacement.

    The rows, in the order of their label and then of a seeded hash of their unique `keys`, lie on a line, each as long as its
    weight (default: one over its class's rows); draws are N equally spaced points, and a row is copied once for each
    point that falls on it. Copies sum to N for any N, a row gets its expected number up to one more or less, and so does a
    class. The line is a distributed prefix sum in whole units (`ordered_sum`), so no point is lost or counted twice
    between tasks. Weights that are NULL, NaN or not positive give no copies; adds `copy` = 1..copies.
    """
    keys = list(keys)
    n = int(num_samples)
    require(df, *keys, *([label] if label else []), *([weight] if weight else []))
    if n < 0:
        raise ValueError("num_samples must not be negative")
    if weight is None:
        if label is None:
            raise ValueError("a label or a weight is needed")
        df_w = class_weights(df, label, "__sf_w")
    else:
        df_w = df.withColumn("__sf_w", F.col(weight).cast("double"))
    w = F.col("__sf_w")
    df_w = df_w.withColumn("__sf_w", F.when(~F.isnan(w) & (w > 0), w).otherwise(F.lit(0.0)))
    top = df_w.select(F.max("__sf_w")).scalar()
    units = F.coalesce(F.floor(w / F.when(top > 0, top) * F.lit(float(WEIGHT_UNITS))), F.lit(0)).cast("decimal(38,0)")
    line = df_w.withColumn("__sf_u", units).withColumn("__sf_h", group_hash(keys, seed))
    summed = ordered_sum(line, "__sf_u", [*([label] if label else []), "__sf_h", *keys], "__sf_c")
    total = summed.select(F.max("__sf_c")).scalar()
    # points lie at (k + 1/2) * total / N; (2 * N * x + total) div (2 * total) of them lie before x
    c, u, t = F.col("__sf_c"), F.col("__sf_u"), F.col("__sf_t")
    two_n = F.lit(2 * n).cast("decimal(38,0)")
    staged = summed.withColumn("__sf_t", total)
    staged = staged.withColumn("__sf_a", (two_n * (c - u) + t).cast("decimal(38,0)")).withColumn("__sf_b", (two_n * c + t).cast("decimal(38,0)"))
    copies = F.when(t > 0, F.expr("(__sf_b div (2 * __sf_t)) - (__sf_a div (2 * __sf_t))")).otherwise(F.lit(0))
    out = staged.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies.cast("int"))).otherwise(F.array().cast("array<int>"))))
    return out.select(*df.columns, "copy")
