"""Physical plan checks: one exchange for the windowed chain, pushdown, no Python UDFs."""

import pytest

from seqflow import catalog as C
from seqflow.operators import features as FE
from seqflow.sources import fixtures as FX

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prepare_and_features_one_big_exchange(spark):
    df = FE.add_all_features(C.prepared_train(spark, SF_SMALL))
    lines = [ln for ln in plan(df).split("\n") if "Exchange" in ln]
    hash_ex = [ln for ln in lines if "Exchange hashpartitioning" in ln]
    # the measurement rows are shuffled once, on part_number; every window reuses it
    assert sum("REPARTITION_BY_COL" in ln for ln in hash_ex) == 1
    assert all("hashpartitioning(part_number#" in ln for ln in hash_ex)
    # the other exchanges carry partial aggregates (per-sequence and per-part counts, in the
    # main plan and in the padding-length subquery), never the measurement rows
    others = [ln for ln in hash_ex if "REPARTITION_BY_COL" not in ln]
    assert all("ENSURE_REQUIREMENTS" in ln for ln in others) and len(others) <= 5
    text = plan(df)
    assert "SortMergeJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_filter_and_columns_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    df = FX.measurements(spark, SF_SMALL).where(F.col("first_param") > 10).select("part_number", "first_param")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in text


def test_no_python_in_native_queries(spark):
    for name in ("feature_set", "split_groups", "chunk_sequences", "scaler_apply", "best_epoch", "ingest_job"):
        text = plan(C.QUERIES[name](spark, SF_SMALL))
        assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text, name


def test_no_window_over_the_label_alone(spark):
    from seqflow.operators import sequences as SQ
    df = C.prepared_train(spark, SF_SMALL)
    text = plan(SQ.split_groups(df))
    # the label is a partition key only of the small offsets window, never of a window over the groups
    for line in text.split("\n"):
        if "Window [" in line and "row_number()" in line:
            assert "windowspecdefinition(subpart_label" not in line


def test_prepare_windows_keyed_by_part(spark):
    df = FE.add_all_features(C.prepared_train(spark, SF_SMALL))
    for line in plan(df).split("\n"):
        if "Window [" in line and "__sf_c" not in line:
            assert "windowspecdefinition(part_number#" in line, line[:200]


def test_global_row_index_has_no_single_partition_window(spark):
    from seqflow.operators.ordering import add_row_index
    df = add_row_index(FX.measurements(spark, SF_SMALL), ["part_number", "subpart_no", *FX.MEASUREMENT_ORDER])
    text = plan(df)
    assert "row_number()" not in text          # positions come from the range numbering, not a window
    assert "BroadcastExchange" in text         # the offsets table (one row per range partition) is broadcast


def test_incremental_filter_pushed_to_parquet(spark, tmp_dir):
    from seqflow.sources import json_source as J
    FX.json_source(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw")
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    text = plan(J.extract_measurements(J.unnest_json(J.incremental_filter(raw, 896659200000))))
    assert "GreaterThan(ts,896659200000)" in text


def test_bucketed_source_needs_no_exchange(spark):
    from pyspark.sql import functions as F

    from seqflow.plans.prepare import prepare_job
    source = C.bucketed_source(spark, SF_SMALL, buckets=5)
    options = dict(order_by=FX.MEASUREMENT_ORDER, mode="score", n_subparts=C.K_SUBPARTS, steps=C.STEPS, target_len=90)
    df = FE.add_all_features(prepare_job(source, co_located=True, **options))
    text = plan(df)
    assert "Exchange" not in text and "SelectedBucketsCount: 5 out of 5" in text
    # and the summary per part that follows needs none either
    assert "Exchange" not in plan(df.groupBy("part_number").agg(F.count(F.lit(1)).alias("n")))
    plain = prepare_job(C.labelled(spark, SF_SMALL), **options)
    both = [sorted(map(tuple, d.select("part_number", "subpart_no", "subpart_index", "part_index", "first_param").collect()), key=repr)
            for d in (prepare_job(source, co_located=True, **options), plain)]
    assert both[0] == both[1] and both[0]


def test_bucketed_hot_key_and_defined_cases(spark):
    import uuid

    import pytest

    from seqflow.plans.prepare import prepare_job
    from seqflow.sources.tables import write_bucketed
    rows = [(7, i) for i in range(3000)] + [(None, 1), (None, 2)] + [(i, 0) for i in range(50)]
    name = f"seqflow_hot_{uuid.uuid4().hex}"
    df = spark.createDataFrame(rows, "k long, v long")
    got = write_bucketed(df, name, ["k"], 4, ["k", "v"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)
    assert "Exchange" not in plan(got.groupBy("k").count())
    assert dict(map(tuple, got.groupBy("k").count().collect()))[7] == 3001
    assert write_bucketed(df.where("v < 0"), f"{name}_empty", ["k"], 4).count() == 0
    with pytest.raises(ValueError):
        write_bucketed(df, name, ["k"], 0)
    with pytest.raises(ValueError):
        prepare_job(df, df, order_by=["v"], co_located=True)


def test_no_row_is_dealt_by_its_class(spark):
    """Wide rows are joined with class counts where they lie, also where sizes are not known (checkpointed rows): dealt
    by the label, all rows of a class would meet in one task."""
    from pyspark.sql import functions as F

    from seqflow.operators import sequences as SQ
    from seqflow.session import materialize
    rows = spark.range(0, 4000, 1, 8).select("id", F.col("id").cast("string").alias("part_number"), F.lit(1.0).alias("subpart_no"),
                                             F.when(F.col("id") % 9 > 0, F.col("id") % 2).cast("double").alias("subpart_label"))
    df = materialize(rows)
    for out in (SQ.class_weights(df), SQ.resample_balanced(df, ["id"]), SQ.split_groups(df)):
        text = plan(out)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    weights = materialize(SQ.class_weights(df))
    held = weights.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(held) == 8 and max(r["n"] for r in held) == 500
    by_class = {r["subpart_label"]: r["s"] for r in weights.groupBy("subpart_label").agg(F.sum("weight").alias("s")).collect()}
    assert set(by_class) == {0.0, 1.0, None} and all(abs(s - 1) < 1e-9 for s in by_class.values())


def test_numbered_rows_are_read_by_column(spark):
    """Of the numbered rows, the offsets read the range and the position only, not whole rows as from a checkpoint."""
    from seqflow.operators.ordering import add_row_index
    df = add_row_index(spark.range(0, 500).selectExpr("id", "repeat('x', 50) AS wide"), ["id"])
    scans = [x for x in plan(df).split("\n") if "ReadSchema" in x]
    assert len(scans) == 2 and sum("wide" not in x.split("ReadSchema")[1] for x in scans) == 1
    assert [r["row_index"] for r in df.orderBy("id").collect()] == list(range(500))


def test_json_source_and_lookups_once(spark, tmp_dir):
    """Rows are exchanged before they are collected, and an element's value is looked up once."""
    from seqflow.sources import json_source as J
    text = plan(FX.json_source(spark, SF_SMALL))
    assert text.index("Exchange hashpartitioning") > text.rindex("collect_list(")  # below both steps of the aggregate
    FX.json_source(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw")
    text = plan(J.extract_measurements(J.unnest_json(spark.read.parquet(f"{tmp_dir}/raw"))))
    assert text.count("try_variant_get(") == len(J.KEY_MAP)


def test_sequences_get_their_split_where_they_lie(spark, tmp_dir):
    """The wide rows are not shuffled for their split, also where the groups are too many to broadcast: a task of a fit holds
    a split of the files, and not one of the shuffle partitions."""
    from pyspark.sql import functions as F

    from seqflow.operators import sequences as SQ
    n = F.col("id") % 602  # 20 parts of 7 x 86 rows
    spark.range(20 * 602).select(
        "id", F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), F.floor(F.col("id") / 602).alias("l_suppkey"), (n % 7 + 1).cast("int").alias("l_linenumber"),
        *[(F.col("id") * k % 97).cast("double").alias(c) for k, c in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), 3)],
        F.timestamp_seconds(n * 86400).alias("l_shipdate")).write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        data = C._nested_with_split(spark, tmp_dir)
        text = plan(data.select("part_number", "features", "split"))
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
        wide = [x for x in text.split("FileScan parquet")[1:] if x.split("]")[0].count("features")]
        assert len(wide) == 1  # read from the files by the consumer itself
        rows = data.select("part_number", "chunk", "subpart_label", "split").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert len(rows) >= 20
    groups = SQ.split_groups(data, keys=("part_number", "chunk"), train_size=0.75, val_size=0.1)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, groups.select("part_number", "chunk", "subpart_label", "split").collect()))


@pytest.mark.parametrize("n", [0, 1, 3, 400])
def test_split_by_the_last_groups_equals_the_join(spark, n):
    """Labels that are NULL, or with too few groups for a train or val part, and NULL keys."""
    from pyspark.sql import functions as F

    from seqflow.operators import sequences as SQ
    df = spark.range(n).select(F.when(F.col("id") % 11 > 0, F.col("id").cast("string")).alias("p"), (F.col("id") % 3).alias("c"),
                               F.when(F.col("id") % 7 == 0, 1.0).when(F.col("id") % 50 < 40, 0.0).when(F.col("id") == 41, 2.0).alias("l"))
    df = df.dropDuplicates(["p", "c"]).localCheckpoint()
    for sizes in ((0.75, 0.1), (0.0, 0.5), (0.4, 0.0)):
        groups = SQ.split_groups(df, "l", ["p", "c"], *sizes)
        got = SQ.with_split(df, groups, "l", ["p", "c"]).select("p", "c", "l", "split").collect()
        want = df.join(groups.select("p", "c", "split"), ["p", "c"]).select("p", "c", "l", "split").collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))
