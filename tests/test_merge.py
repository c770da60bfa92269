import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.merge import drop_known, first_per_key, insert_only_merge, keep_listed, keep_new
from millrace.operators.pending import distinct_keys
from millrace.session import stage
from millrace.sources.tables import append, ensure_table, merge_into

DDL = "k string, page int, points int"


def test_first_write_wins(spark):
    target = spark.createDataFrame([("a", 1, 10)], DDL)
    source = spark.createDataFrame([("a", 1, 20), ("b", 1, 5)], DDL)
    merge = insert_only_merge(source, target, ["k"])
    assert rows(merge.inserts) == [("b", 1, 5)]
    assert rows(merge.merged) == [("a", 1, 10), ("b", 1, 5)]


def test_copies_within_one_source_all_go_in_unless_deduped(spark):
    target = spark.createDataFrame([], DDL)
    source = spark.createDataFrame([("a", 2, 7), ("a", 1, 5), ("b", 1, 1)], DDL)
    assert len(rows(insert_only_merge(source, target, ["k"]).inserts)) == 3
    deduped = insert_only_merge(source, target, ["k"], dedupe_by=["page"]).inserts
    assert rows(deduped) == [("a", 1, 5), ("b", 1, 1)]


def test_null_keys_go_in_again_unless_rejected(spark):
    target = spark.createDataFrame([(None, 1, 1)], DDL)
    source = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 1)], DDL)
    assert len(rows(insert_only_merge(source, target, ["k"]).inserts)) == 3
    kept = insert_only_merge(source, target, ["k"], reject_null_keys=True).inserts
    assert rows(kept) == [("a", 1, 1)]


def test_a_null_in_part_of_a_key_never_matches(spark):
    target = spark.createDataFrame([("a", None, 1), ("a", 1, 1)], DDL)
    source = spark.createDataFrame([("a", None, 2), ("a", 1, 2), ("a", 2, 2)], DDL)
    merge = insert_only_merge(source, target, ["k", "page"])
    assert rows(merge.inserts) == [("a", 2, 2), ("a", None, 2)]


def test_first_per_key_keeps_null_keyed_rows(spark):
    df = spark.createDataFrame([("a", 2, 0), ("a", 1, 0), (None, 1, 0), (None, 1, 0)], DDL)
    assert rows(first_per_key(df, ["k"], ["page"])) == [("a", 1, 0), (None, 1, 0), (None, 1, 0)]


def test_keep_listed(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 1, 0), (None, 1, 0)], DDL)
    listed = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    assert rows(keep_listed(df, listed, ["k"])) == [("a", 1, 0), ("a", 2, 0)]


def _hot(spark, n=60_000):
    """A third of the rows has one key, and another third none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(0, n, 1, 4).select(key.alias("k"), "id", F.repeat(F.lit("x"), 50).alias("body"))


def test_few_known_keys_are_broadcast_and_wide_rows_not_shuffled(spark, executed):
    rows_, known = _hot(spark), spark.range(1, 100).select(F.col("id").alias("k"))
    df = drop_known(rows_, known, ["k"])
    plan = executed(df)
    assert "BroadcastHashJoin" in plan and "hashpartitioning(k" not in plan.replace("hashpartitioning(id", "")[: plan.index("BroadcastHashJoin")]
    assert df.count() == 60_000 - 33 and df.columns == rows_.columns


def test_building_a_merge_starts_no_job(spark):
    rows_, known = _hot(spark), spark.range(1, 100).select(F.col("id").alias("k"))
    spark.sparkContext.setJobGroup("merge-plan", "merge plan")
    merge = insert_only_merge(rows_, known.selectExpr("k", "k AS id", "'' AS body"), ["k"], dedupe_by=["id"])
    assert merge.merged.columns == ["k", "id", "body"]
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("merge-plan")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_repeated_batch_is_joined_to_its_few_new_keys(spark, conf, executed):
    conf(spark__sql__autoBroadcastJoinThreshold="20KB")
    rows_, known = _hot(spark), spark.range(0, 59_000).select(F.col("id").alias("k"))
    df = keep_new(rows_, known, ["k"], rows_)
    plan = executed(df)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    new = sum(1 for i in range(59_000, 60_000) if i % 3 == 1)
    assert df.columns == rows_.columns
    assert df.where("k IS NULL").count() == 20_000
    assert df.where("k IS NOT NULL").count() == new


def test_keys_that_were_not_looked_at_stay_out(spark):
    rows_ = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("late", 1, 1), (None, 1, 1)], DDL)
    seen = spark.createDataFrame([("a",), ("b",)], "k string")
    known = spark.createDataFrame([("a", 9, 9)], DDL)
    assert rows(insert_only_merge(rows_, known, ["k"], batch_keys=seen).inserts) == [("b", 1, 1), (None, 1, 1)]


def test_the_first_row_per_key_takes_one_pass(spark, executed):
    df = first_per_key(spark.range(0, 1000, 1, 4).selectExpr("id % 7 AS k", "id"), ["k"], ["id"])
    plan = executed(df)
    assert plan.count("Range (0, 1000") == plan.count("WindowGroupLimit [") // 2 or plan.count("Union") == 0
    assert "Union" not in plan and df.count() == 7


def test_a_small_batch_is_broadcast_to_the_known_keys(spark):
    known = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    batch = stage(spark.range(50).select(F.col("id").alias("l_orderkey")))
    seen = distinct_keys(known, "l_orderkey").join(batch, "l_orderkey", "left_semi")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    # the known keys are cut by the join before their aggregate shuffles them
    assert plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_either_list_gives_the_same_rows(spark):
    keys = [1, 1, 2, 3, 4, None, None]
    rows_ = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    for known in ([1], [1, 2, 3], [1, 2, 3, 4], [9], [None]):
        df = drop_known(rows_, spark.createDataFrame([(k,) for k in known], "k int"), ["k"])
        assert rows(df) == sorted(
            [(k, i) for i, k in enumerate(keys) if k is None or k not in known], key=repr
        )
        listed = keep_listed(rows_, spark.createDataFrame([(k,) for k in known], "k int"), ["k"])
        assert rows(listed) == [(k, i) for i, k in enumerate(keys) if k is not None and k in known]


def test_hot_keys_are_split_when_the_known_keys_are_too_many_to_broadcast(spark, conf, executed):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions="16",
    )
    rows_, known = _hot(spark), spark.range(1, 100).select(F.col("id").alias("k"))
    df = drop_known(rows_, known, ["k"])
    assert "SortMergeJoin(skew=true)" in executed(df)
    assert df.count() == 60_000 - 33


def test_merge_into_counts_what_it_writes(spark, schema):
    table = f"{schema}.t"
    ensure_table(spark, table, DDL)
    source = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), ("b", 2, 21)], DDL)
    assert merge_into(source, table, ["k"]) == 3
    assert merge_into(source, table, ["k"]) == 0
    more = spark.createDataFrame([("b", 9, 9), ("c", 9, 9)], DDL)
    assert merge_into(more, table, ["k"]) == 1
    assert rows(spark.table(table)) == [("a", 1, 10), ("b", 1, 20), ("b", 2, 21), ("c", 9, 9)]


def test_merge_into_goes_by_column_name_and_ignores_others(spark, schema):
    table = f"{schema}.t"
    ensure_table(spark, table, DDL)
    source = spark.createDataFrame([(7, "x", "a", 1)], "points bigint, other string, k string, page int")
    assert merge_into(source, table, ["k"]) == 1
    assert rows(spark.table(table)) == [("a", 1, 7)]
    with pytest.raises(Exception, match="points"):
        append(source.drop("points"), table)


def test_merge_into_of_nothing(spark, schema):
    ensure_table(spark, f"{schema}.t", DDL)
    assert merge_into(spark.createDataFrame([], DDL), f"{schema}.t", ["k"]) == 0


def test_a_column_that_is_always_null_is_legal(spark, schema):
    ensure_table(spark, f"{schema}.t", DDL)
    assert merge_into(spark.createDataFrame([("a", None, None)], DDL), f"{schema}.t", ["k"]) == 1


def test_a_bucketed_table_is_joined_without_a_shuffle_of_it(spark, schema, conf):
    from millrace.operators.pending import pending_keys

    table = f"{schema}.t"
    ensure_table(spark, table, DDL, bucket_by=(["k"], 4))
    source = spark.range(0, 1000, 1, 4).selectExpr("cast(id as string) AS k", "1 AS page", "1 AS points")
    assert merge_into(source, table, ["k"], rebalance_by=["k"]) == 1000
    assert merge_into(source, table, ["k"], rebalance_by=["k"]) == 0
    files = {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}
    assert len(files) == 4
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    pending = pending_keys(source.selectExpr("concat(k, '0') AS k"), spark.table(table), "k")
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert pending.count() == 1000 - 99  # 10, 20 .. 990 are in the table; '00' is not


def test_partitioned_table(spark, schema):
    table = f"{schema}.t"
    ensure_table(spark, table, "k string, v int, _region string", partition_by=["_region"])
    source = spark.createDataFrame([("a", "KR", 1), ("b", "JP1", 2)], "k string, _region string, v int")
    assert merge_into(source, table, ["k", "_region"]) == 2
    assert merge_into(source, table, ["k", "_region"]) == 0
    assert rows(spark.table(table).where("_region = 'KR'")) == [("a", 1, "KR")]
