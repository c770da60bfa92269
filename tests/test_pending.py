from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.pending import distinct_keys, pending_keys

ORDERS = "/root/testdata/sf0.01/orders.parquet"
LINES = "/root/testdata/sf0.01/lineitem.parquet"


def test_null_keys_stay_pending(spark):
    keys = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    landed = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(pending_keys(keys, landed, "k")) == [(2,), (None,)]


def test_filter_applies_to_the_keys_only(spark):
    keys = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "k int, t string")
    landed = spark.createDataFrame([(1, "b")], "k int, t string")
    assert rows(pending_keys(keys, landed, "k", F.col("t") == "a")) == [(3,)]
    assert rows(distinct_keys(keys, ["k"], F.col("t") == "b")) == [(2,)]


def test_only_key_columns_are_read_and_filters_reach_the_scan(spark):
    orders = spark.read.parquet(ORDERS)
    lines = spark.read.parquet(LINES).withColumnRenamed("l_orderkey", "o_orderkey")
    df = pending_keys(orders, lines, "o_orderkey", F.col("o_orderstatus") == "F")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "EqualTo(o_orderstatus,F)" in plan


def test_copies_collapse_before_the_shuffle_and_no_exchange_is_added(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    orders = spark.read.parquet(ORDERS).withColumnRenamed("o_custkey", "k")
    lines = spark.read.parquet(LINES).withColumnRenamed("l_suppkey", "k")
    plan = pending_keys(orders, lines, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    # a partial aggregate below each exchange, a final one above
    assert plan.count("HashAggregate(") == 4
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate(")
