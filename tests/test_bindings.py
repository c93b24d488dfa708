"""Bindings join only what a query reads, in one way whatever the input's size."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest

from ledgerlens.plans import bindings as B
from ledgerlens.plans.catalogue import QUERIES

from conftest import SF_SMALL, rows


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def no_broadcasts(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in saved.items():
        spark.conf.set(n, v)


def scans(plan: str) -> list[str]:
    return re.findall(r"Location: [^\n]*?/(\w+)\.parquet", plan)


def test_sales_joins_only_needed_dimensions(spark):
    plan = plan_of(B.sales(spark, SF_SMALL, ["category", "quantity", "sales_amount"]))
    assert sorted(scans(plan)) == ["lineitem", "part"]


def test_pruned_bindings_equal_the_full_ones(spark):
    cols = ["StockCode", "Quantity", "CustomerID"]
    some = B.retail_raw(spark, SF_SMALL, cols)
    assert set(some.columns) == {*cols, *B.RETAIL_KEY}
    assert rows(some, *cols) == rows(B.retail_raw(spark, SF_SMALL), *cols)
    with pytest.raises(ValueError):
        B.retail_raw(spark, SF_SMALL, ["NoSuchColumn"])


def test_customer_patterns_reads_neither_part_nor_nation(spark, no_broadcasts):
    plan = plan_of(QUERIES["customer_patterns"](spark, SF_SMALL))
    assert sorted(scans(plan)) == ["customer", "lineitem", "orders"]


def test_star_join_shuffles_the_fact_twice(spark, no_broadcasts):
    plan = plan_of(QUERIES["star_join"](spark, SF_SMALL))
    assert sorted(scans(plan)) == ["customer", "lineitem", "nation", "orders", "part"]
    # the fact side of both its joins, the other sides of all four, and no more
    assert plan.count("Exchange hashpartitioning") == 8
    assert plan.count("SortMergeJoin") == 4


def test_stored_star_join_shuffles_the_fact_once(spark, no_broadcasts):
    stored = QUERIES["star_join_stored"](spark, SF_SMALL)
    plan = plan_of(stored)
    # lines and orders join as they lie; the lines and the parts move by product
    assert plan.count("SortMergeJoin") == 2
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(moved) == 2 and not any("order_id" in line for line in moved)
    again = QUERIES["star_join_stored"](spark, SF_SMALL)  # a second call leaves the first one's result alone
    assert rows(stored) == rows(again) == rows(QUERIES["star_join"](spark, SF_SMALL))


def test_co_partitioned_keeps_nulls_repeats_and_empty_tables(spark, no_broadcasts):
    from ledgerlens.sources import sinks

    left = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "k int, x string")
    right = spark.createDataFrame([(1, 10), (None, 20)], "k int, y int")
    one, two, none = sinks.co_partitioned([left, right, left.limit(0)], ["k"], "pair", buckets=3)
    assert (rows(one), rows(two), rows(none)) == (rows(left), rows(right), [])
    joined = one.join(two, "k", "left")
    assert "hashpartitioning" not in plan_of(joined)
    assert rows(joined) == rows(left.join(right, "k", "left"))


def test_hot_customer_is_split_by_the_final_plan(spark, no_broadcasts):
    from pyspark.sql import functions as F

    from ledgerlens.operators import retail as R

    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        hot = spark.range(n).select(
            F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("CustomerID"),
            F.col("id").alias("InvoiceNo"), F.sha2(F.col("id").cast("string"), 256).alias("Description"))
        customers = spark.range(0, n).select(F.col("id").alias("CustomerID"), F.lit("X").alias("Country"))
        joined = R.customer_transactions(hot.repartition(4), customers.repartition(4))
        assert joined.count() == n
        out = R.customer_transactions(hot.repartition(4), customers.repartition(4))
        out.write.format("noop").mode("overwrite").save()
        frame = out.select("InvoiceNo", "Description")
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_no_split_counts_or_parallelism_in_the_library():
    top = os.path.dirname(os.path.dirname(os.path.abspath(B.__file__)))
    for folder, _, names in os.walk(top):
        for name in names:
            if name.endswith(".py") and f"{os.sep}llm" not in folder:
                with open(os.path.join(folder, name)) as f:
                    text = f.read()
                assert ".rdd" not in text and "defaultParallelism" not in text, name
