"""Micro-batch key cuts: exact rows, range pushed to the scan, fallback above the bound."""

from pyspark.sql import functions as F

from payflux.operators.enrich import key_filter, restrict_to_keys


def test_key_filter_cuts_to_batch_keys(spark):
    table = spark.range(1000).select(F.col("id").alias("_txnID"), (F.col("id") * 2).alias("v"))
    keys = spark.createDataFrame([(5,), (7,), (7,), (None,), (990,)], "_txnID long")
    got = sorted(r["_txnID"] for r in restrict_to_keys(table, keys, "_txnID").collect())
    assert got == [5, 7, 990]
    plan = restrict_to_keys(table, keys, "_txnID")._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 5" in plan and "<= 990" in plan  # the batch's key range reaches the scan side


def test_key_filter_string_keys_and_fallback(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "_key string, x int")
    keys = spark.createDataFrame([("b",), ("z",)], "k string")
    assert [r["_key"] for r in key_filter(keys)(table, "_key").collect()] == ["b"]
    # more keys than the bound: the table passes unchanged (the join shuffles instead)
    assert key_filter(keys, max_rows=1)(table, "_key").count() == 3
