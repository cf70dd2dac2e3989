"""Generators: numbering stays exact and balanced when one instant is hot."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from payflux.operators.generate import running_count


def test_running_count_hot_instant(spark):
    # a third of all rows share one timestamp
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("t"), F.col("id").alias("c"))
    r = running_count(df, "t", "c", "count", partitions=6)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("t", "c")))
    assert r.join(want, ["t", "c"]).filter("rn != count").count() == 0
    assert r.count() == 60000
    # the hot instant is spread over several partitions, not one task
    sizes = [row["n"] for row in r.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 2 * 60000 / 6


def test_running_count_wide_frame_written_out(spark, tmp_path):
    """Extra columns change the sampled bounds of a range partitioning; the numbers must not."""
    df = spark.range(120_000).select((F.col("id") * 7919 % 1000).alias("t"), F.col("id").alias("c"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("payload"), F.rand(1).alias("x"))
    running_count(df, "t", "c", "count", partitions=7).write.parquet(str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    row = got.agg(F.count("*"), F.countDistinct("count"), F.min("count"), F.max("count")).first()
    assert tuple(row) == (120_000, 120_000, 1, 120_000)
    want = df.select("c", F.row_number().over(Window.orderBy("t", "c")).alias("rn"))
    assert got.join(want, "c").where("rn <> count").count() == 0


def test_feeds_are_complete(spark):
    from payflux.operators.generate import gen_payments
    ticks = spark.range(1, 2001).select(F.col("id").alias("count"), F.col("id").alias("t"))
    p = gen_payments(ticks)
    assert p.count() == 9995 and p.select("_txnID").distinct().count() == 9995
    assert p.select("source_bank").distinct().count() == 9995


def test_settlement_ids_are_unique_beyond_the_old_range(spark):
    from payflux.functions.scalar import SETTLEMENT_IDS, settlement_id
    ids = spark.range(0, 400_000_000_000, 1_000_003).select(settlement_id("id").alias("s"))
    n, d, lo, hi = ids.agg(F.count("*"), F.countDistinct("s"), F.min("s"), F.max("s")).first()
    assert n == d and lo >= 1 and hi <= SETTLEMENT_IDS
