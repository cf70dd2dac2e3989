"""Running counts and totals on streams.

``start_running_count`` numbers the events 1, 2, 3, ... in the order of micro-batches and,
within one, of ``(ts, tie)``. Only one number per micro-batch is carried: its count, written
beside the numbered rows. A micro-batch starts from the sum of the counts before it and
overwrites its own folder, so a replay gives the same numbers without a gap.

``start_totals`` is Spark's streaming aggregation in update mode; the last row written
holds the totals of everything read so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payflux.operators.generate import running_count


def count_batch(ts: str, tie: str, sink: str, offsets: str, out: str = "count"):
    """``foreachBatch`` body: number a micro-batch after all earlier ones."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        numbers = spark.createDataFrame([(-1, 0)], "batch_id bigint, n bigint")
        if batch_id:
            numbers = numbers.unionByName(spark.read.schema(numbers.schema).option("recursiveFileLookup", "true").parquet(offsets))
        before = numbers.where(F.col("batch_id") < batch_id).agg(F.sum("n")).first()[0]
        counted = running_count(batch, ts, tie, out).withColumn(out, F.col(out) + F.lit(before))
        counted.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        n = spark.read.schema(counted.schema).parquet(f"{sink}/batch={batch_id}").count()
        spark.createDataFrame([(batch_id, n)], numbers.schema).coalesce(1).write.mode("overwrite").parquet(f"{offsets}/batch={batch_id}")

    return run


def start_running_count(events: DataFrame, ts: str, tie: str, sink: str, checkpoint: str, out: str = "count",
                        available_now: bool = True) -> StreamingQuery:
    """Start the running count of a stream into ``sink`` (parquet, a folder per micro-batch)."""
    w = events.writeStream.foreachBatch(count_batch(ts, tie, sink, f"{checkpoint}/counts", out)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def start_totals(events: DataFrame, aggregates: list[Column], sink: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Start global aggregates of a stream: after every micro-batch the totals so far, with its number ``_batch``."""

    def write(totals: DataFrame, batch_id: int) -> None:
        totals.withColumn("_batch", F.lit(batch_id).cast("bigint")).coalesce(1).write.mode("overwrite").parquet(f"{sink}/at={batch_id}")

    w = (events.groupBy().agg(*aggregates).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def last_totals(totals: DataFrame) -> DataFrame:
    """The totals of the last micro-batch of ``start_totals``' sink."""
    names = [c for c in totals.columns if c not in ("_batch", "at")]
    return totals.groupBy().agg(F.max_by(F.struct(*names), "_batch").alias("_t")).select("_t.*")
