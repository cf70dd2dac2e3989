"""TTL dedup on a stream.

``start_ttl_dedup`` keeps the state as a committed table: per micro-batch the
batch operator (JVM only, hot keys split) runs on the rows not suppressed by
earlier batches, so a hot key is never one group of one task.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from payflux.streaming.store import TableStore


def _state_schema(rows: DataFrame, key: str) -> StructType:
    return StructType([rows.schema[key], StructField("last", LongType())])


def ttl_state(store: TableStore, rows: DataFrame, key: str, only=None) -> DataFrame:
    """``(key, last)``: the event time of each key's last kept row, from the
    committed base plus every committed ``ttl_kept`` entry (a partial max)."""
    schema = _state_schema(rows, key)
    cut = (lambda t: t) if only is None else (lambda t: only(t, key))

    def fold(base: DataFrame, kept: DataFrame) -> DataFrame:
        return (cut(base).unionByName(cut(kept)).groupBy(key).agg(F.max("last").alias("last")))

    return store.state("ttl_state", "ttl_kept", schema, fold)


def compact_ttl_state(store: TableStore, rows: DataFrame, key: str, horizon_ms: int) -> int:
    """Fold committed entries into a new base, dropping keys whose last kept
    row is older than ``horizon_ms`` (their TTL can no longer suppress a row
    that is not already late)."""
    schema = _state_schema(rows, key)

    def fold(base: DataFrame, kept: DataFrame) -> DataFrame:
        return (base.unionByName(kept).groupBy(key).agg(F.max("last").alias("last"))
                .filter(F.col("last") >= F.lit(horizon_ms)))

    return store.compact("ttl_state", "ttl_kept", schema, fold)


def ensure_ttl_state(store: TableStore, rows: DataFrame, key: str) -> None:
    """Seed an empty TTL state table once."""
    if store.last_commit("base-ttl_state") is None:
        store.seed({"ttl_state": rows.sparkSession.createDataFrame([], _state_schema(rows, key))})


def suppress_within_ttl(store: TableStore, batch: DataFrame, key: str, ts: str, ttl_ms: int) -> DataFrame:
    """Rows of ``batch`` not within ``ttl_ms`` of their key's last kept row
    from earlier batches (state read only for the batch's keys)."""
    from payflux.operators import enrich

    only = enrich.key_filter(batch.select(key))
    last = ttl_state(store, batch, key, only).withColumnRenamed("last", "_last")
    return (batch.join(last, key, "left")
            .filter(F.col("_last").isNull() | (F.col(ts) >= F.col("_last") + F.lit(ttl_ms)))
            .drop("_last"))


def kept_times(kept: DataFrame, key: str, ts: str) -> DataFrame:
    """New state entries: each key's last kept time in this batch."""
    return kept.groupBy(key).agg(F.max(ts).alias("last"))


def ttl_dedup_batch(store: TableStore, key: str, ts: str, tie: str, ttl_ms: int,
                    sink: str, group_rows: int = 4096):
    """``foreachBatch`` body of TTL dedup over keyed state kept as a table.

    A row within ``ttl_ms`` of its key's last kept row (from earlier batches)
    is suppressed; the rest go through the batch operator (ordered per key,
    hot keys split by range segments, all JVM), whose kept rows and the keys' new
    state are one commit; committed rows are then written to ``sink``. Exact for
    micro-batches arriving in event-time order.
    """
    from payflux.operators.dedup import dedup_ttl

    def run(batch: DataFrame, batch_id: int) -> None:
        if not store.is_committed(batch_id):
            if batch.isEmpty():
                return
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            fresh = suppress_within_ttl(store, batch, key, ts, ttl_ms)
            kept = dedup_ttl(fresh, key, ts, tie, ttl_ms, group_rows).persist(StorageLevel.MEMORY_AND_DISK)
            store.commit(batch_id, {"ttl_kept": kept_times(kept, key, ts), "outbox_kept": kept})
            kept.unpersist()
            batch.unpersist()
        rows = store.batch_rows("outbox_kept", batch_id)  # published once committed, again on a replay
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return run


def start_ttl_dedup(spark, rows: DataFrame, store: TableStore, sink: str, checkpoint: str,
                    key: str = "_txnID", ts: str = "timestamp", tie: str = "attempt",
                    ttl_ms: int = 5000, available_now: bool = True, group_rows: int = 4096):
    """Start TTL dedup on a streaming frame; kept rows land in ``sink`` (parquet)."""
    job = store.for_job("ttl")
    ensure_ttl_state(job, rows, key)
    w = (rows.writeStream.foreachBatch(ttl_dedup_batch(job, key, ts, tie, ttl_ms, sink, group_rows))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
