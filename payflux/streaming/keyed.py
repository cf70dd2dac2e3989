"""TTL dedup on a stream in Spark's own keyed state.

A row is kept if no row of its key was kept within the last ``ttl_ms`` (event time). The
state holds one entry per live key, the time of its last kept row. Keys are dealt to
``buckets`` by their hash and a bucket's entries are one value, so a micro-batch reads and
writes a bucket once instead of calling the store several times a key. A timer per bucket
removes the entries whose end the watermark has passed. State and output belong to the
query's checkpoint, so a replayed micro-batch starts from the same state and gives the same
rows. Nothing is compacted by hand.

Rows of one key within a micro-batch are taken in event-time order (NULL first, as in the
batch operator); a task holds one bucket's rows of a micro-batch (``maxFilesPerTrigger``
bounds them) and its live keys. With rows in event-time order across micro-batches the result
is that of the batch operator. ``buckets`` belongs to the state: a checkpoint keeps the number
it began with. Keyed state needs the RocksDB store, which ``start_keyed_ttl`` sets for its
query alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class KeepFirst(StatefulProcessor):
    """Keeps the first row of a key and then one at least ``ttl_ms`` after the last kept one, for a bucket of keys."""

    def __init__(self, schema: StructType, key: str, ts: str, tie: str, ttl_ms: int):
        at = schema.fieldNames().index
        self.key, self.ts, self.tie, self.names, self.ttl_ms = at(key), at(ts), at(tie), schema.fieldNames(), ttl_ms
        self.state = StructType([StructField("keys", ArrayType(schema[key].dataType)), StructField("last", ArrayType(LongType()))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", self.state)

    def _read(self) -> dict:
        return dict(zip(*self.live.get())) if self.live.exists() else {}

    def _write(self, live: dict, watermark: int, timer: int | None) -> None:
        """Keep the entries that the watermark has not passed, and one timer at their earliest end."""
        # the watermark has passed the end of the others: no row that is still taken can fall within it
        live = {k: t for k, t in live.items() if t + self.ttl_ms > watermark}
        first = min(live.values()) + self.ttl_ms if live else None
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if not live:
            self.live.clear()
            return
        self.live.update(([*live], [*live.values()]))
        if timer != first:
            self.handle.registerTimer(first)

    def _ordered(self, rows: Iterator[Row]) -> list[Row]:
        rows = list(rows)
        try:
            return sorted(rows, key=itemgetter(self.ts, self.tie))
        except TypeError:  # NULL among them
            return sorted(rows, key=lambda r: [(r[i] is not None, r[i]) for i in (self.ts, self.tie)])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        live = self._read()
        timer = min(live.values()) + self.ttl_ms if live else None
        k, ts, ttl, width, out, changed = self.key, self.ts, self.ttl_ms, len(self.names), Row(*self.names), False
        for row in self._ordered(rows):
            last, t = live.get(row[k]), row[ts]
            if last is None or (t is not None and t >= last + ttl):
                if t is not None:
                    live[row[k]] = t
                    changed = True
                yield out(*row[:width])
        if changed:
            self._write(live, timerValues.getCurrentWatermarkInMs(), timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # the timer that fired is gone by itself
        self._write(self._read(), max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()), None)
        return iter(())

    def close(self) -> None:
        pass


def keyed_ttl(rows: DataFrame, key: str = "_txnID", ts: str = "timestamp", tie: str = "attempt",
              ttl_ms: int = 5000, late_ms: int = 60_000, buckets: int = 4096) -> DataFrame:
    """The kept rows of a streaming frame (``ts`` in epoch millis above 0). Rows ``late_ms`` or more behind the latest
    event of earlier micro-batches are left out, so ``late_ms`` must be above 0 for equal times to be taken."""
    if late_ms <= 0:
        raise ValueError("late_ms must be above 0")
    schema = rows.schema
    timed = (rows.withColumn("_at", F.timestamp_millis(F.col(ts))).withWatermark("_at", f"{late_ms} milliseconds")
             .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")))
    return timed.groupBy("_bucket").transformWithState(
        statefulProcessor=KeepFirst(schema, key, ts, tie, ttl_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime")


def start_keyed_ttl(rows: DataFrame, sink: str, checkpoint: str, available_now: bool = True, **how) -> StreamingQuery:
    """Start ``keyed_ttl`` into a parquet folder, exactly once through the file sink's log."""
    spark = rows.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        w = (keyed_ttl(rows, **how).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).outputMode("append"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
        return w.start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
