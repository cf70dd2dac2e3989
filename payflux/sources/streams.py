"""JSON stream sources and sinks (batch and Structured Streaming).

A logical stream is a folder of JSON-lines files; a sink may publish to a
folder named differently from the sink (``sink_paths``). The same parsing
runs on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

JSON_OPTS = {"ignoreNullFields": "false"}


def json_payload(cols: list[str]) -> Column:
    """``map.type='json'`` sink mapping: one JSON object per row, NULLs kept."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_OPTS)


def to_json_lines(df: DataFrame) -> DataFrame:
    """Serialise every row as one JSON text column ``value``."""
    return df.select(json_payload(df.columns).alias("value"))


def parse_json_lines(lines: DataFrame, schema: StructType, col: str = "value") -> DataFrame:
    """Declared-schema JSON source: attributes match by name; missing -> NULL,
    extra -> dropped."""
    return lines.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")


def parse_checked(lines: DataFrame, schema: StructType, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(events, faults)`` of JSON lines, on batch and streaming frames alike: a line that is no JSON object, is cut
    off or holds a value of another type is a fault ``(event, error)`` with its whole text instead of a row of NULLs.

    A NULL line is a fault too; an empty object is an event of NULLs. No line is lost.
    """
    bad = "_corrupt"
    kept = StructType([*schema.fields, StructField(bad, StringType())])
    r = F.from_json(F.col(col), kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    parsed = lines.select(F.col(col).alias("event"), r.alias("r"))
    fault = F.col("r").isNull() | F.col(f"r.{bad}").isNotNull() | F.trim("event").eqNullSafe("")
    events = parsed.where(~fault).select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields])
    return events, parsed.where(fault).select("event", F.lit("malformed payload").alias("error"))


def read_checked_stream(spark: SparkSession, path: str, schema: StructType,
                        max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A JSON stream of a declared schema and its fault stream."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_checked(r.text(path), schema)


def raw_payload(lines: DataFrame, col: str = "value", out: str = "evt") -> DataFrame:
    """``map.attributes.evt = "$"``: the whole payload as one string."""
    return lines.withColumnRenamed(col, out)


# --------------------------------------------------------------------------- streaming I/O

def read_json_stream(spark: SparkSession, path: str, schema: StructType,
                     max_files_per_trigger: int | None = None,
                     starting_after_ms: int | None = None, arrival: str | None = None) -> DataFrame:
    """Streaming JSON source with a declared schema (no inference).

    The durable subscription is the query's ``checkpointLocation``. A file
    source reads every existing file on its first start; the reference's
    ``subscription.initial.position='Latest'`` is ``starting_after_ms``: files
    modified before that instant are skipped (the filter reads file metadata,
    not file contents). ``arrival`` names a column for the instant (epoch millis) at
    which an event's file arrived, the same on a replay: ``eventTimestamp()``.
    """
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.json(path)
    arrived = F.col("_metadata.file_modification_time")
    if starting_after_ms is not None:
        df = df.filter(arrived >= F.timestamp_millis(F.lit(starting_after_ms)))
    if starting_after_ms is not None or arrival:
        more = [F.unix_millis(arrived).alias(arrival)] if arrival else []
        df = df.select(*schema.fieldNames(), *more)
    return df


def start_json_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                    fmt: str = "json"):
    """Stateless leg to a file sink: exactly once through the sink's own
    metadata log, which a downstream file source also honours."""
    w = (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
         .option("ignoreNullFields", "false").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def read_raw_stream(spark: SparkSession, path: str) -> DataFrame:
    """Whole-payload source: each line as ``evt``."""
    return raw_payload(spark.readStream.text(path))


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Batch JSON sink (used inside ``foreachBatch``)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def rate_ticks(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Periodic trigger as a stream: ``rate`` source; ``c`` counts from 1."""
    return (spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
            .select((F.col("value") + 1).alias("c"), F.unix_millis("timestamp").alias("t")))
