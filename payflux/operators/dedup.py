"""Duplicate suppression: durable (against a table) and TTL (keyed cache)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.operators.ordered import ttl_first_seen


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (then by every other column).

    ``min(struct(...))`` is a partial aggregate: each map task sends one row
    per key, so a key repeated a billion times is combined before the shuffle.
    Rows without a key (NULL) equal no other row: all of them stay. They are
    spread by their contents, so any number of them is no hot group.
    """
    rest = [c for c in df.columns if c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    # keyless rows group by all their columns and come back as often as they stood
    cells = F.when(F.col(key).isNull(), F.to_json(packed))
    first = df.groupBy(F.col(key).alias("_k"), cells.alias("_cells")).agg(
        F.min(packed).alias("_first"), F.count(F.lit(1)).alias("_n"))
    copies = F.when(F.col("_k").isNull(), F.col("_n")).otherwise(F.lit(1)).cast("int")
    return (first.withColumn("_i", F.explode(F.sequence(F.lit(1), copies)))
            .select(*[F.col("_first")[c].alias(c) for c in df.columns]))


def dedup_durable(payments: DataFrame, recorded: DataFrame, key: str = "_txnID",
                  order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """V2: drop payments whose txn is already recorded (left anti join); copies
    inside the same batch keep the first by ``order``."""
    firsts = first_per_key(payments, key, list(order))
    return firsts.join(recorded.select(key), key, "left_anti")


def dedup_ttl(rows: DataFrame, key: str = "_txnID", ts: str = "timestamp",
              tie: str = "attempt", ttl_ms: int = 5000, group_rows: int = 4096,
              with_flag: bool = False) -> DataFrame:
    """V8: ``memcache:get`` NULL means first; put with TTL only after the filter,
    so copies do not refresh it. Batch form (event time); see
    ``payflux.streaming.ttl`` for the keyed-state streaming form."""
    flagged = ttl_first_seen(rows, key, ts, tie, ttl_ms, group_rows)
    return flagged if with_flag else flagged.filter("kept").drop("kept", "copies")
