"""Generators: seeding, running counts, ticks, payment feeds, transaction ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payflux.functions.scalar import convert, rand, str_concat
from payflux.operators.dedup import first_per_key
from payflux.session import cut_lineage

# Seed modulus, seed amounts and the bank brands of the seeding job.
SEED_MODULUS = 24000
SEED_BALANCE = 10000
SEED_BRANDS = [
    # (key prefix, name prefix, region)
    ("Chase_", "Fargo_", "cleaninghouse-us-west-1"),
    ("Fargo_", "Fargo_", "cleaninghouse-us-east-1"),
]
# the simplified (V4) seeding names Chase keys after their own brand
SEED_BRANDS_V4 = [
    ("Chase_", "Chase_", "cleaninghouse-us-west-1"),
    ("Fargo_", "Fargo_", "cleaninghouse-us-east-1"),
]

# The feeds of the load generator. Source bank = count + 2nd
# number, target bank = count + 3rd, transaction = count + 4th, for counts up to
# the last number.
FEEDS = [
    ("west", "central", -1, -1, 0, 833),
    ("west", "east", 832, -1, 833, 833),
    ("west", "southeast", 1665, -1, 1666, 833),
    ("central", "west", -1, -1, 2500, 833),
    ("central", "east", 832, 832, 3333, 833),
    ("central", "southeast", 1665, 832, 4166, 833),
    ("east", "central", 0, 833, 5000, 832),
    ("east", "west", 832, 832, 5833, 833),
    ("east", "southeast", 1665, 1665, 6666, 833),
    ("southeast", "central", -1, 1665, 7500, 833),
    ("southeast", "west", 832, 1665, 8333, 833),
    ("southeast", "east", 1665, 1665, 9166, 833),
]
FEED_AMOUNT = 100.0

# The trigger feed of the performance tests (accounts, amount, threshold of the draw).
TRIGGER_ACCOUNTS = 12000
TRIGGER_AMOUNT = 1.0
TRIGGER_THRESHOLD = 0.5


def seed_banks(ticks: DataFrame, existing: DataFrame, count_col: str = "c",
               modulus: int = SEED_MODULUS, brands: list | None = None) -> DataFrame:
    """Keyed insert of seed banks: keys repeat (``c % modulus``); the first row
    per key wins and keys already in the table are left alone."""
    c = F.col(count_col)
    idx = convert(c % modulus, "string")
    parts = [ticks.select(
        str_concat(kp, idx).alias("_key"), idx.alias("uuid"), str_concat(np_, idx).alias("name"),
        F.lit(SEED_BALANCE).cast("bigint").alias("balance"), F.lit(0).cast("bigint").alias("reserved"),
        F.lit("USD").alias("currency"), F.lit(region).alias("region"), c.alias("_c"))
        for kp, np_, region in (brands or SEED_BRANDS)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    firsts = first_per_key(rows, "_key", ["_c"]).drop("_c")
    return firsts.join(existing.select("_key"), "_key", "left_anti")


def running_count(df: DataFrame, ts: str, tie: str, out: str = "c",
                  partitions: int | None = None) -> DataFrame:
    """``count()`` over an unwindowed stream: 1, 2, 3, ... in ``(ts, tie)`` order.

    Skew-proof numbering without a window over all rows: the rows are range
    partitioned on ``(ts, tie)`` (sampled bounds split even a single hot
    instant, since ``tie`` makes the order total), sorted inside each partition
    and numbered by position (``monotonically_increasing_id`` = partition index
    in the high bits, position in the low 33 bits). Each partition's offset is
    a running sum over the per-partition counts: one row per partition, a table
    bounded by the partition count, so it is broadcast. One shuffle. The
    numbered rows are cut by a reliable checkpoint: counts and rows must see the
    same partitions, and a range partitioning of other columns samples other bounds.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = cut_lineage(df.repartitionByRange(n, F.col(ts), F.col(tie))
                         .sortWithinPartitions(ts, tie)
                         .withColumn("_mid", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright(F.col("_mid"), 33))
                         .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    return (ranked.join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_off") + F.col("_pos") + 1)
            .drop("_mid", "_part", "_pos", "_off"))


def tick_series(spark: SparkSession, first_ms: int, last_ms: int, interval_ms: int) -> DataFrame:
    """The ticks of a periodic trigger between two instants, idle ones included: ``(tick, tick_ts)``.

    The series is dealt over tasks by ``range``; nothing is read and nothing shuffled.
    """
    return (spark.range(first_ms // interval_ms, last_ms // interval_ms + 1).select(
        F.col("id").alias("tick"), (F.col("id") * interval_ms).alias("tick_ts")))


def tick_source(events: DataFrame, t: str = "t", interval_ms: int = 2000) -> DataFrame:
    """Periodic trigger over a table of events: every tick from the first event's to the last one's,
    whether something happened or not. Two scalars reach the driver. Without events there are no ticks."""
    r = events.agg(F.min(t).alias("a"), F.max(t).alias("b")).first()
    if r["a"] is None:
        return tick_series(events.sparkSession, 0, -1, interval_ms).limit(0)
    return tick_series(events.sparkSession, r["a"], r["b"], interval_ms)


def tick_counts(events: DataFrame, t: str = "t", interval_ms: int = 2000) -> DataFrame:
    """``(tick, tick_ts, n)``: events per tick, 0 in idle ones."""
    seen = events.where(F.col(t).isNotNull()).groupBy(F.floor(F.col(t) / F.lit(interval_ms)).cast("bigint").alias("tick")).agg(F.count(F.lit(1)).alias("n"))
    return tick_source(events, t, interval_ms).join(seen, "tick", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def gen_payments(ticks: DataFrame, count_col: str = "count", t: str = "t",
                 region: str | None = None, feeds: list[tuple] | None = None) -> DataFrame:
    """Payment generator: each tick emits one payment per feed up to the feed's
    last count. Feeds are a literal array exploded per tick (no join)."""
    names = ("src", "tgt", "s", "b", "x", "last")
    arr = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, f)])
                    for f in (feeds or FEEDS) if region is None or f[0] == region])
    n = F.col("_n")
    x = (ticks.select(F.col(count_col).alias("_n"), F.col(t).alias("_t"))
         .filter(n <= max(f[-1] for f in (feeds or FEEDS)))
         .select("_n", "_t", F.explode(arr).alias("f")).filter(n <= F.col("f.last")))
    return x.select(
        F.concat(F.lit("BankA-"), F.col("f.src"), F.lit("_"), (n + F.col("f.s")).cast("string")).alias("source_bank"),
        F.concat(F.lit("BankB-"), F.col("f.tgt"), F.lit("_"), (n + F.col("f.b")).cast("string")).alias("target_bank"),
        F.lit(FEED_AMOUNT).alias("amount"), F.lit("USD").alias("currency"),
        (n + F.col("f.x")).cast("bigint").alias("_txnID"),
        F.col("_t").alias("timestamp"))


def trigger_payments(ticks: DataFrame, count_col: str = "count", t: str = "t", accounts: int = TRIGGER_ACCOUNTS,
                     seed: str = "trigger") -> DataFrame:
    """The trigger feed: accounts by count, one unit up or down by a draw (``math:rand``), id from time and count."""
    c = F.col(count_col)
    amount = F.when(rand(c, seed) > TRIGGER_THRESHOLD, F.lit(TRIGGER_AMOUNT)).otherwise(F.lit(-TRIGGER_AMOUNT))
    return assign_txn(ticks, count_col, t).select(
        str_concat("Chase_", convert(c % accounts, "string")).alias("source_bank"),
        str_concat("Chase_", convert(c % accounts + accounts, "string")).alias("target_bank"),
        amount.alias("amount"), F.lit("USD").alias("currency"), "txnID")


def assign_txn(events: DataFrame, count_col: str = "count", t: str = "t") -> DataFrame:
    """Transaction id from the trigger: ``millis * 10000 + count % 10000`` as text."""
    return events.withColumn(
        "txnID", (F.col(t) * 10000 + F.col(count_col) % 10000).cast("string"))
