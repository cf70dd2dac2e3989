"""Stream-table enrichment joins (payment x Banks, cache lookups, presence).

The bank table grows with the data (one row per account), so it is never
broadcast blindly: ``bounded_broadcast`` hints a broadcast only after proving
the side has at most ``max_rows`` rows; otherwise Catalyst/AQE choose the join
(AQE still converts to a broadcast at run time when the shuffled side is small).
A micro-batch instead cuts the big table to its own keys first (``key_filter``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from payflux.config import DEFAULT, FlowConfig


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only if it provably holds at most ``max_rows`` rows.

    The check is one bounded job (``limit(max_rows + 1).count()``), so it costs
    at most ``max_rows`` rows of reading no matter how big the side is.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def key_filter(keys: DataFrame, max_rows: int = 1_000_000):
    """A function ``(table, key) -> rows of table whose key occurs in keys``.

    For a micro-batch probing large, growing tables (accounts, recorded
    requests, the ledger): when a bounded count proves ``keys`` (first column)
    has at most ``max_rows`` rows, tables are cut by a broadcast semi join -- a
    scan with no shuffle of the table -- so the joins that follow see a small
    side (which AQE then broadcasts). Otherwise tables pass unchanged and the
    joins shuffle as usual. One check serves every table of the batch. For a
    numeric key the batch's key range is also applied as a filter the parquet
    scan pushes down, so history files outside it are skipped by their stats.
    """
    k = keys.select(F.col(keys.columns[0]).alias("_probe_key")).filter(F.col("_probe_key").isNotNull())
    numeric = isinstance(k.schema["_probe_key"].dataType, NumericType)
    stats = [F.count(F.lit(1)).alias("n")]
    if numeric:
        stats += [F.min("_probe_key").alias("lo"), F.max("_probe_key").alias("hi")]
    row = k.limit(max_rows + 1).agg(*stats).first()
    if row["n"] > max_rows:
        return lambda table, key: table
    kb = F.broadcast(k)

    def cut(table: DataFrame, key: str) -> DataFrame:
        if numeric and row["n"] > 0:
            # a key range the parquet scan can use: with ids that grow over
            # time, files of earlier batches are skipped by their min/max
            table = table.filter(F.col(key).between(F.lit(row["lo"]), F.lit(row["hi"])))
        return table.join(kb, F.col(key) == F.col("_probe_key"), "left_semi")

    return cut


def restrict_to_keys(table: DataFrame, keys: DataFrame, table_key: str,
                     max_rows: int = 1_000_000) -> DataFrame:
    """``key_filter`` for one table."""
    return key_filter(keys, max_rows)(table, table_key)


def bank_cache(banks: DataFrame) -> DataFrame:
    """BanksCache loaded at start: ``(_key, region)``."""
    return banks.select("_key", "region")


def enrich_source_bank(payments: DataFrame, banks: DataFrame, bank_col: str = "_key") -> DataFrame:
    """Payment LEFT JOIN Banks ON <bank_col> == source_bank (stream side drives).

    ``bank_col='name'`` is V1's join on the bank name; a name shared by several
    banks yields one row per bank, as a join does.
    """
    b = banks.select(F.col(bank_col).alias("_sb_key"),
                     F.col("balance").alias("source_balance"),
                     F.col("reserved").alias("source_total_reserved"),
                     F.col("region").alias("source_region"))
    return payments.join(b, payments.source_bank == b._sb_key, "left").drop("_sb_key")


def enrich_target_region(payments: DataFrame, cache: DataFrame) -> DataFrame:
    """Payment LEFT JOIN BanksCache ON _key == target_bank -> target_region."""
    c = cache.select(F.col("_key").alias("_tb_key"), F.col("region").alias("target_region"))
    return payments.join(c, payments.target_bank == c._tb_key, "left").drop("_tb_key")


def join_target_bank_inner(settlements: DataFrame, banks: DataFrame, bank_col: str = "_key") -> DataFrame:
    """Settlement JOIN Banks ON <bank_col> == target_bank (inner): an unknown
    target bank drops the event. V1 joins on ``name``."""
    b = banks.select(F.col(bank_col).alias("_tb_key"), F.col("region").alias("target_region"))
    s = settlements.drop("target_region") if "target_region" in settlements.columns else settlements
    return s.join(b, s.target_bank == b._tb_key, "inner").drop("_tb_key")


def presence_flag(payments: DataFrame, presence: DataFrame, cfg: FlowConfig = DEFAULT) -> DataFrame:
    """``consumerExists(stream, '%', region, subscriber)`` as an existence flag.

    The presence table is one row per live consumer; it is reduced to the set
    of regions with a matching consumer and left-joined, so a payment row is
    never duplicated. The join key has a handful of values (regions), so a
    shuffle join would put every payment in a few tasks: the region set is
    broadcast once a bounded count proves it small (else AQE decides).
    """
    live = (presence.filter((F.col("stream") == cfg.presence_stream)
                            & F.col("subscriber").like(cfg.presence_subscriber))
            .select(F.col("region").alias("_live_region")).distinct()
            .withColumn("_present", F.lit(True)))
    live = bounded_broadcast(live, 10_000)
    j = payments.join(live, payments.target_region == live._live_region, "left")
    return j.withColumn("isDevicePresent", F.coalesce(F.col("_present"), F.lit(False))) \
            .drop("_live_region", "_present")


def settlement_lookup(payee: DataFrame, settlement: DataFrame) -> DataFrame:
    """Payee message LEFT JOIN Settlement ON _key == txnID -> loaded_* columns."""
    s = settlement.select(
        F.col("_key").alias("_s_key"),
        F.col("source_bank").alias("loaded_source_bank"),
        F.col("target_bank").alias("loaded_target_bank"),
        F.col("source_region").alias("loaded_source_region"),
        F.col("target_region").alias("loaded_target_region"),
        F.col("amount").alias("loaded_amount"),
        F.col("currency").alias("loaded_currency"),
        F.col("timestamp").alias("loaded_timestamp"),
        F.col("status").alias("loaded_status"))
    p = payee.withColumn("_p_key", F.col("_txnID").cast("string"))
    return p.join(s, p._p_key == s._s_key, "left").drop("_p_key", "_s_key")


def join_active_settlement(payee: DataFrame, settlement: DataFrame) -> DataFrame:
    """V1 SW2: payee JOIN Settlement ON txn equal AND settlement status 'active'."""
    s = settlement.select(
        F.col("_txnID").alias("_s_txn"), "settlement_id",
        F.col("source_bank").alias("s_source_bank"), F.col("target_bank").alias("s_target_bank"),
        F.col("source_region").alias("s_source_region"), F.col("amount").alias("s_amount"),
        F.col("currency").alias("s_currency"), F.col("timestamp").alias("s_timestamp"),
        F.col("status").alias("s_status"))
    return payee.join(s, (payee._txnID == s._s_txn) & (s.s_status == "active"), "inner")


def point_lookup(keys: DataFrame, table: DataFrame, key_col: str = "_key") -> DataFrame:
    """``FOR doc FILTER doc._key == @k RETURN doc`` for a frame of keys."""
    k = keys.select(F.col(keys.columns[0]).alias(key_col)).distinct()
    return table.join(k, key_col, "left_semi")
