"""Settlement legs: SW1 (register + transfer), Bank B, SW2 (status + confirm).

V2 layout (``settlement_*``) and the V8 layout with the settlement JSON cache,
table fallback and validation (``v8_*``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.config import DEFAULT, FlowConfig
from payflux.functions.scalar import (convert, json_get_double, json_get_string,
                                      settlement_id, str_concat)
from payflux.operators import accounts, enrich, rules
from payflux.operators.dedup import first_per_key


def settlement_register(settlements: DataFrame, cfg: FlowConfig = DEFAULT,
                        region: str | None = None) -> DataFrame:
    """SW1 (V2): settlements targeting the region become active Settlement rows.

    ``region=None`` runs every region's instance at once (rows need a known
    target region); a region string runs one instance.
    """
    cond = F.col("target_region").isNotNull() if region is None else F.col("target_region") == region
    return settlements.filter(cond).select(
        F.col("_txnID").alias("settlement_id"), "source_bank", "target_bank", "source_region",
        "amount", "currency", "timestamp", F.lit("active").alias("status"), "_txnID")


def transfers(registered: DataFrame) -> DataFrame:
    """SW1 -> Transfers (request to Bank B)."""
    return registered.select("source_bank", "target_bank", "amount", "currency", "timestamp", "_txnID")


def bank_b_accept(transfers_df: DataFrame) -> DataFrame:
    """Bank B auto-accepts every transfer."""
    return transfers_df.select("source_bank", "target_bank", "amount", "currency", "timestamp",
                               F.lit("ACCP").alias("status"), "_txnID")


def confirmation_rows(payee: DataFrame) -> DataFrame:
    """SW2 (V2): the Confirmations stream, status mapped from the payee answer."""
    return payee.select(
        F.col("_txnID").alias("settlement_id"), "source_bank", "target_bank", "amount", "currency",
        "timestamp", rules.payee_status(F.col("status")).alias("status"), "_txnID")


def status_updates(confirmations: DataFrame) -> DataFrame:
    """``UPDATE Settlement SET status ON _txnID`` as update rows."""
    return confirmations.select("_txnID", "status", "timestamp")


def apply_status(settlement: DataFrame, updates: DataFrame) -> DataFrame:
    """Last-write-wins status per transaction."""
    return accounts.last_write_wins(settlement, updates, "_txnID", "status", "timestamp")


def settlement_confirm(payee: DataFrame, settlement: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SW2 (V2): status from the payee answer, last-write-wins status update on
    Settlement, and the Confirmations stream. Returns (confirmations, settlement')."""
    with_status = confirmation_rows(payee)
    return with_status, apply_status(settlement, status_updates(with_status))


# ----------------------------------------------------------------------------- V8

def settlement_cache_json() -> "F.Column":
    """The cached settlement as single-quoted JSON (a 7-way ``str:concat``)."""
    return str_concat("{'sb':'", F.col("source_bank"), "','tb':'", F.col("target_bank"),
                      "','sr':'", F.col("source_region"), "','tr':'", F.col("target_region"),
                      "','a':", convert(F.col("amount"), "string"), ",'c':'", F.col("currency"),
                      "','s':'active'}")


def v8_register(settlements: DataFrame, cfg: FlowConfig = DEFAULT, region: str | None = None,
                keyed: bool = True, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """SW (V8) insert-returning: Settlement rows keyed by txn and cache entries.

    The insert sets ``_key = txnID``: a second insert of a key fails and
    returns nothing, so only the first settlement per transaction (by time)
    is registered, cached and sent on, and keys already in ``existing`` are
    not registered again. ``keyed=False`` skips that step (the streaming
    cache side, which cannot aggregate ahead of a stream-stream join; a
    later copy's entry never falls in the TTL window of the registered one).
    """
    cond = F.col("target_region").isNotNull() if region is None else F.col("target_region") == region
    rows = settlements.filter(cond).select(
        F.col("_txnID").cast("string").alias("_key"),
        settlement_id(F.col("_txnID")).alias("settlement_id"),
        "source_bank", "target_bank", "source_region", "target_region", "amount", "currency",
        "timestamp", F.lit("active").alias("status"), "_txnID")
    if keyed:
        rows = first_per_key(rows, "_key", ["timestamp"])
    if existing is not None:
        rows = rows.join(existing.select("_key"), "_key", "left_anti")
    cache = rows.select(F.col("_txnID"), settlement_cache_json().alias("json"),
                        F.col("timestamp").alias("put_ts"))
    return rows, cache


def cache_join(payee: DataFrame, cache: DataFrame, ttl_ms: int = 5000,
               watermark_ms: int | None = None) -> DataFrame:
    """``memcache:get(txnID)``: payee messages LEFT JOIN the cache entries put
    within ``ttl_ms`` before the message (``json`` is NULL on a miss).

    The time bound is on event-time columns, so the same join runs on two
    streams: with ``watermark_ms`` both sides get a watermark and Spark keeps
    a cache entry in join state only until the watermark passes its TTL.
    """
    c = cache.select(F.col("_txnID").alias("_c_txn"), "json",
                     F.timestamp_millis(F.col("put_ts")).alias("_put_time"))
    p = payee.withColumn("_msg_time", F.timestamp_millis(F.col("timestamp")))
    if watermark_ms is not None:
        delay = f"{watermark_ms} milliseconds"
        c, p = c.withWatermark("_put_time", delay), p.withWatermark("_msg_time", delay)
    cond = ((p._txnID == c._c_txn) & (c._put_time <= p._msg_time)
            & (p._msg_time < c._put_time + F.expr(f"INTERVAL {int(ttl_ms)} MILLISECONDS")))
    return p.join(c, cond, "left").drop("_c_txn", "_put_time", "_msg_time")


def resolve_cache(joined: DataFrame, settlement: DataFrame) -> DataFrame:
    """Cache-else-table: a hit (``json`` not NULL) is parsed; a miss reads the
    Settlement table by key. Hit rows take the timestamp of the payee message,
    misses the stored one."""
    hit = F.col("json").isNotNull()
    looked = enrich.settlement_lookup(joined, settlement)
    pick = lambda hv, mv: F.when(hit, hv).otherwise(mv)
    return looked.select(
        "source_bank", "target_bank", "amount", "currency", "timestamp",
        F.col("status").alias("payee_status"), "_txnID", hit.alias("cache_hit"),
        pick(json_get_string("json", "$.sb"), F.col("loaded_source_bank")).alias("loaded_source_bank"),
        pick(json_get_string("json", "$.tb"), F.col("loaded_target_bank")).alias("loaded_target_bank"),
        pick(json_get_string("json", "$.sr"), F.col("loaded_source_region")).alias("loaded_source_region"),
        pick(json_get_string("json", "$.tr"), F.col("loaded_target_region")).alias("loaded_target_region"),
        pick(json_get_double("json", "$.a"), F.col("loaded_amount")).alias("loaded_amount"),
        pick(json_get_string("json", "$.c"), F.col("loaded_currency")).alias("loaded_currency"),
        pick(F.col("timestamp"), F.col("loaded_timestamp")).alias("loaded_timestamp"),
        pick(json_get_string("json", "$.s"), F.col("loaded_status")).alias("loaded_status"))


def cache_lookup(payee: DataFrame, cache: DataFrame, settlement: DataFrame,
                 ttl_ms: int = 5000) -> DataFrame:
    """Cache-else-table lookup of the settlement a payee message answers."""
    return resolve_cache(cache_join(payee, cache, ttl_ms), settlement)


def v8_validate(loaded: DataFrame, check_age: bool = False, check_active: bool = False) -> DataFrame:
    """Settlement validation; output columns come from the loaded settlement
    while the rules compare against the payee message's own columns."""
    return loaded.select(
        F.col("loaded_source_bank").alias("source_bank"),
        F.col("loaded_target_bank").alias("target_bank"),
        F.col("loaded_target_region").alias("target_region"),
        F.col("loaded_source_region").alias("source_region"),
        F.col("loaded_amount").alias("amount"),
        F.col("loaded_currency").alias("currency"),
        F.col("loaded_timestamp").alias("timestamp"),
        "payee_status", "_txnID",
        rules.settlement_rules(check_age, check_active).alias("failedMsg"))


V8_CONFIRMATION_COLS = ["source_bank", "target_bank", "source_region", "target_region", "amount",
                        "currency", "timestamp", "status", "_txnID"]


def v8_confirm(validated: DataFrame, settlement: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V8 SW2 tail: a settlement that passed validation gets its status from
    the payee answer (update-returning on ``_key == txnID``: no stored row, no
    answer) and the answer goes out as a Confirmation. Failed validations stop
    here. Returns (confirmations, status updates)."""
    passed = validated.filter(F.col("failedMsg").isNull()) \
                      .withColumn("_p_key", F.col("_txnID").cast("string"))
    stored = settlement.select(F.col("_key").alias("_p_key"))
    echo = passed.join(stored, "_p_key", "left_semi")
    conf = echo.select(*[c for c in V8_CONFIRMATION_COLS if c != "status"],
                       rules.payee_status(F.col("payee_status")).alias("status"))
    return conf.select(*V8_CONFIRMATION_COLS), status_updates(conf)
