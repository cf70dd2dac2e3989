"""Clearing inputs derived from the driver's read-only tables.

The reference ships no data, so its streams and tables are derived from the
TPC-H-like tables (rules in FIXTURES.md section 2). The DuckDB oracle derives
the very same rows in ``payflux.oracle_sql``. Every frame here is a lazy scan
plus projections, so Catalyst prunes columns and pushes filters to parquet.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payflux.functions.scalar import epoch_millis


_SHARED = []


def _shared(fn):
    """One frame object per (session, dir): every consumer of a fixture in a
    flow shares the same plan subtree, so Spark reuses its exchanges."""
    cached = lru_cache(maxsize=None)(fn)
    _SHARED.append(cached)
    return cached


def clear_shared() -> None:
    for f in _SHARED:
        f.cache_clear()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bank_key(col: Column, prefix: str = "Bank_") -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


@_shared
def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Banks table: one account per customer; region from nation -> region."""
    return banks_of(read_table(spark, sf_dir, "customer"), spark, sf_dir)


def banks_of(customers: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts of a batch or streaming frame of customers."""
    c = customers.select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions at every scale
    n = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    r = F.broadcast(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        _bank_key(F.col("c_custkey")).alias("_key"),
        F.col("c_custkey").cast("string").alias("uuid"),
        F.col("c_name").alias("name"),
        F.round(F.col("c_acctbal") * 20).cast("bigint").alias("balance"),
        F.lit(0).cast("bigint").alias("reserved"),
        F.lit("USD").alias("currency"),
        F.when(F.col("c_custkey") % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("region"),
    )


def _target_modulus(spark: SparkSession, sf_dir: str) -> Column:
    """M = 16/15 of the customer count: a scalar subquery, so some targets are unknown."""
    cust = read_table(spark, sf_dir, "customer")
    return cust.select(F.expr("count(1) * 16 div 15")).scalar()


def _bank_name(col: Column) -> Column:
    """The ``name`` of the bank derived from customer ``col`` (its ``c_name``)."""
    return F.concat(F.lit("Customer#"), F.lpad(col.cast("string"), 9, "0"))


def _payment_cols(m: Column, by_name: bool = False) -> list[Column]:
    """Payment columns; ``by_name`` refers to banks by ``name`` (V1) instead of ``_key``."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    ref = _bank_name if by_name else _bank_key
    unknown = F.concat(F.lit("Unknown#"), cust.cast("string")) if by_name else _bank_key(cust, "Bank_X")
    return [
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 41 == 0, unknown)
         .otherwise(ref(cust)).alias("source_bank"),
        F.when(k % 53 == 0, F.lit(None).cast("string"))
         .otherwise(ref((cust * 7 + k) % m)).alias("target_bank"),
        F.when(k % 59 == 0, F.lit(None).cast("double"))
         .when(k % 61 == 0, F.lit(-1.0))
         .otherwise(F.col("o_totalprice") / 4).alias("amount"),
        F.when(k % 17 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
        k.alias("_txnID"),
        epoch_millis("o_orderdate").alias("timestamp"),
    ]


@_shared
def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments stream (V2 schema); ``(timestamp, _txnID)`` is a total order."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(*_payment_cols(_target_modulus(spark, sf_dir)))


@_shared
def payments_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 Payments: the same rows, banks referred to by ``name``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(*_payment_cols(_target_modulus(spark, sf_dir), by_name=True))


@_shared
def payee_confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank B answers: RJCT for finished orders; some amounts/targets disagree."""
    o = read_table(spark, sf_dir, "orders")
    p = o.select(*_payment_cols(_target_modulus(spark, sf_dir)),
                 F.when(F.col("o_orderstatus") == "F", "RJCT").otherwise("ACCP").alias("status"))
    t = F.col("_txnID")
    return p.select(
        "source_bank",
        F.when(t % 43 == 0, F.lit("Bank_Other")).otherwise(F.col("target_bank")).alias("target_bank"),
        F.when(t % 37 == 0, F.col("amount") + 1).otherwise(F.col("amount")).alias("amount"),
        "currency", "timestamp", "status", "_txnID")


@_shared
def payment_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retried payments: each order's line items are re-sends 2 s apart."""
    return retries_of(read_table(spark, sf_dir, "lineitem"))


def retries_of(li: DataFrame) -> DataFrame:
    """The retried payments of a batch or streaming frame of line items."""
    return li.select(
        F.col("l_orderkey").alias("_txnID"),
        F.col("l_linenumber").cast("bigint").alias("attempt"),
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 2000).alias("timestamp"),
        F.col("l_extendedprice").alias("amount"),
    )


@_shared
def payment_resends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 Payments with re-sends: each line item of an order re-sends the
    order's payment, ``(l_linenumber - 1) * 2 s`` after the first."""
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("_txnID"), "l_linenumber")
    p = payments(spark, sf_dir)
    j = p.join(li, "_txnID")
    return j.select("source_bank", "target_bank", "amount", "currency", "_txnID",
                    (F.col("timestamp") + (F.col("l_linenumber") - 1) * 2000).alias("timestamp"))


@_shared
def payment_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PaymentRequests table: payments already recorded (every tenth txn)."""
    return payments(spark, sf_dir).filter(F.col("_txnID") % 10 == 0).select(
        "source_bank", "target_bank", "amount", "currency", "timestamp", "_txnID")


@_shared
def bank_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BanksCache: ``(_key, region)`` of every bank."""
    return banks(spark, sf_dir).select("_key", "region")


@_shared
def settlement_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settlement table (V8 layout): payments except every 31st txn."""
    p = payments(spark, sf_dir).filter(F.col("_txnID") % 31 != 0)
    reg = bank_regions(spark, sf_dir)
    src = reg.select(F.col("_key").alias("_sk"), F.col("region").alias("source_region"))
    tgt = reg.select(F.col("_key").alias("_tk"), F.col("region").alias("target_region"))
    j = (p.join(src, p.source_bank == src._sk, "left")
          .join(tgt, p.target_bank == tgt._tk, "left"))
    t = F.col("_txnID")
    return j.select(
        t.cast("string").alias("_key"), t.alias("settlement_id"), "source_bank", "target_bank",
        "source_region", "target_region", "amount", "currency", "timestamp",
        F.when(t % 29 == 0, F.lit("settled")).otherwise(F.lit("active")).alias("status"),
        t.alias("_txnID"))


@_shared
def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live consumers per region; MIDDLE EAST has none (region outage)."""
    r = read_table(spark, sf_dir, "region")
    return r.filter(F.col("r_name") != "MIDDLE EAST").select(
        F.lit("Transfers").alias("stream"),
        F.col("r_name").alias("region"),
        F.concat(F.lower(F.regexp_replace("r_name", " ", "-")), F.lit("-sub1")).alias("subscriber"))


@_shared
def count_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CountStream: ``c`` = event id, ``t`` = event time in epoch millis."""
    return count_events_of(read_table(spark, sf_dir, "events"))


def count_events_of(e: DataFrame) -> DataFrame:
    """The counted events of a batch or streaming frame of events."""
    return e.select(F.col("event_id").alias("c"), epoch_millis("ts").alias("t"))


@_shared
def error_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ErrorStream payloads: whole JSON text per event, an error for even counts."""
    e = read_table(spark, sf_dir, "events")
    c = F.col("event_id")
    err = F.when(c % 2 == 0, F.concat(
        F.lit(',"error":"{\\"message\\":\\"Count is Even.\\",\\"code\\":'),
        (c % 7).cast("string"), F.lit('}"'))).otherwise(F.lit(""))
    evt = F.concat(F.lit('{"c":'), c.cast("string"), F.lit(',"t":'),
                   epoch_millis("ts").cast("string"), F.lit(',"type":"'),
                   F.coalesce(F.col("event_type"), F.lit("")), F.lit('"'), err, F.lit("}"))
    return e.select(c.alias("event_id"), evt.alias("evt"))


@_shared
def payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment payloads as lines of JSON, some cut off, some no JSON, some with a value of another type."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    line = F.concat(F.lit('{"_txnID":'), k.cast("string"), F.lit(',"source_bank":'),
                    F.when(k % 13 == 0, F.lit("null")).otherwise(F.concat(F.lit('"Bank_'), F.col("o_custkey").cast("string"), F.lit('"'))),
                    F.lit(',"cents":'), F.when(k % 29 == 0, F.lit('"many"')).otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")),
                    F.lit("}"))
    return o.select(F.when(k % 19 == 0, F.substr(line, F.lit(1), F.length(line) - 5)).when(k % 23 == 0, F.concat(F.lit("lost "), k.cast("string")))
                    .otherwise(line).alias("value"))


@_shared
def nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested JSON; some cut off, some in single quotes."""
    e = read_table(spark, sf_dir, "events")
    c = F.col("event_id")
    error = F.when(c % 2 == 0, F.concat(F.lit(',"error":{"code":'), (c % 7).cast("string"), F.lit(',"message":"Count is Even."}'))).otherwise(F.lit(""))
    evt = F.concat(F.lit('{"c":'), c.cast("string"), F.lit(',"tags":["'), F.coalesce("event_type", F.lit("")), F.lit('","t'), (c % 5).cast("string"),
                   F.lit('"]'), error, F.lit("}"))
    broken = F.when(c % 11 == 0, F.substr(evt, F.lit(1), F.length(evt) - 1)).when(c % 17 == 0, F.translate(evt, '"', "'")).otherwise(evt)
    return e.select(c.alias("event_id"), broken.alias("evt"))


@_shared
def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers and the pattern of the account names they follow: by start, end, middle and length."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    digits = lambda n: F.lpad((k % (10 ** n)).cast("string"), n, "0")
    pattern = (F.when(k % 4 == 0, F.concat(F.lit("Customer#0000"), digits(4), F.lit("%")))
               .when(k % 4 == 1, F.concat(F.lit("%"), digits(3)))
               .when(k % 4 == 2, F.concat(F.lit("%#"), F.lit("000"), digits(3), F.lit("__%")))
               .otherwise(F.concat(F.lit("_%0"), digits(3), F.lit("_"))))
    return s.select(F.concat(F.lit("sub"), k.cast("string")).alias("subscriber"), pattern.alias("pattern"))
