"""Keyed table mutations as delta aggregates joined to a snapshot.

Parquet has no UPDATE/MERGE, so every ``UPDATE ... SET x = x + d ON key``
becomes signed delta rows, one partial-aggregated ``groupBy(key).sum``
(map-side combine, so a hot account costs one row per map task) and a left
join to the current snapshot, producing the next snapshot. Money is summed as
DECIMAL(38,6) (exact, order independent) and stored back as double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payflux.operators.ordered import MONEY

DELTA_COLS = ("_key", "d_balance", "d_reserved")


def reserve_deltas(admitted: DataFrame) -> DataFrame:
    """PW: ``reserved += amount`` on the payer."""
    return admitted.select(F.col("source_bank").alias("_key"), F.lit(0.0).alias("d_balance"),
                           F.col("amount").alias("d_reserved"))


def settle_deltas(accepted: DataFrame) -> DataFrame:
    """CW accept: payer ``reserved -= a, balance -= a``; payee ``balance += a``."""
    a = F.col("amount")
    payer = accepted.select(F.col("source_bank").alias("_key"), (-a).alias("d_balance"),
                            (-a).alias("d_reserved"))
    payee = accepted.select(F.col("target_bank").alias("_key"), a.alias("d_balance"),
                            F.lit(0.0).alias("d_reserved"))
    return payer.unionByName(payee)


def release_deltas(rejected: DataFrame) -> DataFrame:
    """CW reject: payer ``reserved -= a``."""
    return rejected.select(F.col("source_bank").alias("_key"), F.lit(0.0).alias("d_balance"),
                           (-F.col("amount")).alias("d_reserved"))


def apply_deltas(table: DataFrame, deltas: DataFrame) -> DataFrame:
    """Next snapshot of an account table; rows without deltas are unchanged.

    A delta whose key is not in the table matches no row (the reference's
    UPDATE ... ON semantics), so it is dropped by the left join.
    """
    agg = (deltas.groupBy("_key")
           .agg(F.sum(F.col("d_balance").cast(MONEY)).alias("_db"),
                F.sum(F.col("d_reserved").cast(MONEY)).alias("_dr")))
    j = table.join(agg, "_key", "left")
    zero = F.lit(0).cast(MONEY)
    bal = (F.col("balance").cast(MONEY) + F.coalesce(F.col("_db"), zero)).cast("double")
    res = (F.col("reserved").cast(MONEY) + F.coalesce(F.col("_dr"), zero)).cast("double")
    return j.withColumn("balance", bal).withColumn("reserved", res).drop("_db", "_dr")


def update_returning(table: DataFrame, requests: DataFrame, req_key: str,
                     deltas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``FOR doc FILTER doc._key == @k UPDATE ... RETURN {bind values}``.

    Returns (next snapshot, echo rows). A request whose key matches no
    document yields no echo row, so the flow after it stops.
    """
    echo = requests.join(table.select(F.col("_key").alias(req_key)), req_key, "left_semi")
    return apply_deltas(table, deltas), echo


def last_write_wins(table: DataFrame, updates: DataFrame, key: str, value: str,
                    order: str) -> DataFrame:
    """``UPDATE t SET value = v ON t.key == key``: the latest update per key wins.

    ``max_by`` is a partial aggregate, so a hot key does not gather its updates.
    """
    last = (updates.groupBy(key)
            .agg(F.max_by(F.col(value), F.struct(F.col(order), F.col(value))).alias("_new")))
    j = table.join(last, key, "left")
    return j.withColumn(value, F.coalesce(F.col("_new"), F.col(value))).drop("_new")


def reset_balances(banks: DataFrame, balance: float = 10000, reserved: float = 0) -> DataFrame:
    """``UPDATE bank WITH {balance: 10000, reserved: 0}`` for every row, in the type of ``apply_deltas``."""
    return banks.withColumn("balance", F.lit(balance).cast("double")) \
                .withColumn("reserved", F.lit(reserved).cast("double"))


def truncate(table: DataFrame) -> DataFrame:
    """``FOR l IN Ledger REMOVE l``: the next snapshot is empty, same schema."""
    return table.filter(F.lit(False))


def totals(banks: DataFrame) -> DataFrame:
    """Invariant query: number of banks, total balance, total reserved."""
    return banks.agg(*total_columns())


def total_columns() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_banks"), F.sum("balance").alias("total_balance"),
            F.sum("reserved").alias("total_reserved")]
