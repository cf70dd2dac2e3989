"""Confirmation worker (leg 4): post settled payments, release failed ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from payflux.config import DEFAULT, FlowConfig
from payflux.operators import accounts, enrich

LEDGER_COLS = ["settlement_id", "source_bank", "target_bank", "amount", "currency", "timestamp",
               "status", "_txnID"]
PAYER_COLS = ["source_bank", "target_bank", "amount", "currency", "timestamp", "status", "_txnID"]


@dataclass
class ConfirmOutputs:
    accepted: DataFrame
    rejected: DataFrame
    unrouted: DataFrame     # status NULL: neither P nor not(P) holds
    ledger: DataFrame
    payer: DataFrame        # PayerBankConfirmations ACCP / RJCT
    deltas: DataFrame
    banks: DataFrame        # next Banks snapshot


def split(df: DataFrame, pred) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Complementary split P / not(P). A NULL predicate satisfies neither, so
    those rows are returned as a third, ``unrouted`` output instead of vanishing."""
    return df.filter(pred), df.filter(~pred), df.filter(pred.isNull())


def write_split(df: DataFrame, pred, path: str) -> dict[str, int]:
    """Write a complementary split in one pass, one folder ``route=`` per output, and return what was counted
    on the way: ``input``, ``accepted``, ``rejected`` and ``unrouted`` (a NULL predicate). The input is read once:
    the counts are metrics that ``observe`` collects while the rows are written."""
    route = F.when(pred, F.lit("accepted")).when(~pred, F.lit("rejected")).otherwise(F.lit("unrouted"))
    seen = Observation()
    names = ("accepted", "rejected", "unrouted")
    (df.withColumn("route", route)
     .observe(seen, F.count(F.lit(1)).alias("input"), *[F.count_if(F.col("route") == n).alias(n) for n in names])
     .write.mode("overwrite").partitionBy("route").parquet(path))
    counts = seen.get
    if counts["input"] != sum(counts[n] for n in names):
        raise RuntimeError(f"split lost rows: {counts}")
    return counts


def in_region(confirmations: DataFrame, banks: DataFrame, cfg: FlowConfig = DEFAULT) -> DataFrame:
    """Source region from the bank cache, then keep the region's confirmations."""
    c = confirmations.drop("source_region") if "source_region" in confirmations.columns else confirmations
    cache = enrich.bank_cache(banks).select(F.col("_key").alias("_sk"), F.col("region").alias("source_region"))
    j = c.join(cache, c.source_bank == cache._sk, "left").drop("_sk")
    return j.filter(F.col("source_region") == cfg.home_region)


def confirmation_worker(confirmations: DataFrame, banks: DataFrame,
                        cfg: FlowConfig = DEFAULT) -> ConfirmOutputs:
    valid = in_region(confirmations, banks, cfg)
    accepted, rejected, unrouted = split(valid, F.col("status") == "settled")
    deltas = accounts.settle_deltas(accepted).unionByName(accounts.release_deltas(rejected))
    ledger = accepted.select(*LEDGER_COLS).unionByName(rejected.select(*LEDGER_COLS))
    payer = (accepted.withColumn("status", F.lit("ACCP")).select(*PAYER_COLS)
             .unionByName(rejected.withColumn("status", F.lit("RJCT")).select(*PAYER_COLS)))
    return ConfirmOutputs(accepted, rejected, unrouted, ledger, payer, deltas,
                          accounts.apply_deltas(banks, deltas))


@dataclass
class ConfirmOutputsV8:
    posted: DataFrame       # confirmations whose payee bank answered (OutputPerf)
    ledger: DataFrame
    deltas: DataFrame
    banks: DataFrame


def confirmation_worker_v8(confirmations: DataFrame, banks: DataFrame,
                           cfg: FlowConfig = DEFAULT, ledger_after: str = "target") -> ConfirmOutputsV8:
    """V8 CW: every confirmation of the region credits the payee
    (update-returning on ``_key == target_bank``); only when the payee answers
    is the payer debited (balance and reserved). The ledger row hangs off the
    payee's answer (``ledger_after='target'``, V8) or off the payer's answer
    too (``'source'``, the per-leg perf rig: both banks must exist). The
    status is not consulted."""
    mine = confirmations.filter(F.col("source_region") == cfg.home_region)
    credit = mine.select(F.col("target_bank").alias("_key"), F.col("amount").alias("d_balance"),
                         F.lit(0.0).alias("d_reserved"))
    _, answered = accounts.update_returning(banks, mine, "target_bank", credit)
    debit = answered.select(F.col("source_bank").alias("_key"), (-F.col("amount")).alias("d_balance"),
                            (-F.col("amount")).alias("d_reserved"))
    deltas = credit.unionByName(debit)
    if ledger_after == "source":
        answered = answered.join(banks.select(F.col("_key").alias("source_bank")), "source_bank", "left_semi")
    ledger = answered.select("source_bank", "target_bank", "amount", "currency", "timestamp",
                             F.lit("settled").alias("status"), "_txnID")
    posted = answered.select("source_bank", "target_bank", "_txnID")
    return ConfirmOutputsV8(posted, ledger, deltas, accounts.apply_deltas(banks, deltas))
