"""Payment worker (leg 1): dedup, enrich, presence, validate, admit, reserve.

One batch (or micro-batch) of payments produces every output of the leg at
once; the account table is read as the snapshot current at batch start and
the next snapshot is returned, never updated in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.config import DEFAULT, FlowConfig
from payflux.operators import accounts, enrich, rules
from payflux.operators.dedup import dedup_durable, dedup_ttl
from payflux.operators.ordered import ordered_admission

FAILED_COLS = ["_txnID", "source_bank", "target_bank", "amount", "currency", "timestamp", "message"]
SETTLEMENT_COLS = ["source_bank", "target_bank", "amount", "currency", "timestamp",
                   "source_region", "target_region", "_txnID"]
REQUEST_COLS = ["source_bank", "target_bank", "amount", "currency", "timestamp", "_txnID"]


@dataclass
class PaymentOutputs:
    settlements: DataFrame        # Settlements sink (leg 2 input)
    requests: DataFrame           # rows appended to PaymentRequests
    failed: DataFrame             # PaymentFailed (presence + rule + funds failures)
    rejections: DataFrame         # PayerBankConfirmations, status RJCT
    reserve: DataFrame            # reserve deltas on Banks
    banks: DataFrame              # next Banks snapshot
    checked: DataFrame            # every candidate with failedMsg (after presence)
    decided: DataFrame | None = None  # fold candidates with ``admitted`` (persisted fan-out)

    def release(self) -> None:
        """Drop the leg's fan-out caches (once its outputs are written)."""
        self.checked.unpersist()
        if self.decided is not None:
            self.decided.unpersist()


def enrich_and_check(payments: DataFrame, banks: DataFrame, presence: DataFrame,
                     cfg: FlowConfig = DEFAULT) -> DataFrame:
    """Target region, presence flag, source bank columns and the rule verdict
    without the funds rule (funds are applied in event order afterwards)."""
    cache = enrich.bank_cache(banks)
    with_target = enrich.enrich_target_region(payments, cache)
    if cfg.presence_check:
        with_presence = enrich.presence_flag(with_target, presence, cfg)
    else:
        with_presence = with_target.withColumn("isDevicePresent", F.lit(True))
    with_bank = enrich.enrich_source_bank(with_presence, banks)
    return rules.validate_payment(with_bank, cfg, check_funds=False)


def admit(checked: DataFrame, banks: DataFrame, cfg: FlowConfig = DEFAULT) -> DataFrame:
    """Apply the funds rule in ``(timestamp, _txnID)`` order per source bank.

    Rows that failed an earlier rule or the presence check never reach the fold;
    unknown source banks bypass it (rule one passes them). Returns the
    candidates with ``admitted``.
    """
    known, funds = candidates_and_funds(checked, banks)
    return ordered_admission(known, funds, "source_bank", "timestamp", "_txnID", "amount",
                             cfg.fold_group_rows, cfg.hot_key_segments)


def candidates_and_funds(checked: DataFrame, banks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payments that ask for funds, and the free funds per account."""
    ok = checked.filter(F.col("isDevicePresent") & F.col("failedMsg").isNull())
    known = ok.filter(F.col("source_balance").isNotNull() | F.col("source_total_reserved").isNotNull()
                      | F.col("source_region").isNotNull())
    funds = banks.select(F.col("_key").alias("source_bank"),
                         (F.col("balance") - F.col("reserved")).alias("free"))
    return known, funds


def payment_worker(payments: DataFrame, banks: DataFrame, recorded: DataFrame,
                   presence: DataFrame, cfg: FlowConfig = DEFAULT) -> PaymentOutputs:
    if cfg.dedup == "ttl":
        distinct = dedup_ttl(payments, "_txnID", "timestamp", "timestamp", cfg.ttl_ms, cfg.fold_group_rows)
    else:
        distinct = dedup_durable(payments, recorded)
    # fan-out point: presence failures, rule failures, the fold and the unknown
    # banks all read it, so it is computed once (spills to disk, recomputed
    # from lineage if an executor is lost)
    checked = enrich_and_check(distinct, banks, presence, cfg).persist(StorageLevel.MEMORY_AND_DISK)

    not_present = checked.filter(~F.col("isDevicePresent")).withColumn(
        "message", F.lit(rules.MSG_NOT_PRESENT))
    rule_failed = checked.filter(F.col("isDevicePresent") & F.col("failedMsg").isNotNull()) \
                         .withColumn("message", F.col("failedMsg"))
    # second fan-out point: settlements, requests, reserve deltas and the
    # funds failures all read the admission decisions
    decided = admit(checked, banks, cfg).persist(StorageLevel.MEMORY_AND_DISK)
    funds_failed = decided.filter(~F.col("admitted")).withColumn("message", F.lit(rules.MSG_FUNDS))
    admitted_known = decided.filter("admitted").drop("admitted")

    passed = admitted_known
    if cfg.unknown_bank == "pass":
        unknown = checked.filter(
            F.col("isDevicePresent") & F.col("failedMsg").isNull() & F.col("source_balance").isNull()
            & F.col("source_total_reserved").isNull() & F.col("source_region").isNull())
        passed = passed.unionByName(unknown)

    failed = (not_present.select(*FAILED_COLS)
              .unionByName(rule_failed.select(*FAILED_COLS))
              .unionByName(funds_failed.select(*FAILED_COLS)))
    rejections = payer_rejections(failed)
    reserve = accounts.reserve_deltas(admitted_known)
    settlements = passed.select(*SETTLEMENT_COLS)
    if cfg.settlement_amount is not None:
        settlements = settlements.withColumn("amount", F.lit(float(cfg.settlement_amount)))
    return PaymentOutputs(
        settlements=settlements,
        requests=passed.select(*REQUEST_COLS),
        failed=failed, rejections=rejections, reserve=reserve,
        banks=accounts.apply_deltas(banks, reserve), checked=checked, decided=decided)


def payer_rejections(failed: DataFrame) -> DataFrame:
    """PaymentFailed -> PayerBankConfirmations with status RJCT and the message."""
    return failed.select("_txnID", "source_bank", "target_bank", "amount", "currency",
                         F.lit("RJCT").alias("status"), "timestamp", "message")
