"""Simplified clearing flow (V3/V4): no validation, regions inferred from bank names.

Every payment reserves its amount and is forwarded; SW1 keeps the settlements
whose target bank name maps to the region; SW2 maps the payee answer to a
status and re-derives the source region from the name; the confirmation
worker posts every confirmation of its region as accepted (the payer pays,
the payee is credited). Same operators as the full flow, other rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.config import DEFAULT, FlowConfig
from payflux.operators import accounts, rules
from payflux.plans import settlement

LEDGER_COLS = ["_key", "source_bank", "target_bank", "amount", "currency", "timestamp", "status"]
PAYER_COLS = ["source_bank", "target_bank", "amount", "currency", "timestamp", "status", "_txnID"]


@dataclass
class SimplifiedOutputs:
    settlements: DataFrame      # PW -> Settlements
    requests: DataFrame         # PaymentRequests rows (``_key`` = txn)
    reserve: DataFrame          # PW reserve deltas
    registered: DataFrame       # SW1 Settlement rows
    confirmations: DataFrame    # SW2 -> Confirmations
    settlement: DataFrame       # Settlement rows with their final status
    ledger: DataFrame
    payer: DataFrame            # PayerBankConfirmations, all ACCP
    deltas: DataFrame           # CW settle deltas
    banks: DataFrame            # Banks after every leg


def name_region(bank: str, cfg: FlowConfig = DEFAULT):
    return rules.region_by_name(F.col(bank), list(cfg.name_regions), cfg.name_default_region)


def payment_worker(payments: DataFrame, banks: DataFrame, cfg: FlowConfig = DEFAULT, event_time: str = "timestamp"):
    """Reserve every payment on its source bank; forward it with the source
    region from the bank name. Returns (settlements, requests, reserve deltas,
    next Banks). ``event_time`` names the column that ``eventTimestamp()`` stands
    for: the payload's own time, or the arrival that ``read_json_stream`` carries."""
    at = F.col(event_time).alias("timestamp")
    settlements = payments.select("source_bank", "target_bank", name_region("source_bank", cfg).alias("source_region"),
                                  "amount", "currency", at, "_txnID")
    requests = payments.select(F.col("_txnID").cast("string").alias("_key"), "source_bank", "target_bank",
                               "amount", "currency", at)
    reserve = accounts.reserve_deltas(payments)
    return settlements, requests, reserve, accounts.apply_deltas(banks, reserve)


def settlement_register(settlements: DataFrame, cfg: FlowConfig = DEFAULT,
                        region: str | None = None) -> DataFrame:
    """SW1: target region from the target bank name; the region's rows become
    active Settlement rows (``_key`` = txn)."""
    home = region or cfg.home_region
    return (settlements.withColumn("target_region", name_region("target_bank", cfg))
            .filter(F.col("target_region") == home)
            .select(F.col("_txnID").cast("string").alias("_key"), "source_bank", "target_bank",
                    "source_region", "amount", "currency", "timestamp", F.lit("active").alias("status"),
                    "_txnID"))


def settlement_confirm(payee: DataFrame, cfg: FlowConfig = DEFAULT, event_time: str = "timestamp") -> DataFrame:
    """SW2: payee answer to a status, source region re-derived from the name, at the event's time."""
    return payee.select("source_bank", "target_bank", name_region("source_bank", cfg).alias("source_region"),
                        "amount", "currency", F.col(event_time).alias("timestamp"),
                        rules.payee_status(F.col("status")).alias("status"), "_txnID")


def confirmation_worker(confirmations: DataFrame, banks: DataFrame, cfg: FlowConfig = DEFAULT,
                        region: str | None = None):
    """CW: every confirmation of the region is posted as accepted, whatever
    its status. Returns (ledger, payer confirmations, deltas, next Banks)."""
    home = region or cfg.home_region
    mine = confirmations.filter(F.col("source_region") == home)
    deltas = accounts.settle_deltas(mine)
    ledger = mine.select(F.col("_txnID").cast("string").alias("_key"), *LEDGER_COLS[1:])
    payer = mine.withColumn("status", F.lit("ACCP")).select(*PAYER_COLS)
    return ledger, payer, deltas, accounts.apply_deltas(banks, deltas)


def simplified_flow(payments: DataFrame, banks: DataFrame, cfg: FlowConfig = DEFAULT,
                    region: str | None = None) -> SimplifiedOutputs:
    settlements, requests, reserve, banks1 = payment_worker(payments, banks, cfg)
    registered = settlement_register(settlements, cfg, region)
    payee = settlement.bank_b_accept(settlement.transfers(registered))
    confirmations = settlement_confirm(payee, cfg)
    status = settlement.apply_status(registered, settlement.status_updates(confirmations))
    ledger, payer, deltas, banks2 = confirmation_worker(confirmations, banks1, cfg, region)
    return SimplifiedOutputs(settlements, requests, reserve, registered, confirmations, status,
                             ledger, payer, deltas, banks2)
