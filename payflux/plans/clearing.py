"""End-to-end clearing in batch: PW -> SW1 -> Bank B -> SW2 -> CW.

The stream hops collapse into DataFrame edges; each leg is the same function
the streaming jobs run per micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payflux.config import DEFAULT, FlowConfig
from payflux.plans import confirmation, payment, settlement


@dataclass
class ClearingOutputs:
    pw: payment.PaymentOutputs
    registered: DataFrame
    payee: DataFrame
    confirmations: DataFrame
    settlement: DataFrame
    cw: confirmation.ConfirmOutputs
    banks: DataFrame
    payer_confirmations: DataFrame


def clearing_flow(payments: DataFrame, banks: DataFrame, recorded: DataFrame,
                  presence: DataFrame, payee_answer=None,
                  cfg: FlowConfig = DEFAULT) -> ClearingOutputs:
    """Run every leg once. ``payee_answer`` maps Transfers to the payee's
    confirmations (default: Bank B auto-accepts)."""
    pw = payment.payment_worker(payments, banks, recorded, presence, cfg)
    registered = settlement.settlement_register(pw.settlements, cfg)
    payee = (payee_answer or settlement.bank_b_accept)(settlement.transfers(registered))
    confirmations, settled = settlement.settlement_confirm(payee, registered)
    cw = confirmation.confirmation_worker(confirmations, pw.banks, cfg)
    payer = (pw.rejections.select(*confirmation.PAYER_COLS)
             .unionByName(cw.payer))
    return ClearingOutputs(pw, registered, payee, confirmations, settled, cw, cw.banks, payer)


def stamp_entry(payments: DataFrame, now=None) -> DataFrame:
    """SLA monitor, entry side: PaymentsSLA -> Payments with ``timestamp`` =
    the time of entry (``currentTimeMillis()``, fixed per micro-batch)."""
    from payflux.functions.scalar import current_time_millis

    return payments.withColumn("timestamp", now if now is not None else current_time_millis())


def sla_latency(confirmed: DataFrame, confirm_ts: str = "confirm_ts") -> DataFrame:
    """SLA monitor: latency of a confirmation against the payment's entry stamp."""
    return confirmed.withColumn("latencyMs", F.col(confirm_ts) - F.col("timestamp"))


@dataclass
class ClearingOutputsV8:
    pw: payment.PaymentOutputs
    registered: DataFrame
    payee: DataFrame
    confirmations: DataFrame
    cw: confirmation.ConfirmOutputsV8
    banks: DataFrame


def clearing_flow_v8(payments: DataFrame, banks: DataFrame, presence: DataFrame,
                     cfg: FlowConfig | None = None) -> ClearingOutputsV8:
    """The V8 variant end to end: PW (TTL dedup, drop unknown banks), SW
    register (keyed insert + cache), Bank B, SW confirm (cache-else-table,
    validation, status update-returning), CW (payee-gated posting)."""
    from payflux.config import FlowConfig as _FC

    cfg = cfg or _FC(dedup="ttl", presence_check=False, unknown_bank="drop")
    empty = payments.sparkSession.createDataFrame([], "_txnID long")
    pw = payment.payment_worker(payments, banks, empty, presence, cfg)
    registered, cache = settlement.v8_register(pw.settlements, cfg)
    payee = settlement.bank_b_accept(settlement.transfers(registered))
    loaded = settlement.cache_lookup(payee, cache, registered, cfg.ttl_ms)
    confirmations, _ = settlement.v8_confirm(settlement.v8_validate(loaded), registered)
    cw = confirmation.confirmation_worker_v8(confirmations, pw.banks, cfg)
    return ClearingOutputsV8(pw, registered, payee, confirmations, cw, cw.banks)
