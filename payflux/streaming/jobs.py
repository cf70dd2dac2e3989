"""Streaming clearing jobs: the batch operators run per micro-batch.

Each leg of the reference is one streaming query over a folder of JSON
files. Legs that mutate tables run in ``foreachBatch``: they read the
committed state *at batch time* (a stream-static join would read it once),
compute every output and append table rows, account deltas and the outgoing
events (an outbox table per sink) with one commit record
(``TableStore.commit``); only committed events are then published under
``batch=<id>``. A replayed batch id that is already committed is published
again and otherwise skipped; a batch that failed before its commit has
published nothing and is redone from scratch, and the downstream legs are
idempotent per transaction (SW1 rows are read first
per key, the confirmation worker posts a transaction once). Stateless legs
(Bank B, SLA monitor, error handler) are plain file-to-file streams, exactly
once through the file sink's metadata log.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payflux import schemas
from payflux.config import DEFAULT, FlowConfig
from payflux.functions.scalar import current_time_millis
from payflux.operators import accounts, enrich, errors
from payflux.operators.dedup import dedup_durable, first_per_key
from payflux.plans import clearing, confirmation, payment, settlement
from payflux.sources import streams
from payflux.streaming import ttl
from payflux.streaming.store import TableStore

BatchFn = Callable[[DataFrame, int], None]

# micro-batches of the payment worker between two compactions of Banks
COMPACT_EVERY = 200


# --------------------------------------------------------------------------- state views

def bank_state(store: TableStore, only=None) -> DataFrame:
    """Banks now: the latest base plus every committed reserve/settle/release delta.

    ``only`` (an ``enrich.key_filter``) cuts base and deltas to the accounts a
    micro-batch touches *before* the fold, so no batch shuffles every account.
    """
    if only is None:
        return store.state("banks", "bank_deltas", schemas.BANK_DELTAS, accounts.apply_deltas)
    return store.state("banks", "bank_deltas", schemas.BANK_DELTAS,
                       lambda base, d: accounts.apply_deltas(only(base, "_key"), only(d, "_key")))


def compact_banks(store: TableStore) -> int:
    """Fold committed account deltas into a new Banks base version."""
    return store.compact("banks", "bank_deltas", schemas.BANK_DELTAS, accounts.apply_deltas)


def settlement_state(store: TableStore) -> DataFrame:
    """Settlement now: SW1 inserts (first row per transaction) with the last
    SW2 status update applied."""
    rows = first_per_key(store.appended("settlement", schemas.SETTLEMENT_V2), "_txnID", ["timestamp"])
    return settlement.apply_status(rows, store.appended("settlement_status", schemas.SETTLEMENT_STATUS))


def reset_banks(store: TableStore, balance: int = 10000, reserved: int = 0) -> int:
    """``UPDATE bank WITH {balance, reserved}`` for every account, committed as a new base."""
    return store.rewrite("banks", "bank_deltas", schemas.BANK_DELTAS, accounts.apply_deltas,
                         lambda banks: accounts.reset_balances(banks, balance, reserved))


def _bank_keys(batch: DataFrame) -> DataFrame:
    """Every account a micro-batch reads or moves money on."""
    return batch.select(F.col("source_bank").alias("_key")).unionByName(
        batch.select(F.col("target_bank").alias("_key")))


def _sink(df: DataFrame, root: str, batch_id: int) -> None:
    streams.write_json(df, f"{root}/batch={batch_id}", "overwrite")


def _outbox(**outgoing: DataFrame) -> dict[str, DataFrame]:
    """The outgoing events of a batch as tables of its commit, one per sink."""
    return {f"outbox_{name}": df for name, df in outgoing.items()}


def _publish(store: TableStore, batch_id: int, sinks: dict[str, str]) -> None:
    """Write the committed outgoing events of a batch to their sinks (idempotent)."""
    for name, path in sinks.items():
        rows = store.batch_rows(f"outbox_{name}", batch_id)
        if rows is not None:
            _sink(rows, path, batch_id)


def _once(store: TableStore, body: BatchFn, sinks: dict[str, str] | None = None,
          dead_letter: str | None = None, after: Callable[[int], None] | None = None) -> BatchFn:
    """Run ``body`` (which commits) unless the batch is empty or committed
    already, then publish what the batch has committed. The batch is persisted
    (every output of a leg reads it). A failure to publish stops the query; the
    replay publishes again. ``after`` is upkeep of the tables once a batch is
    published, outside of what a dead letter guards."""
    if dead_letter:
        body = with_dead_letter(body, dead_letter, store)

    def run(batch: DataFrame, batch_id: int) -> None:
        if not store.is_committed(batch_id):
            if batch.isEmpty():
                return
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                body(batch, batch_id)
            finally:
                batch.unpersist()
        _publish(store, batch_id, sinks or {})
        if after is not None:
            after(batch_id)

    return run


def with_dead_letter(body: BatchFn, dead_letter: str, store: TableStore | None = None) -> BatchFn:
    """``OnError.action='stream'`` for sinks and tables: a batch whose writes
    fail is not committed and publishes nothing; its events go to the
    dead-letter folder with the error text instead of stopping the query."""

    def run(batch: DataFrame, batch_id: int) -> None:
        try:
            body(batch, batch_id)
        except Exception as e:  # noqa: BLE001 - routed, not swallowed
            if store is not None:
                if store.is_committed(batch_id):
                    raise  # its rows stand in the tables: neither taken back nor dead-lettered
                store.discard(batch_id)
            (batch.select(streams.json_payload(batch.columns).alias("event"), F.lit(f"{type(e).__name__}: {e}").alias("error"))
             .write.mode("overwrite").json(f"{dead_letter}/batch={batch_id}"))

    return run


def _drain(legs: list[Callable[[], StreamingQuery]], timeout_s: float | None = None) -> None:
    """Run the legs one after another, each until its source is drained. With
    ``timeout_s`` a leg that is still running then is stopped and reported."""
    for start in legs:
        q = start()
        done = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
        if q.exception() is not None:
            raise RuntimeError(f"leg {q.name or q.id} failed") from q.exception()
        if not done:
            q.stop()
            raise TimeoutError(f"leg {q.name or q.id} was not drained within {timeout_s} s")


def _start(src: DataFrame, body: BatchFn, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = src.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


# --------------------------------------------------------------------------- leg 1: payment worker

def payment_batch(store: TableStore, presence: DataFrame, cfg: FlowConfig,
                  sinks: dict[str, str], dead_letter: str | None = None) -> BatchFn:
    """``foreachBatch`` body of the payment worker. Every ``COMPACT_EVERY``
    micro-batches it also folds the committed account deltas into a new base,
    so that state reads stay short (this job alone does so: one writer)."""

    def body(batch: DataFrame, batch_id: int) -> None:
        # only the accounts and recorded txns this micro-batch touches
        banks = bank_state(store, enrich.key_filter(_bank_keys(batch))).persist(StorageLevel.MEMORY_AND_DISK)
        recorded = enrich.restrict_to_keys(store.appended("requests", schemas.PAYMENT_REQUESTS),
                                           batch.select("_txnID"), "_txnID")
        if cfg.dedup == "ttl":
            # V8: a re-send within the TTL of its txn's last kept copy (earlier
            # batches) is dropped; within the batch the operator applies the TTL
            batch = ttl.suppress_within_ttl(store, batch, "_txnID", "timestamp", cfg.ttl_ms)
        out = payment.payment_worker(batch, banks, recorded, presence, cfg)
        appends = {"requests": out.requests, "bank_deltas": out.reserve,
                   **_outbox(settlements=out.settlements, payer_confirmations=out.rejections)}
        if cfg.dedup == "ttl":
            appends["ttl_kept"] = ttl.kept_times(out.checked, "_txnID", "timestamp")
        store.commit(batch_id, appends)
        out.release()  # the leg's fan-out caches live for one micro-batch
        banks.unpersist()

    def compact(batch_id: int) -> None:
        if batch_id and batch_id % COMPACT_EVERY == 0:
            compact_banks(store)

    return _once(store, body, sinks, dead_letter, compact)


def start_payment_worker(spark: SparkSession, payments_path: str, store: TableStore,
                         presence: DataFrame, sinks: dict[str, str], checkpoint: str,
                         cfg: FlowConfig = DEFAULT, max_files_per_trigger: int | None = None,
                         available_now: bool = True, dead_letter: str | None = None) -> StreamingQuery:
    """Start the leg-1 stream. ``max_files_per_trigger`` bounds each micro-batch,
    which also bounds the per-bank admission groups."""
    src = streams.read_json_stream(spark, payments_path, schemas.PAYMENTS, max_files_per_trigger)
    if cfg.dedup == "ttl":
        ttl.ensure_ttl_state(store, src, "_txnID")
    return _start(src, payment_batch(store.for_job("pw"), presence, cfg, sinks, dead_letter), checkpoint, available_now)


# --------------------------------------------------------------------------- leg 2: SW1, Bank B

def settlement_batch(store: TableStore, cfg: FlowConfig, sinks: dict[str, str],
                     region: str | None = None, dead_letter: str | None = None) -> BatchFn:
    """SW1: register settlements of the region as active rows, request Bank B."""

    def body(batch: DataFrame, batch_id: int) -> None:
        reg = settlement.settlement_register(batch, cfg, region).persist(StorageLevel.MEMORY_AND_DISK)
        store.commit(batch_id, {"settlement": reg, **_outbox(transfers=settlement.transfers(reg))})
        reg.unpersist()

    return _once(store, body, sinks, dead_letter)


def start_settlement_worker(spark: SparkSession, settlements_path: str, store: TableStore,
                            sinks: dict[str, str], checkpoint: str, cfg: FlowConfig = DEFAULT,
                            region: str | None = None, available_now: bool = True,
                            dead_letter: str | None = None) -> StreamingQuery:
    src = streams.read_json_stream(spark, settlements_path, schemas.SETTLEMENTS)
    return _start(src, settlement_batch(store.for_job("sw1"), cfg, sinks, region, dead_letter), checkpoint, available_now)


def start_bank_b(spark: SparkSession, transfers_path: str, out_path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Bank B auto-accepts every transfer (stateless file-to-file stream)."""
    src = streams.read_json_stream(spark, transfers_path, schemas.TRANSFERS)
    return streams.start_json_sink(settlement.bank_b_accept(src), out_path, checkpoint, available_now)


# --------------------------------------------------------------------------- leg 3: SW2

def settlement_confirm_batch(store: TableStore, sinks: dict[str, str],
                             dead_letter: str | None = None) -> BatchFn:
    """SW2: status from the payee answer; status update rows and Confirmations."""

    def body(batch: DataFrame, batch_id: int) -> None:
        conf = settlement.confirmation_rows(batch)
        store.commit(batch_id, {"settlement_status": settlement.status_updates(conf), **_outbox(confirmations=conf)})

    return _once(store, body, sinks, dead_letter)


def start_settlement_confirm(spark: SparkSession, payee_path: str, store: TableStore,
                             sinks: dict[str, str], checkpoint: str,
                             available_now: bool = True, dead_letter: str | None = None) -> StreamingQuery:
    src = streams.read_json_stream(spark, payee_path, schemas.PAYEE_CONFIRMATIONS)
    return _start(src, settlement_confirm_batch(store.for_job("sw2"), sinks, dead_letter), checkpoint, available_now)


# --------------------------------------------------------------------------- V8 settlement worker

def settlement_v8_state(store: TableStore, only=None) -> DataFrame:
    """V8 Settlement now: registered rows (first per transaction) with the
    last status update applied; ``only`` cuts both to a batch's transactions."""
    cut = (lambda t: t) if only is None else (lambda t: only(t, "_txnID"))
    rows = first_per_key(cut(store.appended("settlement_v8", schemas.SETTLEMENT)), "_txnID", ["timestamp"])
    return settlement.apply_status(
        rows, cut(store.appended("settlement_v8_status", schemas.SETTLEMENT_STATUS)))


def v8_register_batch(store: TableStore, cfg: FlowConfig, sinks: dict[str, str],
                      region: str | None = None, dead_letter: str | None = None) -> BatchFn:
    """V8 SW, first half: insert-returning of Settlement rows, then Transfers."""

    def body(batch: DataFrame, batch_id: int) -> None:
        # keyed insert: transactions registered by earlier batches are not inserted again
        existing = settlement_v8_state(store, enrich.key_filter(batch.select("_txnID")))
        rows, _ = settlement.v8_register(batch, cfg, region, existing=existing)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        store.commit(batch_id, {"settlement_v8": rows, **_outbox(transfers=settlement.transfers(rows))})
        rows.unpersist()

    return _once(store, body, sinks, dead_letter)


def v8_confirm_batch(store: TableStore, sinks: dict[str, str], dead_letter: str | None = None) -> BatchFn:
    """V8 SW, second half, per micro-batch of (payee message, cached JSON):
    misses read the committed Settlement table, then validate, update the
    status and confirm."""

    def body(joined: DataFrame, batch_id: int) -> None:
        only = enrich.key_filter(joined.select("_txnID"))
        table = settlement_v8_state(store, only).persist(StorageLevel.MEMORY_AND_DISK)
        checked = settlement.v8_validate(settlement.resolve_cache(joined, table))
        conf, _ = settlement.v8_confirm(checked, table)
        conf = conf.persist(StorageLevel.MEMORY_AND_DISK)
        store.commit(batch_id, {"settlement_v8_status": settlement.status_updates(conf), **_outbox(confirmations=conf)})
        conf.unpersist()
        table.unpersist()

    return _once(store, body, sinks, dead_letter)


def start_v8_settlement_worker(spark: SparkSession, settlements_path: str, payee_path: str,
                               store: TableStore, sinks: dict[str, str], checkpoints: dict[str, str],
                               cfg: FlowConfig = DEFAULT, region: str | None = None,
                               starting_after_ms: int | None = None, watermark_ms: int | None = None,
                               max_files_per_trigger: int | None = None,
                               available_now: bool = True,
                               dead_letter: str | None = None) -> dict[str, Callable[[], StreamingQuery]]:
    """The V8 settlement worker as two streaming queries (returned unstarted,
    as ``{'register': start, 'confirm': start}``):

    * ``register``: Settlements -> Settlement rows + Transfers;
    * ``confirm``: PayeeBankConfirmations LEFT JOIN the settlement cache. The
      cache is the Settlements stream itself: a time-bounded stream-stream
      join keeps each entry in Spark's join state for the TTL (then the
      watermark evicts it), a miss falls back to the committed table.

    ``starting_after_ms`` is the reference's ``initial.position='Latest'`` on
    the Settlements source; ``watermark_ms`` bounds late data (default 2 x TTL).
    """
    def settlements():
        return streams.read_json_stream(spark, settlements_path, schemas.SETTLEMENTS,
                                        max_files_per_trigger, starting_after_ms)

    def start_register() -> StreamingQuery:
        body = v8_register_batch(store.for_job("sw8"), cfg, {"transfers": sinks["transfers"]}, region,
                                 dead_letter and f"{dead_letter}/job=sw8")
        return _start(settlements(), body, checkpoints["register"], available_now)

    def start_confirm() -> StreamingQuery:
        _, cache = settlement.v8_register(settlements(), cfg, region, keyed=False)
        payee = streams.read_json_stream(spark, payee_path, schemas.PAYEE_CONFIRMATIONS,
                                         max_files_per_trigger)
        joined = settlement.cache_join(payee, cache, cfg.ttl_ms, watermark_ms or 2 * cfg.ttl_ms)
        body = v8_confirm_batch(store.for_job("sw8c"), {"confirmations": sinks["confirmations"]},
                                dead_letter and f"{dead_letter}/job=sw8c")
        return _start(joined, body, checkpoints["confirm"], available_now)

    return {"register": start_register, "confirm": start_confirm}


# --------------------------------------------------------------------------- leg 4: CW

def confirmation_batch(store: TableStore, cfg: FlowConfig, sinks: dict[str, str],
                       dead_letter: str | None = None) -> BatchFn:
    """Confirmation worker: post accepted, release rejected, write the ledger.

    A transaction already in the ledger is not posted again, so a re-sent or
    replayed confirmation moves no money twice.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        banks = bank_state(store, enrich.key_filter(_bank_keys(batch))).persist(StorageLevel.MEMORY_AND_DISK)
        posted = enrich.restrict_to_keys(store.appended("ledger", schemas.LEDGER),
                                         batch.select("_txnID"), "_txnID")
        fresh = dedup_durable(batch, posted)
        out = confirmation.confirmation_worker(fresh, banks, cfg)
        store.commit(batch_id, {"ledger": out.ledger, "bank_deltas": out.deltas, **_outbox(payer_confirmations=out.payer)})
        banks.unpersist()

    return _once(store, body, sinks, dead_letter)


def start_confirmation_worker(spark: SparkSession, confirmations_path: str, store: TableStore,
                              sinks: dict[str, str], checkpoint: str, cfg: FlowConfig = DEFAULT,
                              available_now: bool = True, dead_letter: str | None = None) -> StreamingQuery:
    src = streams.read_json_stream(spark, confirmations_path, schemas.CONFIRMATIONS)
    return _start(src, confirmation_batch(store.for_job("cw"), cfg, sinks, dead_letter), checkpoint, available_now)


def confirmation_v8_batch(store: TableStore, cfg: FlowConfig, sinks: dict[str, str],
                          ledger_after: str = "target", dead_letter: str | None = None) -> BatchFn:
    """V8 CW: credit the payee (update-returning), then debit the payer and
    write the ledger for the answered ones. A transaction already in the
    ledger is not posted again."""

    def body(batch: DataFrame, batch_id: int) -> None:
        banks = bank_state(store, enrich.key_filter(_bank_keys(batch))).persist(StorageLevel.MEMORY_AND_DISK)
        posted = enrich.restrict_to_keys(store.appended("ledger_v8", schemas.LEDGER_V8),
                                         batch.select("_txnID"), "_txnID")
        out = confirmation.confirmation_worker_v8(dedup_durable(batch, posted), banks, cfg, ledger_after)
        store.commit(batch_id, {"ledger_v8": out.ledger, "bank_deltas": out.deltas, **_outbox(output=out.posted)})
        banks.unpersist()

    return _once(store, body, sinks, dead_letter)


def start_confirmation_worker_v8(spark: SparkSession, confirmations_path: str, store: TableStore,
                                 sinks: dict[str, str], checkpoint: str, cfg: FlowConfig = DEFAULT,
                                 ledger_after: str = "target", available_now: bool = True,
                                 dead_letter: str | None = None) -> StreamingQuery:
    src = streams.read_json_stream(spark, confirmations_path, schemas.CONFIRMATIONS_V8)
    body = confirmation_v8_batch(store.for_job("cw8"), cfg, sinks, ledger_after, dead_letter)
    return _start(src, body, checkpoint, available_now)


# --------------------------------------------------------------------------- side jobs

def start_sla_monitor(spark: SparkSession, payer_path: str, out_path: str, checkpoint: str,
                      available_now: bool = True) -> StreamingQuery:
    """PayerBankConfirmations -> PayerBankConfirmationsSLA with ``latencyMs``
    (``currentTimeMillis()`` is fixed per micro-batch)."""
    src = streams.read_json_stream(spark, payer_path, schemas.PAYER_CONFIRMATIONS)
    sla = clearing.sla_latency(src.withColumn("confirm_ts", current_time_millis())).drop("confirm_ts")
    return streams.start_json_sink(sla, out_path, checkpoint, available_now)


def start_sla_entry(spark: SparkSession, payments_sla_path: str, payments_path: str, checkpoint: str,
                    available_now: bool = True) -> StreamingQuery:
    """PaymentsSLA -> Payments stamped with the entry time (the SLA clock start)."""
    src = streams.read_json_stream(spark, payments_sla_path, schemas.PAYMENTS_SLA)
    out = clearing.stamp_entry(src).select(*schemas.PAYMENTS.fieldNames())
    return streams.start_json_sink(out, payments_path, checkpoint, available_now)


def start_error_handler(spark: SparkSession, raw_path: str, table_path: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """ErrorStream (whole JSON payloads) -> ErrorTable ``(event, error)`` as parquet."""
    raw = streams.read_raw_stream(spark, raw_path)
    table = errors.error_events(raw).select("event", "error")
    return streams.start_json_sink(table, table_path, checkpoint, available_now, fmt="parquet")


# --------------------------------------------------------------------------- whole flow

@dataclass
class ClearingPaths:
    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def run_clearing_stream(spark: SparkSession, payments_path: str, store: TableStore,
                        presence: DataFrame, root: str, cfg: FlowConfig = DEFAULT,
                        max_files_per_trigger: int | None = None,
                        timeout_s: float | None = None) -> ClearingPaths:
    """Drain every leg once (``availableNow``), in flow order: PW, SW1, Bank B,
    SW2, CW, SLA. Each leg is an independent query with its own checkpoint, so
    running the function again processes only new files."""
    p = ClearingPaths(root.rstrip("/"))
    legs = [
        lambda: start_payment_worker(spark, payments_path, store, presence,
                                     {"settlements": p.settlements,
                                      "payer_confirmations": f"{p.payer}/job=pw"},
                                     p.ckpt_pw, cfg, max_files_per_trigger),
        lambda: start_settlement_worker(spark, p.settlements, store, {"transfers": p.transfers},
                                        p.ckpt_sw1, cfg),
        lambda: start_bank_b(spark, p.transfers, p.payee, p.ckpt_bank_b),
        lambda: start_settlement_confirm(spark, p.payee, store, {"confirmations": p.confirmations},
                                         p.ckpt_sw2),
        lambda: start_confirmation_worker(spark, p.confirmations, store,
                                          {"payer_confirmations": f"{p.payer}/job=cw"}, p.ckpt_cw, cfg),
        lambda: start_sla_monitor(spark, p.payer, p.payer_sla, p.ckpt_sla),
    ]
    _drain(legs, timeout_s)
    return p


# --------------------------------------------------------------------------- simplified flow (V3/V4)

def start_simplified_flow(spark: SparkSession, payments_path: str, store: TableStore,
                          root: str, cfg: FlowConfig = DEFAULT, max_files_per_trigger: int | None = None,
                          timeout_s: float | None = None, dead_letter: str | None = None) -> ClearingPaths:
    """Drain the simplified variant once, each leg its own query: PW (reserve
    every payment), SW1 (name-derived target region), Bank B, SW2 (status +
    name-derived source region), CW (post every in-region confirmation)."""
    from payflux.plans import simplified

    p = ClearingPaths(root.rstrip("/"))

    def pw(batch: DataFrame, batch_id: int) -> None:
        banks = bank_state(store, enrich.key_filter(_bank_keys(batch))).persist(StorageLevel.MEMORY_AND_DISK)
        settlements, requests, reserve, _ = simplified.payment_worker(batch, banks, cfg)
        store.for_job("pw_s").commit(batch_id, {"requests_s": requests, "bank_deltas": reserve,
                                                **_outbox(settlements=settlements)})
        banks.unpersist()

    def sw1(batch: DataFrame, batch_id: int) -> None:
        reg = simplified.settlement_register(batch, cfg).persist(StorageLevel.MEMORY_AND_DISK)
        store.for_job("sw1_s").commit(batch_id, {"settlement_s": reg, **_outbox(transfers=settlement.transfers(reg))})
        reg.unpersist()

    def sw2(batch: DataFrame, batch_id: int) -> None:
        conf = simplified.settlement_confirm(batch, cfg)
        store.for_job("sw2_s").commit(batch_id, {"settlement_s_status": settlement.status_updates(conf),
                                                 **_outbox(confirmations=conf)})

    def cw(batch: DataFrame, batch_id: int) -> None:
        banks = bank_state(store, enrich.key_filter(_bank_keys(batch))).persist(StorageLevel.MEMORY_AND_DISK)
        posted = enrich.restrict_to_keys(store.appended("ledger_s", schemas.LEDGER_SIMPLE),
                                         batch.select(F.col("_txnID").cast("string")), "_key")
        fresh = batch.join(posted.select(F.col("_key").cast("long").alias("_txnID")), "_txnID", "left_anti")
        ledger, payer, deltas, _ = simplified.confirmation_worker(fresh, banks, cfg)
        store.for_job("cw_s").commit(batch_id, {"ledger_s": ledger, "bank_deltas": deltas,
                                                **_outbox(payer_confirmations=payer)})
        banks.unpersist()

    def foreach(path, schema, body, ckpt, job, sinks, files=None):
        src = streams.read_json_stream(spark, path, schema, files)
        stray = dead_letter and f"{dead_letter}/job={job}"
        return _start(src, _once(store.for_job(job), body, sinks, stray), ckpt, True)

    legs = [
        lambda: foreach(payments_path, schemas.PAYMENTS, pw, p.ckpt_pw, "pw_s", {"settlements": p.settlements}, max_files_per_trigger),
        lambda: foreach(p.settlements, schemas.SETTLEMENTS_SIMPLE, sw1, p.ckpt_sw1, "sw1_s", {"transfers": p.transfers}),
        lambda: start_bank_b(spark, p.transfers, p.payee, p.ckpt_bank_b),
        lambda: foreach(p.payee, schemas.PAYEE_CONFIRMATIONS, sw2, p.ckpt_sw2, "sw2_s", {"confirmations": p.confirmations}),
        lambda: foreach(p.confirmations, schemas.CONFIRMATIONS, cw, p.ckpt_cw, "cw_s", {"payer_confirmations": p.payer}),
    ]
    _drain(legs, timeout_s)
    return p


def run_clearing_stream_v8(spark: SparkSession, payments_path: str, store: TableStore,
                           presence: DataFrame, root: str, cfg: FlowConfig,
                           max_files_per_trigger: int | None = None,
                           timeout_s: float | None = None) -> ClearingPaths:
    """Drain the V8 flow once, in order: PW (TTL dedup across batches), SW
    register, Bank B, SW confirm (stream-stream cache join), CW."""
    p = ClearingPaths(root.rstrip("/"))
    v8 = start_v8_settlement_worker(spark, p.settlements, p.payee, store,
                                    {"transfers": p.transfers, "confirmations": p.confirmations},
                                    {"register": p.ckpt_reg, "confirm": p.ckpt_conf}, cfg)
    legs = [
        lambda: start_payment_worker(spark, payments_path, store, presence,
                                     {"settlements": p.settlements, "payer_confirmations": f"{p.payer}/job=pw"},
                                     p.ckpt_pw, cfg, max_files_per_trigger),
        v8["register"],
        lambda: start_bank_b(spark, p.transfers, p.payee, p.ckpt_bank_b),
        v8["confirm"],
        lambda: start_confirmation_worker_v8(spark, p.confirmations, store, {"output": p.output},
                                             p.ckpt_cw, cfg),
    ]
    _drain(legs, timeout_s)
    return p
