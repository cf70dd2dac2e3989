"""Batch result equals the streaming result (availableNow) for the same input."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from payflux import schemas
from payflux.config import DEFAULT
from payflux.operators.dedup import dedup_ttl
from payflux.plans import payment
from payflux.sources import fixtures as fx
from payflux.streaming.jobs import bank_state, start_payment_worker
from payflux.streaming.store import TableStore


def _write_chunks(df, path, order_col, n=3, bounds=None):
    """Write ``df`` as JSON files in ``order_col`` order (one per micro-batch)."""
    from tools.replay import stage_chunks
    return stage_chunks(df, path, order_col, n, bounds)


def test_payment_worker_stream_equals_batch(spark, tmp_path):
    pay = fx.payments(spark, SF_SMALL)
    banks, presence = fx.banks(spark, SF_SMALL), fx.presence(spark, SF_SMALL)
    src = _write_chunks(pay, str(tmp_path / "payments"), "timestamp")

    store = TableStore(spark, str(tmp_path / "store"))
    store.seed({"banks": banks})
    sinks = {"settlements": str(tmp_path / "settlements"),
             "payer_confirmations": str(tmp_path / "payer")}
    q = start_payment_worker(spark, src, store, presence, sinks, str(tmp_path / "ckpt"),
                             max_files_per_trigger=1)
    q.awaitTermination(600)
    assert q.exception() is None
    assert store.last_commit("pw") == 2  # three micro-batches committed

    empty = spark.createDataFrame([], schemas.PAYMENT_REQUESTS)
    batch = payment.payment_worker(pay, banks, empty, presence)
    want_banks = {r["_key"]: (r["balance"], r["reserved"]) for r in batch.banks.collect()}
    got_banks = {r["_key"]: (r["balance"], r["reserved"]) for r in bank_state(store).collect()}
    assert got_banks == want_banks

    want = sorted(r["_txnID"] for r in batch.settlements.collect())
    got = sorted(r["_txnID"] for r in spark.read.schema(schemas.SETTLEMENTS).json(sinks["settlements"]).collect())
    assert got == want and len(got) > 0
    rej = spark.read.schema(schemas.PAYER_CONFIRMATIONS).json(sinks["payer_confirmations"])
    assert rej.count() == batch.rejections.count()
    assert store.appended("requests", schemas.PAYMENT_REQUESTS).count() == len(want)


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def test_clearing_stream_equals_batch(spark, tmp_path):
    """Every leg as its own streaming query (PW, SW1, Bank B, SW2, CW, SLA)
    gives the batch flow's accounts, ledger and payer confirmations."""
    from payflux.plans import clearing
    from payflux.plans.confirmation import LEDGER_COLS, PAYER_COLS
    from payflux.streaming.jobs import run_clearing_stream, settlement_state

    pay = fx.payments(spark, SF_SMALL)
    banks, presence = fx.banks(spark, SF_SMALL), fx.presence(spark, SF_SMALL)
    src = _write_chunks(pay, str(tmp_path / "payments"), "timestamp")
    store = TableStore(spark, str(tmp_path / "store"))
    store.seed({"banks": banks})
    p = run_clearing_stream(spark, src, store, presence, str(tmp_path / "flow"), max_files_per_trigger=1)

    empty = spark.createDataFrame([], schemas.PAYMENT_REQUESTS)
    batch = clearing.clearing_flow(pay, banks, empty, presence)
    acct = ["_key", "balance", "reserved"]
    assert _rows(bank_state(store), acct) == _rows(batch.banks, acct)
    ledger = store.appended("ledger", schemas.LEDGER)
    assert _rows(ledger, LEDGER_COLS) == _rows(batch.cw.ledger, LEDGER_COLS)
    payer = spark.read.schema(schemas.PAYER_CONFIRMATIONS).json(p.payer)
    assert _rows(payer, PAYER_COLS) == _rows(batch.payer_confirmations, PAYER_COLS)
    assert ledger.count() > 0
    # SW2's status updates reach the Settlement rows SW1 inserted
    st = _rows(settlement_state(store), ["_txnID", "status"])
    assert st == _rows(batch.settlement, ["_txnID", "status"])
    # SLA monitor stamped every payer confirmation with a latency
    sla = spark.read.json(p.payer_sla)
    assert sla.count() == payer.count()
    assert sla.filter(F.col("latencyMs").isNull()).count() == 0

    # a second drain finds nothing new and changes nothing
    before = _rows(bank_state(store), acct)
    run_clearing_stream(spark, src, store, presence, str(tmp_path / "flow"), max_files_per_trigger=1)
    assert _rows(bank_state(store), acct) == before


def test_replayed_batch_is_skipped_and_compaction_keeps_state(spark, tmp_path):
    from payflux.streaming.jobs import compact_banks, payment_batch

    pay = fx.payments(spark, SF_SMALL)
    banks, presence = fx.banks(spark, SF_SMALL), fx.presence(spark, SF_SMALL)
    store = TableStore(spark, str(tmp_path / "store"), job="pw")
    store.seed({"banks": banks})
    sinks = {"settlements": str(tmp_path / "s"), "payer_confirmations": str(tmp_path / "p")}
    run = payment_batch(store, presence, payment.DEFAULT, sinks)
    first, second = pay.filter(F.col("_txnID") < 3000), pay.filter(F.col("_txnID") >= 3000)
    run(first, 0)
    after0 = _rows(bank_state(store), ["_key", "balance", "reserved"])
    run(first, 0)  # foreachBatch replay of a committed id: no effect
    assert _rows(bank_state(store), ["_key", "balance", "reserved"]) == after0
    assert compact_banks(store) == 1
    assert _rows(bank_state(store), ["_key", "balance", "reserved"]) == after0
    run(second, 1)
    got = _rows(bank_state(store), ["_key", "balance", "reserved"])
    empty = spark.createDataFrame([], schemas.PAYMENT_REQUESTS)
    want = payment.payment_worker(pay, banks, empty, presence).banks
    assert got == _rows(want, ["_key", "balance", "reserved"])


def test_error_handler_stream_equals_batch(spark, tmp_path):
    from payflux.operators import errors
    from payflux.streaming.jobs import start_error_handler

    raw = fx.error_json(spark, SF_SMALL)
    raw.select("evt").coalesce(2).write.text(str(tmp_path / "raw"))
    q = start_error_handler(spark, str(tmp_path / "raw"), str(tmp_path / "table"), str(tmp_path / "ck"))
    q.awaitTermination(600)
    assert q.exception() is None
    got = spark.read.parquet(str(tmp_path / "table"))
    want = errors.error_events(raw).select("event", "error")
    key = [F.col("event")["c"].cast("bigint").alias("c"), F.to_json("event").alias("e"),
           F.to_json("error").alias("r")]
    assert _rows(got.select(*key), ["c", "e", "r"]) == _rows(want.select(*key), ["c", "e", "r"])


def test_initial_position_latest_skips_older_files(spark, tmp_path):
    import os
    import time

    from payflux.sources import streams

    d = tmp_path / "in"
    d.mkdir()
    old, new = d / "old.json", d / "new.json"
    old.write_text('{"_txnID": 1}\n')
    os.utime(old, (time.time() - 3600, time.time() - 3600))
    new.write_text('{"_txnID": 2}\n')
    start_ms = int((time.time() - 60) * 1000)
    s = streams.read_json_stream(spark, str(d), schemas.PAYMENTS, starting_after_ms=start_ms)
    q = (s.writeStream.format("memory").queryName("latest_out").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination(300)
    assert [r["_txnID"] for r in spark.table("latest_out").collect()] == [2]


def test_v8_settlement_worker_stream_equals_batch(spark, tmp_path):
    """V8 SW on streams: the settlement cache is a time-bounded stream-stream
    join; misses read the committed table. Equals the batch cache-else-table."""
    import json
    import os

    from payflux.plans import settlement
    from payflux.streaming.jobs import settlement_v8_state, start_v8_settlement_worker

    st = fx.settlement_table(spark, SF_SMALL).select(*schemas.SETTLEMENTS.fieldNames())
    payee = fx.payee_confirmations(spark, SF_SMALL).withColumn(
        "timestamp", F.col("timestamp") + F.col("_txnID") % 9000)
    # chunk both streams by the settlement time so a message and its cache put
    # arrive in the same micro-batch
    payee_chunked = payee.withColumn("_t0", F.col("timestamp") - F.col("_txnID") % 9000)
    s_src = _write_chunks(st, str(tmp_path / "settlements"), "timestamp")
    p_src = _write_chunks(payee_chunked, str(tmp_path / "payee"), "_t0")
    # end-of-input marker on both streams: moves the watermark past every real
    # row, so the unmatched (cache miss) rows of the last chunk are emitted
    far = 10 ** 13
    for d, row in ((s_src, {"source_bank": "END", "target_bank": "END", "amount": 0.0, "currency": "USD",
                            "timestamp": far, "source_region": "END", "target_region": "END", "_txnID": -1}),
                   (p_src, {"source_bank": "END", "target_bank": "END", "amount": 0.0, "currency": "USD",
                            "timestamp": far, "status": "ACCP", "_txnID": -1})):
        for i, ts in enumerate((far, far + 10 ** 6)):
            f = f"{d}/zz_end{i}.json"
            with open(f, "w") as fh:
                fh.write(json.dumps(dict(row, timestamp=ts, _txnID=-1 - i)) + "\n")
            os.utime(f, (os.path.getmtime(f) + 100 + i, os.path.getmtime(f) + 100 + i))

    store = TableStore(spark, str(tmp_path / "store"))
    sinks = {"transfers": str(tmp_path / "transfers"), "confirmations": str(tmp_path / "conf")}
    starts = start_v8_settlement_worker(
        spark, s_src, p_src, store, sinks,
        {"register": str(tmp_path / "ck_reg"), "confirm": str(tmp_path / "ck_conf")},
        max_files_per_trigger=1)
    for name in ("register", "confirm"):
        q = starts[name]()
        q.awaitTermination(900)
        assert q.exception() is None

    rows, cache = settlement.v8_register(st)
    want_conf, _ = settlement.v8_confirm(
        settlement.v8_validate(settlement.cache_lookup(payee, cache, rows)), rows)
    got_conf = spark.read.schema(want_conf.schema).json(sinks["confirmations"]).filter("_txnID >= 0")
    cols = settlement.V8_CONFIRMATION_COLS
    assert _rows(got_conf, cols) == _rows(want_conf, cols)
    assert got_conf.count() > 0
    got_status = settlement_v8_state(store).filter("_txnID >= 0")
    want_status = settlement.apply_status(rows, settlement.status_updates(want_conf))
    assert _rows(got_status, ["_txnID", "status"]) == _rows(want_status, ["_txnID", "status"])


def _ttl_stream_vs_batch(spark, tmp_path, rows, group_rows=4096):
    from payflux.streaming.ttl import start_ttl_dedup

    src = _write_chunks(rows, str(tmp_path / "retries"), "timestamp")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").json(src)
    store = TableStore(spark, str(tmp_path / "store"))
    q = start_ttl_dedup(spark, stream, store, str(tmp_path / "kept"), str(tmp_path / "ckpt"),
                        group_rows=group_rows)
    q.awaitTermination(900)
    assert q.exception() is None
    got = _rows(spark.read.parquet(str(tmp_path / "kept")), ["_txnID", "attempt", "timestamp"])
    want = _rows(dedup_ttl(rows), ["_txnID", "attempt", "timestamp"])
    assert got == want and len(got) > 0


def test_ttl_dedup_table_state_stream_equals_batch(spark, tmp_path):
    rows = fx.payment_retries(spark, SF_SMALL).select("_txnID", "attempt", "timestamp")
    _ttl_stream_vs_batch(spark, tmp_path, rows)


def test_ttl_dedup_table_state_hot_key(spark, tmp_path):
    """A third of the rows are re-sends of one transaction, across micro-batches."""
    rows = fx.payment_retries(spark, SF_SMALL).select("_txnID", "attempt", "timestamp")
    hot = F.col("_txnID") % 3 == 0
    rows = rows.select(F.when(hot, F.lit(-1)).otherwise(F.col("_txnID")).alias("_txnID"),
                       (F.col("_txnID") * 10 + F.col("attempt")).alias("attempt"), "timestamp")
    # a tiny fold bound sends the hot transaction through the split (segment) path
    _ttl_stream_vs_batch(spark, tmp_path, rows, group_rows=64)


def test_failed_batch_goes_to_dead_letter_uncommitted(spark, tmp_path):
    """A batch whose sink write fails is routed to the dead-letter folder with
    the error text; nothing of it is committed."""
    from payflux.streaming.jobs import with_dead_letter

    store = TableStore(spark, str(tmp_path / "store"), job="x")
    events = fx.count_events(spark, SF_SMALL)

    def failing_then_commit(batch, batch_id):
        # the sink write fails before the commit record
        batch.write.mode("error").json(str(tmp_path / "exists"))
        store.commit(batch_id, {"t": batch})

    (events.limit(1)).write.json(str(tmp_path / "exists"))
    with_dead_letter(failing_then_commit, str(tmp_path / "dead"))(events, 0)
    assert store.last_commit() is None
    dead = spark.read.json(str(tmp_path / "dead"))
    assert dead.count() == events.count()
    assert dead.filter(F.col("error").contains("AnalysisException")).count() == events.count()


def test_v8_payment_worker_stream_equals_batch(spark, tmp_path):
    """V8 PW on a stream of re-sends: the TTL spans micro-batches through the
    committed TTL state, so the result equals the batch operator."""
    from payflux.catalog import V8

    pay = fx.payment_resends(spark, SF_SMALL)
    banks, presence = fx.banks(spark, SF_SMALL), fx.presence(spark, SF_SMALL)
    # cut 3 s into re-send sequences: the +4 s re-send is in the next micro-batch
    # and must still be suppressed by the TTL carried over from the +0 s send
    # from one micro-batch to the next for the payments of those days
    seqs = pay.groupBy("_txnID").agg(F.min("timestamp").alias("t0"), F.count(F.lit(1)).alias("n"))
    firsts = sorted(r["t0"] for r in seqs.filter("n >= 4").collect())
    bounds = [firsts[len(firsts) // 3] + 3000, firsts[2 * len(firsts) // 3] + 3000]
    cut = pay.join(pay.groupBy("_txnID").agg(F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1")),
                   "_txnID").filter(F.expr(" OR ".join(f"(t0 < {b} AND t1 >= {b})" for b in bounds)))
    assert cut.select("_txnID").distinct().count() > 0  # some sequences straddle a cut
    src = _write_chunks(pay, str(tmp_path / "payments"), "timestamp", bounds=bounds)
    store = TableStore(spark, str(tmp_path / "store"))
    store.seed({"banks": banks})
    sinks = {"settlements": str(tmp_path / "settlements"), "payer_confirmations": str(tmp_path / "payer")}
    q = start_payment_worker(spark, src, store, presence, sinks, str(tmp_path / "ckpt"), V8,
                             max_files_per_trigger=1)
    q.awaitTermination(900)
    assert q.exception() is None

    empty = spark.createDataFrame([], schemas.PAYMENT_REQUESTS)
    batch = payment.payment_worker(pay, banks, empty, presence, V8)
    cols = ["_txnID", "timestamp", "source_bank", "amount"]
    got = spark.read.schema(schemas.SETTLEMENTS).json(sinks["settlements"])
    assert _rows(got, cols) == _rows(batch.settlements, cols)
    rej = spark.read.schema(schemas.PAYER_CONFIRMATIONS).json(sinks["payer_confirmations"])
    assert _rows(rej, cols + ["message"]) == _rows(batch.rejections, cols + ["message"])
    acct = ["_key", "balance", "reserved"]
    assert _rows(bank_state(store), acct) == _rows(batch.banks, acct)


def test_sla_entry_stamp_then_latency(spark, tmp_path):
    """Entry side stamps arrival time; the latency side measures against it."""
    import time

    from payflux.streaming.jobs import start_sla_entry, start_sla_monitor

    pay = fx.payments(spark, SF_SMALL).drop("timestamp")
    pay.coalesce(1).write.json(str(tmp_path / "sla_in"))
    t0 = int(time.time() * 1000)
    q = start_sla_entry(spark, str(tmp_path / "sla_in"), str(tmp_path / "payments"), str(tmp_path / "ck1"))
    q.awaitTermination(600)
    stamped = spark.read.schema(schemas.PAYMENTS).json(str(tmp_path / "payments"))
    assert stamped.count() == pay.count()
    assert stamped.filter(F.col("timestamp") < t0).count() == 0
    conf = stamped.select("_txnID", "source_bank", "target_bank", "amount", "currency",
                          F.lit("ACCP").alias("status"), "timestamp", F.lit(None).cast("string").alias("message"))
    conf.coalesce(1).write.json(str(tmp_path / "payer"))
    q = start_sla_monitor(spark, str(tmp_path / "payer"), str(tmp_path / "sla"), str(tmp_path / "ck2"))
    q.awaitTermination(600)
    sla = spark.read.json(str(tmp_path / "sla"))
    assert sla.count() == pay.count() and sla.filter("latencyMs < 0 OR latencyMs IS NULL").count() == 0


def test_v8_flow_stream_equals_batch(spark, tmp_path):
    """The V8 variant end to end as streams: PW (TTL dedup), SW register, Bank B,
    SW confirm (stream-stream cache join), CW (payee-gated posting)."""
    from payflux.catalog import V8
    from payflux.streaming.jobs import run_clearing_stream_v8

    pay = fx.payment_resends(spark, SF_SMALL)
    banks, presence = fx.banks(spark, SF_SMALL), fx.presence(spark, SF_SMALL)
    src = _write_chunks(pay, str(tmp_path / "payments"), "timestamp", n=3)
    store = TableStore(spark, str(tmp_path / "store"))
    store.seed({"banks": banks})
    run_clearing_stream_v8(spark, src, store, presence, str(tmp_path / "flow"), V8, max_files_per_trigger=1)

    from payflux.plans import clearing
    cw = clearing.clearing_flow_v8(pay, banks, presence, V8).cw
    acct = ["_key", "balance", "reserved"]
    assert _rows(bank_state(store), acct) == _rows(cw.banks, acct)
    led = store.appended("ledger_v8", schemas.LEDGER_V8)
    assert _rows(led, schemas.LEDGER_V8.fieldNames()) == _rows(cw.ledger, schemas.LEDGER_V8.fieldNames())
    assert led.count() > 0


def test_simplified_flow_stream_equals_batch(spark, tmp_path):
    from payflux.catalog import SIMPLE
    from payflux.plans import simplified
    from payflux.streaming.jobs import start_simplified_flow

    pay = fx.payments(spark, SF_SMALL)
    banks = fx.banks(spark, SF_SMALL)
    src = _write_chunks(pay, str(tmp_path / "payments"), "timestamp")
    store = TableStore(spark, str(tmp_path / "store"))
    store.seed({"banks": banks})
    start_simplified_flow(spark, src, store, str(tmp_path / "flow"), SIMPLE, max_files_per_trigger=1)

    want = simplified.simplified_flow(pay, banks, SIMPLE)
    acct = ["_key", "balance", "reserved"]
    assert _rows(bank_state(store), acct) == _rows(want.banks, acct)
    got_ledger = store.appended("ledger_s", schemas.LEDGER_SIMPLE)
    assert _rows(got_ledger, simplified.LEDGER_COLS) == _rows(want.ledger, simplified.LEDGER_COLS)
    assert got_ledger.count() > 0


def test_payment_worker_survives_failure_before_commit(spark, tmp_path):
    """Batch 1 dies after writing its sinks and table files but before its
    commit record; the restarted query replays it and the final state equals
    the batch result (uncommitted files are invisible, then overwritten)."""
    from payflux.streaming.jobs import payment_batch

    class LosesCommit(TableStore):
        lost = False

        def commit(self, batch_id, appends):
            if batch_id == 1 and not LosesCommit.lost:
                for name, df in appends.items():
                    df.write.mode("overwrite").parquet(self._path(name, f"job={self.job}", f"batch={batch_id}"))
                LosesCommit.lost = True
                raise RuntimeError("driver lost before the commit record")
            return super().commit(batch_id, appends)

    pay = fx.payments(spark, SF_SMALL)
    banks, presence = fx.banks(spark, SF_SMALL), fx.presence(spark, SF_SMALL)
    src = _write_chunks(pay, str(tmp_path / "payments"), "timestamp")
    base = str(tmp_path / "store")
    TableStore(spark, base).seed({"banks": banks})
    sinks = {"settlements": str(tmp_path / "settlements"), "payer_confirmations": str(tmp_path / "payer")}

    def run():
        stream = spark.readStream.schema(schemas.PAYMENTS).option("maxFilesPerTrigger", "1").json(src)
        q = (stream.writeStream.foreachBatch(payment_batch(LosesCommit(spark, base, job="pw"), presence,
                                                           payment.DEFAULT, sinks))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        try:
            q.awaitTermination(600)
        except Exception:  # noqa: BLE001 - the injected failure
            pass
        return q

    first = run()
    assert first.exception() is not None and LosesCommit.lost
    store = TableStore(spark, base)
    assert store.last_commit("pw") == 0
    second = run()
    assert second.exception() is None and store.last_commit("pw") == 2

    empty = spark.createDataFrame([], schemas.PAYMENT_REQUESTS)
    batch = payment.payment_worker(pay, banks, empty, presence)
    acct = ["_key", "balance", "reserved"]
    assert _rows(bank_state(store), acct) == _rows(batch.banks, acct)
    got = spark.read.schema(schemas.SETTLEMENTS).json(sinks["settlements"])
    assert _rows(got, ["_txnID"]) == _rows(batch.settlements, ["_txnID"])


def test_failed_commit_publishes_nothing_and_a_replay_publishes_once(spark, tmp_path, monkeypatch):
    """A batch whose commit fails is dead-lettered with nothing published and
    nothing of it readable; a committed batch that was not published yet is
    published by its replay, and only once."""
    from payflux.streaming.jobs import payment_batch

    pay, banks = fx.payments(spark, SF_SMALL), fx.banks(spark, SF_SMALL)
    store = TableStore(spark, str(tmp_path / "store"), job="pw")
    store.seed({"banks": banks})
    sinks = {"settlements": str(tmp_path / "settlements"), "payer_confirmations": str(tmp_path / "payer")}
    run = payment_batch(store, fx.presence(spark, SF_SMALL), DEFAULT, sinks, str(tmp_path / "dead"))
    real = store.commit

    def failing(batch_id, appends):
        appends["requests"].write.parquet(f"{store.base}/requests/job=pw/batch={batch_id}")
        raise OSError("x" * 5000)

    monkeypatch.setattr(store, "commit", failing)
    run(pay, 0)
    assert not (tmp_path / "settlements").exists() and not (tmp_path / "payer").exists()
    dead = spark.read.json(str(tmp_path / "dead"))
    assert dead.count() == pay.count()
    assert dead.first()["error"] == "OSError: " + "x" * 5000  # whole
    monkeypatch.setattr(store, "commit", real)

    # committed, but the query dies before it publishes
    published = []
    import payflux.streaming.jobs as jobs
    sink = jobs._sink
    monkeypatch.setattr(jobs, "_sink", lambda *a: (_ for _ in ()).throw(OSError("sink down")))
    try:
        run(pay, 1)
    except OSError:
        published.append("failed")
    assert published == ["failed"] and store.is_committed(1)
    monkeypatch.setattr(jobs, "_sink", sink)
    for _ in range(2):
        run(pay, 1)
    want = payment.payment_worker(pay, banks, spark.createDataFrame([], schemas.PAYMENT_REQUESTS), fx.presence(spark, SF_SMALL))
    got = spark.read.schema(schemas.SETTLEMENTS).json(sinks["settlements"])
    assert got.count() == want.settlements.count()
    # the rows that the failed batch 0 had written are not visible after batch 1 committed
    assert store.appended("requests", schemas.PAYMENT_REQUESTS).count() == want.requests.count()
    want.release()


def test_drain_reports_a_leg_that_is_not_done(spark, tmp_path):
    import pytest

    from payflux.streaming.jobs import _drain

    src = spark.readStream.format("rate").option("rowsPerSecond", "1").load()
    started = []

    def leg():
        started.append(src.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start())
        return started[0]
    with pytest.raises(TimeoutError):
        _drain([leg], timeout_s=2)
    assert not started[0].isActive
