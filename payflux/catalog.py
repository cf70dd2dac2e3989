"""Registered queries: one per operator of the inventory, each over the whole
derived tables. Every callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame whose column names match the DuckDB oracle in ``payflux.oracle_sql``.
"""

from __future__ import annotations

import json
from dataclasses import replace
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payflux import schemas
from payflux.config import DEFAULT, FlowConfig
from payflux.functions import scalar as fn
from payflux.operators import accounts, enrich, errors, generate, ordered, patterns, presence, rules
from payflux.operators.dedup import dedup_durable, dedup_ttl
from payflux.plans import clearing, confirmation, payment, settlement, simplified
from payflux.session import cut_lineage
from payflux.sources import fixtures as fx
from payflux.sources import streams
from payflux.streaming import counters
from payflux.streaming.keyed import start_keyed_ttl

Query = Callable[[SparkSession, str], DataFrame]
V1 = FlowConfig(max_amount=10000.0)
# V8 payment worker: TTL dedup, presence stubbed, unknown source banks dropped
V8 = FlowConfig(dedup="ttl", presence_check=False, unknown_bank="drop")
# simplified flows on the derived banks: 'Bank_X' (unknown) names map to the
# east region, every other name to the west region, which this instance serves
SIMPLE = FlowConfig(home_region="WEST",
                    name_regions=(("Bank_X", "EAST"),),
                    name_default_region="WEST")

PAYMENT_COLS = ["source_bank", "target_bank", "amount", "currency", "_txnID", "timestamp"]
ACCOUNT_COLS = ["_key", "balance", "reserved"]


def _pw(spark, sf) -> payment.PaymentOutputs:
    return payment.payment_worker(fx.payments(spark, sf), fx.banks(spark, sf),
                                  fx.payment_requests(spark, sf), fx.presence(spark, sf), DEFAULT)


def _settlement_stream(spark, sf) -> DataFrame:
    """Settlements stream as leg 2 sees it (regions resolved by leg 1)."""
    return fx.settlement_table(spark, sf).select(*schemas.SETTLEMENTS.fieldNames())


def _confirmations(spark, sf) -> DataFrame:
    conf, _ = settlement.settlement_confirm(fx.payee_confirmations(spark, sf),
                                            fx.settlement_table(spark, sf))
    return conf


def _cw(spark, sf) -> confirmation.ConfirmOutputs:
    return confirmation.confirmation_worker(_confirmations(spark, sf), fx.banks(spark, sf), DEFAULT)


def _v8_loaded(spark, sf) -> DataFrame:
    st = fx.settlement_table(spark, sf)
    _, cache = settlement.v8_register(_settlement_stream(spark, sf))
    payee = fx.payee_confirmations(spark, sf).withColumn(
        "timestamp", F.col("timestamp") + F.col("_txnID") % 9000)
    return settlement.cache_lookup(payee, cache, st, DEFAULT.ttl_ms)


def _ticks(spark, sf) -> DataFrame:
    return fx.count_events(spark, sf).withColumn("count", F.col("c") + 1)


# --------------------------------------------------------------------------- sources / sinks

def q_src_payments(spark, sf):
    as_json = streams.to_json_lines(fx.payments(spark, sf))
    return streams.parse_json_lines(as_json, schemas.PAYMENTS)


def q_raw_payload(spark, sf):
    raw = fx.error_json(spark, sf).select("event_id", F.col("evt").alias("value"))
    return streams.raw_payload(raw)


def q_sink_json(spark, sf):
    p = fx.payments(spark, sf)
    return p.select("_txnID", streams.json_payload(
        ["source_bank", "target_bank", "amount", "currency", "timestamp", "_txnID"]).alias("payload"))


def q_scan_banks(spark, sf):
    return fx.banks(spark, sf)


def q_append_requests(spark, sf):
    return fx.payment_requests(spark, sf).unionByName(_pw(spark, sf).requests)


def q_seed_banks(spark, sf):
    ticks = fx.read_table(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("c"))
    return generate.seed_banks(ticks, fx.banks(spark, sf))


def q_payload_template(spark, sf):
    ev = fx.count_events(spark, sf).select(F.lit("Processed").alias("status"),
                                           F.col("c").alias("count"), F.col("t").alias("time"))
    return ev.select("count", fn.render_template('{"status":"{{status}}","count":{{count}}}')
                     .alias("payload"))


def q_tick_source(spark, sf):
    return generate.tick_source(fx.count_events(spark, sf), "t", 60_000)


def q_bank_cache(spark, sf):
    return enrich.bank_cache(fx.banks(spark, sf))


# --------------------------------------------------------------------------- projection / filter

def q_project_settlement(spark, sf):
    return settlement.settlement_register(_settlement_stream(spark, sf), region=DEFAULT.home_region)


def q_bank_b_accept(spark, sf):
    reg = settlement.settlement_register(_settlement_stream(spark, sf), region=DEFAULT.home_region)
    return settlement.bank_b_accept(settlement.transfers(reg))


def q_settlement_validate(spark, sf):
    v = settlement.v8_validate(_v8_loaded(spark, sf))
    return v.select("_txnID", "source_bank", "target_bank", "amount", "payee_status", "failedMsg")


def _v8_conf(spark, sf) -> DataFrame:
    v = settlement.v8_validate(_v8_loaded(spark, sf))
    conf, _ = settlement.v8_confirm(v, fx.settlement_table(spark, sf))
    return conf


def q_v8_confirmations(spark, sf):
    return _v8_conf(spark, sf)


def q_v8_confirm_worker(spark, sf):
    """V8 CW over the V8 SW's confirmations: Banks after posting."""
    out = confirmation.confirmation_worker_v8(_v8_conf(spark, sf), fx.banks(spark, sf), DEFAULT)
    return out.banks.select(*ACCOUNT_COLS)


def q_region_filter(spark, sf):
    e = enrich.enrich_source_bank(fx.payments(spark, sf), fx.banks(spark, sf))
    return e.filter(F.col("source_region") == DEFAULT.home_region) \
            .select("_txnID", "source_bank", "source_region")


def q_null_split(spark, sf):
    v = rules.validate_payment(enrich.enrich_source_bank(fx.payments(spark, sf), fx.banks(spark, sf)))
    ok, bad, _ = confirmation.split(v, F.col("failedMsg").isNull())
    return ok.select("_txnID", F.lit("validated").alias("route")) \
             .unionByName(bad.select("_txnID", F.lit("failed").alias("route")))


def q_accept_reject_split(spark, sf):
    cw = _cw(spark, sf)
    return (cw.accepted.select("_txnID", F.lit("accepted").alias("route"))
            .unionByName(cw.rejected.select("_txnID", F.lit("rejected").alias("route")))
            .unionByName(cw.unrouted.select("_txnID", F.lit("unrouted").alias("route"))))


# --------------------------------------------------------------------------- joins

def q_enrich_source_bank(spark, sf):
    e = enrich.enrich_source_bank(fx.payments(spark, sf), fx.banks(spark, sf))
    return e.select("_txnID", "source_bank", "source_balance", "source_total_reserved", "source_region")


def q_enrich_target_region(spark, sf):
    e = enrich.enrich_target_region(fx.payments(spark, sf), fx.bank_regions(spark, sf))
    return e.select("_txnID", "target_bank", "target_region")


def q_settlement_with_bank(spark, sf):
    """V1 SW1: settlement JOIN Banks ON target_bank == Banks.name."""
    e = enrich.join_target_bank_inner(fx.payments_v1(spark, sf), fx.banks(spark, sf), bank_col="name")
    return e.select("_txnID", "target_bank", "target_region")


def q_payee_active_settlement(spark, sf):
    j = enrich.join_active_settlement(fx.payee_confirmations(spark, sf), fx.settlement_table(spark, sf))
    return j.select("settlement_id", F.col("s_source_bank").alias("source_bank"),
                    F.col("s_target_bank").alias("target_bank"),
                    F.col("s_source_region").alias("source_region"), F.col("s_amount").alias("amount"),
                    F.col("s_currency").alias("currency"), F.col("s_timestamp").alias("timestamp"),
                    rules.payee_status(F.col("status")).alias("status"), "_txnID")


def q_settlement_lookup(spark, sf):
    j = enrich.settlement_lookup(fx.payee_confirmations(spark, sf), fx.settlement_table(spark, sf))
    return j.select("_txnID", F.col("status").alias("payee_status"), "loaded_source_bank",
                    "loaded_target_bank", "loaded_amount", "loaded_status")


def q_dedup_durable(spark, sf):
    return dedup_durable(fx.payments(spark, sf), fx.payment_requests(spark, sf)).select(*PAYMENT_COLS)


def q_reserve_returning(spark, sf):
    p = fx.payments(spark, sf)
    banks = fx.banks(spark, sf)
    _, echo = accounts.update_returning(banks, p, "source_bank", accounts.reserve_deltas(p))
    return echo.select("_txnID", "source_bank", "target_bank", "amount", "currency", "timestamp")


def q_presence_flag(spark, sf):
    e = enrich.enrich_target_region(fx.payments(spark, sf), fx.bank_regions(spark, sf))
    return enrich.presence_flag(e, fx.presence(spark, sf)).select("_txnID", "target_region",
                                                                  "isDevicePresent")


def q_cache_fallback(spark, sf):
    return _v8_loaded(spark, sf).select(
        "_txnID", "cache_hit", "loaded_source_bank", "loaded_target_bank", "loaded_source_region",
        "loaded_target_region", "loaded_amount", "loaded_currency", "loaded_timestamp", "loaded_status")


def q_point_lookup(spark, sf):
    keys = fx.payments(spark, sf).select("target_bank")
    return enrich.point_lookup(keys, fx.banks(spark, sf)).select("_key", "balance", "reserved", "region")


# --------------------------------------------------------------------------- aggregation

def q_running_count(spark, sf):
    events = fx.count_events(spark, sf).withColumn("payload", F.md5(F.col("c").cast("string").cast("binary")))
    return generate.running_count(events, "t", "c", "count").select("c", "count", "payload")


def q_cal_total(spark, sf):
    return accounts.totals(fx.banks(spark, sf))


def q_admit_payments(spark, sf):
    return _admitted(spark, sf, DEFAULT)


def q_admit_payments_rounds(spark, sf):
    """The same decisions with every busy bank resolved in rounds instead of folds."""
    return _admitted(spark, sf, replace(DEFAULT, fold_group_rows=8))


def _admitted(spark, sf, cfg):
    # read twice (sizes of the banks' groups, then the rows): computed once
    pw_checked = cut_lineage(payment.enrich_and_check(
        dedup_durable(fx.payments(spark, sf), fx.payment_requests(spark, sf)),
        fx.banks(spark, sf), fx.presence(spark, sf), cfg))
    d = payment.admit(pw_checked, fx.banks(spark, sf), cfg)
    return d.select("_txnID", "source_bank", "amount", "admitted")


def q_v8_payment_worker(spark, sf):
    """V8 PW over re-sent payments: Settlements and RJCT confirmations."""
    out = payment.payment_worker(fx.payment_resends(spark, sf), fx.banks(spark, sf),
                                 fx.payment_requests(spark, sf), fx.presence(spark, sf), V8)
    ok = out.settlements.select("_txnID", "timestamp", "source_bank", "amount",
                                F.lit("SETTLE").alias("route"), F.lit(None).cast("string").alias("message"))
    bad = out.rejections.select("_txnID", "timestamp", "source_bank", "amount",
                                F.col("status").alias("route"), "message")
    return ok.unionByName(bad)


def q_v8_flow(spark, sf):
    """V8 variant end to end over re-sent payments: Banks after every leg."""
    out = clearing.clearing_flow_v8(fx.payment_resends(spark, sf), fx.banks(spark, sf),
                                    fx.presence(spark, sf), V8)
    return out.banks.select(*ACCOUNT_COLS)


def q_failed_union(spark, sf):
    return _pw(spark, sf).failed


def q_payer_rejections(spark, sf):
    return _pw(spark, sf).rejections


# --------------------------------------------------------------------------- scalar functions

def q_str_concat(spark, sf):
    return fx.settlement_table(spark, sf).select("_txnID", settlement.settlement_cache_json().alias("json"))


def q_region_by_name(spark, sf):
    p = fx.payments(spark, sf)
    region = rules.region_by_name(F.col("source_bank"), [("Bank_X", "EAST")],
                                  "WEST")
    return p.select("_txnID", "source_bank", region.alias("source_region"))


def q_convert_types(spark, sf):
    p = fx.payments(spark, sf)
    return p.select("_txnID", fn.convert("_txnID", "string").alias("txn_str"),
                    fn.convert("amount", "string").alias("amount_str"),
                    fn.convert("amount", "long").alias("amount_long"))


def q_validate_payment(spark, sf):
    v = rules.validate_payment(enrich.enrich_source_bank(fx.payments(spark, sf), fx.banks(spark, sf)))
    return v.select("_txnID", "failedMsg")


def q_validate_payment_v1(spark, sf):
    """V1 PW: payment LEFT JOIN Banks ON Banks.name == source_bank, JS-truthiness rules."""
    e = enrich.enrich_source_bank(fx.payments_v1(spark, sf), fx.banks(spark, sf), bank_col="name")
    return e.select("_txnID", rules.payment_rules_v1(V1).alias("failedMsg"))


def q_gen_payments(spark, sf):
    return generate.gen_payments(_ticks(spark, sf), "count", "t")


def q_trigger_payments(spark, sf):
    return generate.trigger_payments(_ticks(spark, sf), "count", "t")


def q_sla_latency(spark, sf):
    rej = _pw(spark, sf).rejections.withColumn("confirm_ts", F.col("timestamp") + F.col("_txnID") % 9000)
    return clearing.sla_latency(rej).select("_txnID", "status", "timestamp", "latencyMs")


def q_event_time(spark, sf):
    return fx.count_events(spark, sf).select("c", F.col("t").alias("event_time"))


def q_json_extract(spark, sf):
    j = fx.settlement_table(spark, sf).select("_txnID", settlement.settlement_cache_json().alias("json"))
    return j.select("_txnID", fn.json_get_string("json", "$.sb").alias("sb"),
                    fn.json_get_string("json", "$.tb").alias("tb"),
                    fn.json_get_string("json", "$.sr").alias("sr"),
                    fn.json_get_string("json", "$.tr").alias("tr"),
                    fn.json_get_double("json", "$.a").alias("a"),
                    fn.json_get_string("json", "$.c").alias("c"),
                    fn.json_get_string("json", "$.s").alias("s"))


def q_json_object(spark, sf):
    m = fx.error_json(spark, sf).select("event_id", fn.json_to_map("evt").alias("m"))
    return m.select("event_id", F.size("m").alias("n_keys"), F.col("m")["c"].alias("c_value"),
                    F.col("m")["type"].alias("type_value"))


def q_error_events(spark, sf):
    e = errors.error_events(fx.error_json(spark, sf))
    return e.select(F.col("event")["c"].cast("bigint").alias("c"),
                    F.col("event")["t"].cast("bigint").alias("t"),
                    F.col("event")["type"].alias("type"), F.size("event").alias("n_event_keys"),
                    F.col("error")["message"].alias("error_message"),
                    F.col("error")["code"].cast("int").alias("error_code"))


def q_dead_letter(spark, sf):
    ev = fx.count_events(spark, sf)
    ok, bad = errors.route_errors(ev, lambda d: errors.parity_validator(F.col("c")), "status")
    return ok.select("c", "t", "status", F.lit(None).cast("string").alias("error")) \
             .unionByName(bad.select("c", "t", F.lit(None).cast("string").alias("status"), "error"))


# --------------------------------------------------------------------------- stateful / tables

def q_reserve_funds(spark, sf):
    return _pw(spark, sf).banks.select(*ACCOUNT_COLS)


def q_settle_accounts(spark, sf):
    cw = _cw(spark, sf)
    return accounts.apply_deltas(fx.banks(spark, sf), accounts.settle_deltas(cw.accepted)).select(*ACCOUNT_COLS)


def q_release_funds(spark, sf):
    cw = _cw(spark, sf)
    return accounts.apply_deltas(fx.banks(spark, sf), accounts.release_deltas(cw.rejected)).select(*ACCOUNT_COLS)


def q_settlement_status(spark, sf):
    _, st = settlement.settlement_confirm(fx.payee_confirmations(spark, sf), fx.settlement_table(spark, sf))
    return st.select("_key", "status")


def q_reset_balances(spark, sf):
    """Reset as a committed operation: reserves are committed, every row is
    reset into a new base, and Banks is read back from the store."""
    from payflux.streaming.jobs import bank_state, reset_banks

    store = _store(spark, "reset", "pw")
    store.seed({"banks": fx.banks(spark, sf)})
    store.commit(0, {"bank_deltas": accounts.reserve_deltas(fx.payments(spark, sf))})
    reset_banks(store)
    return bank_state(store).select(*ACCOUNT_COLS)


def q_truncate_table(spark, sf):
    """Truncate as a committed operation: the table is appended, emptied and
    appended again; what is read back is the second append alone."""
    rows = fx.settlement_table(spark, sf)
    store = _store(spark, "truncate", "sw8")
    store.commit(0, {"settlement": rows})
    store.truncate("settlement")
    store.commit(1, {"settlement": rows})
    return store.appended("settlement", rows.schema)


def _store(spark, name, job):
    import uuid

    from payflux.session import table_path
    from payflux.streaming.store import TableStore

    return TableStore(spark, table_path(spark, f"{name}-{uuid.uuid4().hex}"), job=job)


def q_atomic_batch(spark, sf):
    """The payment worker over the whole table as batch 0 of job ``pw``: its
    request rows and reserve deltas are committed atomically (one commit record)
    into a fresh store under the shared checkpoint dir; Banks is then read back
    as base + committed deltas."""
    from payflux.streaming.jobs import bank_state

    store = _store(spark, "atomic", "pw")
    store.seed({"banks": fx.banks(spark, sf)})
    recorded = store.appended("requests", schemas.PAYMENT_REQUESTS).unionByName(fx.payment_requests(spark, sf))
    out = payment.payment_worker(fx.payments(spark, sf), bank_state(store), recorded,
                                 fx.presence(spark, sf), DEFAULT)
    store.commit(0, {"requests": out.requests, "bank_deltas": out.reserve})
    return bank_state(store).select(*ACCOUNT_COLS)


def q_dedup_ttl(spark, sf):
    kept = dedup_ttl(fx.payment_retries(spark, sf), "_txnID", "timestamp", "attempt", DEFAULT.ttl_ms,
                     DEFAULT.fold_group_rows)
    return kept.select("_txnID", "attempt", "timestamp")


def q_dedup_ttl_rounds(spark, sf):
    """The same rows with every key that is sent more than once resolved by pointer doubling."""
    kept = dedup_ttl(fx.payment_retries(spark, sf), "_txnID", "timestamp", "attempt", DEFAULT.ttl_ms, 2)
    return kept.select("_txnID", "attempt", "timestamp")


def q_assign_txn(spark, sf):
    return generate.assign_txn(_ticks(spark, sf), "count", "t").select("c", "txnID")


def q_settlement_id(spark, sf):
    rows, _ = settlement.v8_register(_settlement_stream(spark, sf))
    return rows.select("_txnID", "settlement_id")


def q_payee_status(spark, sf):
    p = fx.payee_confirmations(spark, sf)
    return p.select("_txnID", rules.payee_status(F.col("status")).alias("status"))


def q_confirm_flow(spark, sf):
    return _cw(spark, sf).payer


def q_clearing_flow(spark, sf):
    out = clearing.clearing_flow(fx.payments(spark, sf), fx.banks(spark, sf),
                                 fx.payment_requests(spark, sf), fx.presence(spark, sf))
    return out.banks.select(*ACCOUNT_COLS)


def q_simplified_flow(spark, sf):
    """V3/V4 flow end to end: Banks after reserve and posting."""
    out = simplified.simplified_flow(fx.payments(spark, sf), fx.banks(spark, sf), SIMPLE)
    return out.banks.select(*ACCOUNT_COLS)


def q_simplified_event_time(spark, sf):
    """Simplified legs at the event's arrival instead of the payload's time: settlements, requests, confirmations."""
    p = fx.payments(spark, sf).withColumn("arrived", F.col("timestamp") + F.col("_txnID") % 5000)
    sent, requests, _, _ = simplified.payment_worker(p, fx.banks(spark, sf), SIMPLE, "arrived")
    payee = fx.payee_confirmations(spark, sf).withColumn("arrived", F.col("timestamp") + F.col("_txnID") % 7000)
    legs = [("settlement", sent), ("request", requests.withColumn("_txnID", F.col("_key").cast("bigint"))),
            ("confirmation", simplified.settlement_confirm(payee, SIMPLE, "arrived"))]
    return reduce(DataFrame.unionByName, [df.select(F.lit(leg).alias("leg"), "_txnID", "timestamp") for leg, df in legs])


def q_simplified_ledger(spark, sf):
    out = simplified.simplified_flow(fx.payments(spark, sf), fx.banks(spark, sf), SIMPLE)
    return out.ledger


def q_validate_summary(spark, sf):
    """Flagship: verdict counts of the V2 rules over every payment."""
    v = q_validate_payment(spark, sf)
    return v.groupBy(F.coalesce("failedMsg", F.lit("PASS")).alias("verdict")) \
            .agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- streams, faults, presence, patterns

def _scratch(spark, name):
    import uuid

    from payflux.session import table_path

    return table_path(spark, f"{name}-{uuid.uuid4().hex}")


def _as_stream(spark, sf, name):
    """A table of the given folder as a stream (one micro-batch per file)."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def _drained(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def q_dedup_ttl_keyed_state(spark, sf):
    """TTL dedup of the re-sent payments as a stream, in keyed state."""
    rows = fx.retries_of(_as_stream(spark, sf, "lineitem")).select("_txnID", "attempt", "timestamp")
    out = _scratch(spark, "keyed-ttl")
    _drained(start_keyed_ttl(rows, f"{out}/kept", f"{out}/checkpoint", ttl_ms=DEFAULT.ttl_ms))
    return spark.read.schema(rows.schema).parquet(f"{out}/kept")


def q_running_count_stream(spark, sf):
    """The events numbered as a stream."""
    events = fx.count_events_of(_as_stream(spark, sf, "events"))
    out = _scratch(spark, "counts")
    _drained(counters.start_running_count(events, "t", "c", f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/rows").select("c", "count")


def q_totals_stream(spark, sf):
    """Number, total balance and total reserved of the accounts as a stream."""
    accounts_ = fx.banks_of(_as_stream(spark, sf, "customer"), spark, sf)
    out = _scratch(spark, "totals")
    _drained(counters.start_totals(accounts_, accounts.total_columns(), f"{out}/rows", f"{out}/checkpoint"))
    return counters.last_totals(spark.read.parquet(f"{out}/rows"))


def q_admission_passes(spark, sf):
    """How admission decides: payments of accounts whose requests fit together, and payments folded in order."""
    checked = cut_lineage(payment.enrich_and_check(
        dedup_durable(fx.payments(spark, sf), fx.payment_requests(spark, sf)), fx.banks(spark, sf), fx.presence(spark, sf), DEFAULT))
    rows, funds = payment.candidates_and_funds(checked, fx.banks(spark, sf))
    pending = rows.withColumn("_amt", F.col("amount").cast(ordered.AMOUNT))
    free = funds.select("source_bank", F.col("free").cast(ordered.MONEY).alias("_free"))
    plain, contended = ordered.split_contended(pending, free, "source_bank")
    parts = [("plain", plain)] + ([("folded", contended)] if contended is not None else [])
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("decided"), "source_bank") for name, df in parts]) \
        .groupBy("decided").agg(F.count(F.lit(1)).alias("payments"), F.count_distinct("source_bank").alias("accounts"))


def q_tick_counts(spark, sf):
    return generate.tick_counts(fx.count_events(spark, sf), "t", 60_000)


def q_guarded_function(spark, sf):
    """A user function that raises for some rows: its values and its faults."""
    events = fx.read_table(spark, sf, "events").select(F.col("event_id").alias("c"), "props")
    ok, bad = errors.route_errors(events, lambda d: errors.guarded(_share_of, "bigint")("c", "props"), "share")
    return (ok.select("c", "share", F.lit(None).cast("string").alias("error"))
            .unionByName(bad.select("c", F.lit(None).cast("bigint").alias("share"), "error")))


def _share_of(c, props):
    k = json.loads(props)["k"]
    if c % 2 == 0:
        raise ValueError("Count is Even.")
    if k % 5 == 0:
        raise ArithmeticError(f"no share of {k}")
    return 1000 // (k % 5)


def q_malformed_payloads(spark, sf):
    """Payment lines, some of them broken: events of the good ones, faults of the others."""
    ok, bad = streams.parse_checked(fx.payment_lines(spark, sf), schemas.PAYMENT_LINES)
    return (ok.select("_txnID", "source_bank", "cents", F.lit(None).cast("string").alias("event"), F.lit(None).cast("string").alias("error"))
            .unionByName(bad.select(F.lit(None).cast("bigint").alias("_txnID"), F.lit(None).cast("string").alias("source_bank"),
                                    F.lit(None).cast("bigint").alias("cents"), "event", "error")))


def q_json_variant(spark, sf):
    """Nested objects, strict JSON only: parts by path, broken texts as NULL."""
    o = fx.nested_json(spark, sf).select("event_id", fn.json_to_variant("evt").alias("o"))
    return o.select("event_id", F.col("o").isNotNull().alias("is_json"), fn.object_get("o", "$.error.message").alias("message"),
                    fn.object_get("o", "$.error.code", "bigint").alias("code"), fn.object_get("o", "$.tags[1]").alias("second_tag"),
                    fn.object_json("o", "$.error").alias("error"))


def q_counted_split(spark, sf):
    """Accepted, rejected and unrouted confirmations written in one pass: counted on the way and after."""
    p = fx.payee_confirmations(spark, sf).withColumn("amount_ok", F.col("amount") > 0)
    out = _scratch(spark, "split")
    counts = confirmation.write_split(p, (F.col("status") == "ACCP") & F.col("amount_ok"), out)
    written = spark.read.parquet(out).groupBy("route").agg(F.count(F.lit(1)).alias("written"))
    seen = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    return written.select("route", "written", seen[F.col("route")].alias("counted"), seen["input"].alias("input"))


def q_presence_sessions(spark, sf):
    """Consumers' sessions from their events, twelve hours without one ending a session."""
    e = fx.read_table(spark, sf, "events").where("user_id is not null")
    return presence.sessions(e, "user_id", "ts", "12 hours").select(
        "user_id", fn.epoch_millis("since").alias("since"), fn.epoch_millis("until").alias("until"), "n_events")


def q_presence_latest(spark, sf):
    """Latest state of every consumer at the last event of the table."""
    e = fx.read_table(spark, sf, "events").where("user_id is not null")
    at = e.select(F.max("ts")).scalar()
    s = presence.present(presence.latest(presence.sessions(e, "user_id", "ts", "12 hours"), "user_id"), at)
    return s.select("user_id", fn.epoch_millis("since").alias("since"), fn.epoch_millis("until").alias("until"), "n_sessions", "n_events", "present")


def q_pattern_join(spark, sf):
    """Accounts whose names match a subscriber's pattern."""
    return patterns.pattern_join(fx.banks(spark, sf).select("_key", "name"), fx.subscriptions(spark, sf), "name", "pattern") \
        .select("_key", "subscriber", "pattern")


QUERIES: dict[str, Query] = {
    name[2:]: obj for name, obj in sorted(globals().items())
    if name.startswith("q_") and callable(obj)
}
