"""Benchmark: headline clearing queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is fully evaluated with the ``noop`` sink (no collect to the driver)
after an untimed warm-up pass; ``value`` is the sum of their wall times. The
``streaming`` section drains the V2 flow (payments) and the V8 flow (re-sent
payments) once as chains of streaming queries, each over the table replayed
as a few file arrivals, and reports payments per second. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clearing_flow",        # all four legs, accounts snapshot at the end
    "admit_payments",       # ordered funds admission (fold)
    "validate_payment",     # enrich + ordered rules
    "failed_union",         # payment worker failures (presence + rules + funds)
    "confirm_flow",         # confirmation worker
    "settlement_validate",  # V8 cache-else-table lookup + validation
    "dedup_ttl",            # TTL dedup over retried payments
    "dedup_durable",        # anti join against recorded requests
    "reserve_funds",        # delta aggregate + snapshot join
    "running_count",        # distributed dense numbering
    "seed_banks",           # keyed insert, first row wins
    "error_events",         # JSON dead-letter parsing
    "v8_confirmations",     # V8 cache-else-table, validation, status update-returning
]

# streamed flow: the payments table replayed as this many file arrivals
STREAM_CHUNKS = 4


def calibration(spark) -> dict:
    """Seconds of fixed work that no query touches, to compare machines: one Python loop, one Spark job."""
    t0 = time.perf_counter()
    sum(i * i for i in range(5_000_000))
    t1 = time.perf_counter()
    spark.range(300_000_000).selectExpr("bit_xor(xxhash64(id))").collect()
    return {"python_s": round(t1 - t0, 3), "spark_s": round(time.perf_counter() - t1, 3)}


def bench_stream(spark, sf_dir: str) -> dict:
    """Every leg as its own streaming query (PW, SW1, Bank B, SW2, CW, SLA),
    drained once over the payments table replayed as file arrivals. Staging
    the input is not timed."""
    import uuid

    from payflux.session import table_path
    from payflux.sources import fixtures
    from tools.replay import stage_chunks
    from payflux.streaming.jobs import run_clearing_stream
    from payflux.streaming.store import TableStore

    root = table_path(spark, f"bench-stream-{uuid.uuid4().hex}")
    pay = fixtures.payments(spark, sf_dir)
    src = stage_chunks(pay, f"{root}/in", "timestamp", STREAM_CHUNKS)
    n = spark.read.schema(pay.schema).json(src).count()
    store = TableStore(spark, f"{root}/store")
    store.seed({"banks": fixtures.banks(spark, sf_dir)})
    t0 = time.perf_counter()
    run_clearing_stream(spark, src, store, fixtures.presence(spark, sf_dir), f"{root}/flow",
                        max_files_per_trigger=1)
    sec = time.perf_counter() - t0
    out = {"clearing_stream_sec": round(sec, 3), "payments": n, "micro_batches_per_leg": STREAM_CHUNKS,
           "payments_per_sec": round(n / sec, 1)}

    # V8 variant: re-sent payments, TTL dedup across micro-batches, the
    # settlement cache as a stream-stream join, payee-gated posting
    from payflux.catalog import V8
    from payflux.streaming.jobs import run_clearing_stream_v8

    resends = fixtures.payment_resends(spark, sf_dir)
    src8 = stage_chunks(resends, f"{root}/in8", "timestamp", STREAM_CHUNKS)
    n8 = spark.read.schema(resends.schema).json(src8).count()
    store8 = TableStore(spark, f"{root}/store8")
    store8.seed({"banks": fixtures.banks(spark, sf_dir)})
    t0 = time.perf_counter()
    run_clearing_stream_v8(spark, src8, store8, fixtures.presence(spark, sf_dir), f"{root}/flow8", V8,
                           max_files_per_trigger=1)
    sec8 = time.perf_counter() - t0
    out.update({"v8_stream_sec": round(sec8, 3), "v8_sends": n8, "v8_sends_per_sec": round(n8 / sec8, 1)})
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from payflux.session import build_session
    from payflux.catalog import QUERIES

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    from payflux.sources import fixtures

    def reset() -> None:
        # no cached data or shared plans carry over between passes
        spark.catalog.clearCache()
        fixtures.clear_shared()

    # untimed warm-up pass: JVM class loading, codegen, parquet footers
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    reset()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        reset()
    stream = bench_stream(spark, sf_dir)
    machine = calibration(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "streaming": stream,
        "calibration": machine,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
