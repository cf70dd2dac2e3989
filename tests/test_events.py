"""Faults, presence, patterns, keyed state, counts and totals on streams, against plain Python or the batch operators."""

import json
import os
import random
import re
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from payflux import schemas
from payflux.operators import accounts, errors, generate, ordered, patterns, presence
from payflux.operators.dedup import dedup_ttl
from payflux.plans import confirmation
from payflux.sources import fixtures as fx
from payflux.sources import streams
from payflux.streaming import counters, jobs
from payflux.streaming.keyed import start_keyed_ttl
from payflux.streaming.store import TableStore

from conftest import SF_SMALL


def drained(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


# ---- faults

def test_guarded_function_spoils_no_batch(spark):
    def share(a, b):
        if b is None:
            raise LookupError("no b")
        return int(a // b)

    df = spark.createDataFrame([(10, 3), (7, 0), (8, None), (9, 2), (None, 1)], "a bigint, b bigint")
    one = errors.guarded(share, "bigint")
    got = df.select("a", one("a", "b").alias("r")).select("a", "r.*").collect()
    assert [r.value for r in got][:2] == [3, None] and got[1].error.startswith("ZeroDivisionError")
    assert got[3].value == 4 and got[4].value is None and got[4].error is not None  # None // 1 raises as well
    ok, bad = errors.route_errors(df, lambda d: one("a", "b"), "share")
    assert ok.count() + bad.count() == 5 and ok.columns == ["a", "b", "share"]


def test_guarded_batch_isolates_failing_rows(spark):
    def halves(rows: pd.DataFrame) -> pd.Series:
        if (rows["c"] % 50 == 7).any():
            raise ValueError(f"{int((rows['c'] % 50 == 7).sum())} bad")
        return rows["c"] * 2

    got = spark.range(400).withColumnRenamed("id", "c").select("c", errors.guarded_batch(halves, "bigint")("c").alias("r")).select("c", "r.*").collect()
    for r in got:
        assert (r.value, r.error) == ((None, "ValueError: 1 bad") if r.c % 50 == 7 else (2 * r.c, None))


LINES = ['{"_txnID":1,"source_bank":"Bank_1","cents":5}', '{"_txnID":2,"source_bank":"Bank_1","cen', "lost", "", None, "[1,2]", "{}",
         '{"_txnID":"x","cents":1}', '{"_txnID":3,"extra":{"a":1}}', "{'_txnID':4}", '{"_txnID":5} trailing']


def test_no_line_is_lost(spark, tmp_path):
    frame = spark.createDataFrame([(x,) for x in LINES], "value string")
    ok, bad = streams.parse_checked(frame, schemas.PAYMENT_LINES)
    good, faults = sorted(map(str, ok.collect())), [r.event for r in bad.collect()]
    assert len(good) + len(faults) == len(LINES)
    assert {r["_txnID"] for r in ok.collect()} >= {1, 3, None} and {"lost", "", None, LINES[1], LINES[7]} <= set(faults)

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(x for x in LINES if x))
    events, faulty = streams.read_checked_stream(spark, str(tmp_path / "in"), schemas.PAYMENT_LINES, 1)
    for name, df in (("ok", events), ("bad", faulty)):
        drained(streams.start_json_sink(df, f"{tmp_path}/{name}", f"{tmp_path}/c-{name}"))
    again = sorted(r.event for r in spark.read.json(f"{tmp_path}/bad").collect())
    assert again == sorted(x for x in faults if x)
    assert spark.read.schema(schemas.PAYMENT_LINES).json(f"{tmp_path}/ok").count() == len(good)


def test_write_split_counts_in_the_same_pass(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("k"))
    counts = confirmation.write_split(df, F.col("k") == 1, f"{tmp_path}/s")
    assert counts["input"] == 100 == counts["accepted"] + counts["rejected"] + counts["unrouted"] and counts["unrouted"] == 10
    got = {r.route: r["count"] for r in spark.read.parquet(f"{tmp_path}/s").groupBy("route").count().collect()}
    assert got == {k: counts[k] for k in got} and len(got) == 3
    empty = confirmation.write_split(df.limit(0), F.col("k") == 1, f"{tmp_path}/e")
    assert set(empty.values()) == {0}


def test_committed_batch_is_never_discarded(spark, tmp_path, monkeypatch):
    """An error after the commit neither takes the batch back nor dead-letters it; one before it does both."""
    store = TableStore(spark, str(tmp_path / "s"), job="pw")
    batch = spark.createDataFrame([(1,), (2,)], "id bigint")

    def body(fail_first):
        def run(b, batch_id):
            if fail_first:
                raise OSError("before")
            store.commit(batch_id, {"t": b})
            raise OSError("after")
        return run

    with pytest.raises(OSError, match="after"):
        jobs._once(store, body(False), {}, str(tmp_path / "dead"))(batch, 1)
    assert store.is_committed(1) and store.appended("t", batch.schema).count() == 2
    assert not (tmp_path / "dead").exists()
    jobs._once(store, body(True), {}, str(tmp_path / "dead"))(batch, 2)
    assert not store.is_committed(2) and spark.read.json(str(tmp_path / "dead")).count() == 2
    # upkeep that fails stops the query after the batch is published
    def upkeep(batch_id):
        raise OSError("compaction")
    with pytest.raises(OSError, match="compaction"):
        jobs._once(store, lambda b, i: store.commit(i, {"t": b}), {}, str(tmp_path / "dead"), upkeep)(batch, 3)
    assert store.is_committed(3) and store.appended("t", batch.schema).count() == 4


# ---- admission in two passes

def test_only_contended_accounts_are_folded(spark):
    rows = [("a", 1, 5.0), ("a", 2, 4.0), ("a", 3, -7.0), ("a", 4, None), ("b", 1, 6.0), ("b", 2, 6.0), ("b", 3, 4.0), ("c", 1, 1.0), (None, 1, 1.0), ("d", 1, 10.0)]
    cand = spark.createDataFrame([(k, t, i, x) for i, (k, t, x) in enumerate(rows)], "source_bank string, timestamp bigint, _txnID bigint, amount double")
    funds = spark.createDataFrame([("a", 9.0), ("b", 10.0), ("d", 10.0)], "source_bank string, free double")
    pending = cand.withColumn("_amt", F.col("amount").cast(ordered.AMOUNT))
    plain, contended = ordered.split_contended(pending, funds.select("source_bank", F.col("free").cast(ordered.MONEY).alias("_free")), "source_bank")
    assert {r.source_bank for r in plain.collect()} == {"a", "d"} and contended.count() == 5
    got = {r["_txnID"]: r.admitted for r in ordered.ordered_admission(cand, funds).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 4: True, 5: False, 6: True, 7: False, 8: False, 9: True}
    none = ordered.split_contended(pending.where("source_bank = 'a'"), funds.select("source_bank", F.col("free").cast(ordered.MONEY).alias("_free")), "source_bank")
    assert none[1] is None


# ---- ticks

def test_ticks_have_no_gap(spark):
    ev = spark.createDataFrame([(1_000,), (1_001,), (9_500,), (None,)], "t bigint")
    assert [tuple(r) for r in generate.tick_counts(ev, "t", 2000).orderBy("tick").collect()] == [
        (0, 0, 2), (1, 2000, 0), (2, 4000, 0), (3, 6000, 0), (4, 8000, 1)]
    assert generate.tick_source(ev.where("t < 0")).count() == 0


# ---- presence

T0 = datetime(2024, 5, 1)


def events(*minutes):
    return [(u, T0 + timedelta(minutes=m)) for u, m in minutes]


def test_sessions_ties_and_gaps(spark):
    rows = events(("a", 0), ("a", 10), ("a", 10), ("a", 20), ("a", 31), ("b", 5), ("b", 15.1))
    df = spark.createDataFrame(rows, "u string, ts timestamp")
    got = presence.sessions(df, "u", "ts", "10 minutes")
    assert sorted((r.u, r.since - T0, r.until - T0, r.n_events) for r in got.collect()) == [
        ("a", timedelta(0), timedelta(minutes=30), 4),  # an event at the very end of a session belongs to it
        ("a", timedelta(minutes=31), timedelta(minutes=41), 1),
        ("b", timedelta(minutes=5), timedelta(minutes=15), 1), ("b", timedelta(minutes=15.1), timedelta(minutes=25.1), 1)]
    last = presence.present(presence.latest(got, "u"), F.lit(T0 + timedelta(minutes=30)).cast("timestamp"))
    assert sorted((r.u, r.n_sessions, r.n_events, r.present) for r in last.collect()) == [("a", 2, 5, True), ("b", 2, 2, False)]


def test_sessions_on_a_stream(spark, tmp_path):
    """Four micro-batches; an event behind the watermark is left out, the others give the batch result."""
    parts = [events(("a", 0), ("a", 8), ("b", 3)), events(("a", 12), ("b", 90)), events(("a", 200), ("b", 200)), events(("b", 1), ("c", 400))]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, "u string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        files = sorted((tmp_path / "in").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
        os.utime(files[-1], (1_700_000_000 + k * 100, 1_700_000_000 + k * 100))
    src = (spark.readStream.schema("u string, ts timestamp").option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in")
           .withWatermark("ts", "30 minutes"))
    w = (presence.sessions(src, "u", "ts", "10 minutes").writeStream.format("parquet").option("path", f"{tmp_path}/out")
         .option("checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(availableNow=True).start())
    drained(w)
    got = sorted((r.u, r.since, r.until, r.n_events) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    taken = [e for k, part in enumerate(parts) for e in part if not (k == 3 and e == events(("b", 1))[0])]
    want = presence.sessions(spark.createDataFrame(taken, "u string, ts timestamp"), "u", "ts", "10 minutes")
    closed = T0 + timedelta(minutes=400 - 30)  # sessions whose end the last watermark has passed
    assert got == sorted((r.u, r.since, r.until, r.n_events) for r in want.collect() if r.until <= closed)
    assert len(got) >= 4


# ---- patterns

def like(text, pattern):
    return text is not None and pattern is not None and re.fullmatch(
        "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern), text, re.S) is not None


@pytest.mark.parametrize("bound", [100, 0])
def test_pattern_join(spark, bound):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab\\%_.") for _ in range(rnd.randint(0, 7))) for _ in range(120)] + [None, "", "line\nend", "é_ü"]
    pats = ["".join(rnd.choice("ab%_\\") for _ in range(rnd.randint(0, 5))) for _ in range(60)] + [None, "", "%", "_", "__", "%\\%", "line%", "%é%"]
    left = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, name string, text string")
    right = spark.createDataFrame([(j, p, "y") for j, p in enumerate(pats)], "j int, pattern string, key string")
    got = patterns.pattern_join(left, right, "name", "pattern", broadcast_patterns=bound)
    assert got.columns == ["i", "name", "text", "j", "pattern", "key"]
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((i, j) for i, t in enumerate(texts) for j, p in enumerate(pats) if like(t, p))
    assert patterns.pattern_join(left, right.limit(0), "name", "pattern").count() == 0


def test_pattern_join_of_common_literals(spark):
    # every text has the start and "#000": a pattern must be found by a key that few texts have
    texts = spark.range(400).select(F.col("id").alias("i"), F.format_string("Customer#%09d", "id").alias("name"))
    pats = (spark.range(300).select(F.col("id").alias("j"), F.format_string("Customer#%%000%03d", "id").alias("pattern"))
            .unionByName(spark.range(300).select((F.col("id") + 300).alias("j"), F.format_string("%%#000%03d___%%", F.col("id") % 3).alias("pattern"))))
    for bound in (1000, 0):
        met = patterns.pattern_join(texts, pats, "name", "pattern", broadcast_patterns=bound)
        got = sorted((r.i, r.j) for r in met.select("i", "j").collect())
        assert got == sorted((i, j) for i in range(400) for j in range(600)
                             if like(f"Customer#{i:09d}", f"Customer#%000{j:03d}" if j < 300 else f"%#000{(j - 300) % 3:03d}___%"))
    known = patterns._candidate_keys(pats.where("j < 300"))
    assert known.where("kind = 's'").select("key").distinct().count() == 300  # the end, which few texts have, is a key too


# ---- keyed state, counts, totals on streams

def in_files(df, order, parts, path, spark):
    """The rows of ``df`` in ``order``, as files that arrive one after another."""
    rows = df.orderBy(*order).collect()
    n = -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * n:(k + 1) * n], df.schema).coalesce(1).write.mode("append").parquet(path)
        last = max((f for f in os.scandir(path) if f.name.endswith(".parquet")), key=lambda f: f.stat().st_mtime_ns)
        os.utime(last.path, (1_700_000_000 + 100 * k,) * 2)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(path)


def test_keyed_ttl_equals_batch_and_forgets(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(rnd.randrange(6), a, 1000 * rnd.randrange(1, 120)) for a in range(160)] + [(99, 1000, 1000), (99, 1001, 119_000)]
    df = spark.createDataFrame(rows, "_txnID bigint, attempt bigint, timestamp bigint")
    src = in_files(df, ["timestamp", "attempt"], 4, f"{tmp_path}/in", spark)
    q = drained(start_keyed_ttl(src, f"{tmp_path}/out", f"{tmp_path}/c", ttl_ms=5000, late_ms=1000))
    got = sorted(map(tuple, spark.read.schema(df.schema).parquet(f"{tmp_path}/out").collect()))
    assert got == sorted(map(tuple, dedup_ttl(df, "_txnID", "timestamp", "attempt", 5000).select(*df.columns).collect()))
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2 * 7 + 8  # values and timers of live keys
    # the same query again finds nothing new and repeats nothing
    drained(start_keyed_ttl(src, f"{tmp_path}/out", f"{tmp_path}/c", ttl_ms=5000, late_ms=1000))
    assert sorted(map(tuple, spark.read.schema(df.schema).parquet(f"{tmp_path}/out").collect())) == got


def test_keyed_ttl_of_buckets(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(rnd.choice([None, *range(30)]), a, 1000 * rnd.randrange(1, 60)) for a in range(200)]
    rows += [(7, 200 + a, None) for a in range(3)] + [(50, 203, None), (50, 204, 9000), (51, None, 8000), (52, 1, 8000)]
    df = spark.createDataFrame(rows, "_txnID bigint, attempt bigint, timestamp bigint")
    src = in_files(df, ["timestamp", "attempt"], 3, f"{tmp_path}/in", spark)
    q = drained(start_keyed_ttl(src, f"{tmp_path}/out", f"{tmp_path}/c", ttl_ms=5000, buckets=3))
    got = spark.read.schema(df.schema).parquet(f"{tmp_path}/out").collect()
    order = lambda r: [(x is not None, x) for x in r]
    want = dedup_ttl(df, "_txnID", "timestamp", "attempt", 5000).select(*df.columns).collect()
    assert sorted(map(tuple, got), key=order) == sorted(map(tuple, want), key=order)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 3  # a value and a timer per bucket, not per key


def test_running_count_stream_has_no_gap(spark, tmp_path):
    df = spark.createDataFrame([(i, 1000 * (i // 3)) for i in range(50)], "c bigint, t bigint")
    src = in_files(df, ["t", "c"], 4, f"{tmp_path}/in", spark)
    drained(counters.start_running_count(src, "t", "c", f"{tmp_path}/out", f"{tmp_path}/ck"))
    read = lambda: sorted((r["count"], r.c) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    want = [(i + 1, i) for i in range(50)]
    assert read() == want
    # a replayed micro-batch numbers alike, also when later ones are written already
    batch = spark.read.parquet(f"{tmp_path}/out/batch=1").select("c", "t")
    batch = spark.createDataFrame(batch.collect(), "c bigint, t bigint")
    counters.count_batch("t", "c", f"{tmp_path}/out", f"{tmp_path}/ck/counts")(batch, 1)
    assert read() == want


def test_totals_stream_ends_at_the_batch_totals(spark, tmp_path):
    banks = fx.banks(spark, SF_SMALL)
    src = in_files(banks, ["_key"], 3, f"{tmp_path}/in", spark)
    drained(counters.start_totals(src, accounts.total_columns(), f"{tmp_path}/out", f"{tmp_path}/ck"))
    written = spark.read.parquet(f"{tmp_path}/out")
    assert written.count() >= 3
    assert counters.last_totals(written).first() == accounts.totals(banks).first()


def test_variant_keeps_nested_values(spark):
    from payflux.functions import scalar as fn

    rows = [('{"error":{"code":3,"more":[1,{"x":"y"}]}}',), ("{'error':1}",), ('{"error"',), (None,), ("[]",)]
    o = spark.createDataFrame(rows, "evt string").select("evt", fn.json_to_variant("evt").alias("o"))
    got = o.select(fn.object_get("o", "$.error.more[1].x"), fn.object_get("o", "$.error.code", "int"), fn.object_json("o", "$.error")).collect()
    assert tuple(got[0]) == ("y", 3, json.dumps({"code": 3, "more": [1, {"x": "y"}]}, separators=(",", ":")))
    assert all(tuple(r) == (None, None, None) for r in got[1:])


def test_arrival_is_the_files_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        f = tmp_path / "in" / f"{k}.json"
        f.write_text(json.dumps({"_txnID": k, "cents": 1}))
        os.utime(f, (1_700_000_000 + k,) * 2)
    src = streams.read_json_stream(spark, f"{tmp_path}/in", schemas.PAYMENT_LINES, arrival="arrived")
    drained(src.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c")
            .trigger(availableNow=True).start())
    assert sorted((r["_txnID"], r.arrived) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(0, 1_700_000_000_000), (1, 1_700_000_001_000)]
