"""Ordered folds equal a plain-Python sequential model, on the fold path and on
the distributed hot-key round path (forced with a tiny group bound)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from payflux.operators.ordered import ordered_admission, ttl_first_seen
from payflux.plans import payment
from payflux.sources import fixtures as fx


def _admission_model(rows, funds):
    out, free = {}, {k: Decimal(str(v)).quantize(Decimal("0.000001")) for k, v in funds.items()}
    for r in sorted(rows, key=lambda r: (r["source_bank"], r["timestamp"], r["_txnID"])):
        a = Decimal(repr(r["amount"])).quantize(Decimal("0.000001"))
        k = r["source_bank"]
        ok = k in free and a <= free[k]
        if ok:
            free[k] -= a
        out[r["_txnID"]] = ok
    return out


def _candidates(spark):
    banks = fx.banks(spark, SF_MID)
    chk = payment.enrich_and_check(fx.payments(spark, SF_MID), banks, fx.presence(spark, SF_MID))
    cand = chk.filter(F.col("failedMsg").isNull() & F.col("source_balance").isNotNull()) \
              .select("source_bank", "timestamp", "_txnID", "amount")
    funds = banks.select(F.col("_key").alias("source_bank"),
                         (F.col("balance") - F.col("reserved")).alias("free"))
    return cand, funds


@pytest.mark.parametrize("group_rows,segments", [(4096, None), (3, 5)])
def test_admission_matches_sequential_model(spark, group_rows, segments):
    cand, funds = _candidates(spark)
    got = {r["_txnID"]: r["admitted"] for r in
           ordered_admission(cand, funds, group_rows=group_rows, segments=segments).collect()}
    rows = [r.asDict() for r in cand.collect()]
    want = _admission_model(rows, {r["source_bank"]: r["free"] for r in funds.collect()})
    assert got == want
    assert sum(got.values()) > 0 and not all(got.values())


def test_admission_hot_key(spark):
    """One account holds every candidate: it is split into rounds, never gathered."""
    cand, _ = _candidates(spark)
    hot = cand.withColumn("source_bank", F.lit("HOT"))
    total = hot.agg(F.sum("amount")).first()[0]
    funds = spark.range(1).select(F.lit("HOT").alias("source_bank"), F.lit(total / 3).alias("free"))
    got = {r["_txnID"]: r["admitted"] for r in
           ordered_admission(hot, funds, group_rows=64, segments=7).collect()}
    want = _admission_model([r.asDict() for r in hot.collect()], {"HOT": total / 3})
    assert got == want


def _ttl_model(rows, ttl):
    """Sequential model: number of kept rows per distinct (txn, attempt, timestamp)."""
    kept, last = {}, {}
    for r in sorted(rows, key=lambda r: (r["_txnID"], r["timestamp"], r["attempt"])):
        k = r["_txnID"]
        keep = k not in last or r["timestamp"] >= last[k] + ttl
        if keep:
            last[k] = r["timestamp"]
        ident = (k, r["attempt"], r["timestamp"])
        kept[ident] = kept.get(ident, 0) + int(keep)
    return kept


def _ttl_got(df):
    return {(r["_txnID"], r["attempt"], r["timestamp"]): int(r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("group_rows", [4096, 2])
def test_ttl_dedup_matches_model(spark, group_rows):
    rows = fx.payment_retries(spark, SF_MID).select("_txnID", "attempt", "timestamp")
    got = _ttl_got(ttl_first_seen(rows, ttl_ms=5000, group_rows=group_rows))
    want = _ttl_model([r.asDict() for r in rows.collect()], 5000)
    assert got == want


def test_ttl_dedup_hot_key(spark):
    """A third of all rows are copies of one transaction re-sent within a minute."""
    rows = fx.payment_retries(spark, SF_MID).select("_txnID", "attempt", "timestamp")
    is_hot = F.col("_txnID") % 3 == 0
    hot = rows.select(
        F.when(is_hot, F.lit(-1)).otherwise(F.col("_txnID")).alias("_txnID"),
        (F.col("_txnID") * 10 + F.col("attempt")).alias("attempt"),
        F.when(is_hot, F.col("timestamp") % 60_000).otherwise(F.col("timestamp")).alias("timestamp"))
    got = _ttl_got(ttl_first_seen(hot, ttl_ms=5000, group_rows=256))
    want = _ttl_model([r.asDict() for r in hot.collect()], 5000)
    assert got == want


def test_ttl_dedup_hot_key_long_span(spark):
    """A third of all rows share one key over the whole time range: thousands of
    kept rows, marked by pointer doubling in logarithmically many rounds."""
    rows = fx.payment_retries(spark, SF_MID).select("_txnID", "attempt", "timestamp")
    is_hot = F.col("_txnID") % 3 == 0
    hot = rows.select(F.when(is_hot, F.lit(-1)).otherwise(F.col("_txnID")).alias("_txnID"),
                      (F.col("_txnID") * 10 + F.col("attempt")).alias("attempt"), "timestamp")
    got = _ttl_got(ttl_first_seen(hot, ttl_ms=5000, group_rows=256))
    want = _ttl_model([r.asDict() for r in hot.collect()], 5000)
    assert sum(v for (k, _, _), v in want.items() if k == -1) > 1000
    assert got == want


def test_admission_hot_key_single_instant(spark):
    """One account, every candidate at the same instant: the range segments
    still cut it evenly (the tie column orders inside the instant)."""
    cand, _ = _candidates(spark)
    hot = cand.withColumn("source_bank", F.lit("HOT")).withColumn("timestamp", F.lit(0).cast("bigint"))
    total = hot.agg(F.sum("amount")).first()[0]
    funds = spark.range(1).select(F.lit("HOT").alias("source_bank"), F.lit(total / 2).alias("free"))
    got = {r["_txnID"]: r["admitted"] for r in
           ordered_admission(hot, funds, group_rows=64, segments=6).collect()}
    want = _admission_model([r.asDict() for r in hot.collect()], {"HOT": total / 2})
    assert got == want


def test_admission_hot_key_without_funds_keeps_rows(spark):
    """A hot account missing from the funds table: every row comes back, none admitted."""
    cand, funds = _candidates(spark)
    hot = cand.withColumn("source_bank", F.lit("GHOST"))
    got = ordered_admission(hot, funds, group_rows=64, segments=4)
    assert got.count() == hot.count()
    assert got.filter("admitted").count() == 0


@pytest.mark.parametrize("group_rows", [2, 4096])
def test_ttl_dedup_null_and_hot_keys_alike_at_any_bound(spark, group_rows):
    rows = [(None if i % 3 == 0 else i % 7, i // 3, i * 700 % 20_000) for i in range(90)] * 2
    df = spark.createDataFrame(rows, "_txnID bigint, attempt bigint, timestamp bigint")
    got = sorted(((r["_txnID"] is None, r["_txnID"] or 0, r["timestamp"], r["attempt"]) for r in
                  ttl_first_seen(df, ttl_ms=5000, group_rows=group_rows).filter("kept").collect()))
    want, last = [], {}
    for k, a, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1])):
        if k not in last or t >= last[k] + 5000:
            last[k] = t
            want.append((k is None, k or 0, t, a))
    assert got == sorted(want)
    assert any(w[0] for w in want)


@pytest.mark.parametrize("group_rows", [2, 4096])
def test_admission_negative_and_null_amounts_alike_at_any_bound(spark, group_rows):
    rows = [("a", i, i, [3.0, -2.0, 5.0, None, 0.0, 7.0][i % 6]) for i in range(24)] + [(None, i, 100 + i, 1.0) for i in range(6)]
    cand = spark.createDataFrame(rows, "source_bank string, timestamp bigint, _txnID bigint, amount double")
    funds = spark.createDataFrame([("a", 21.0)], "source_bank string, free double")
    got = {r["_txnID"]: r["admitted"] for r in ordered_admission(cand, funds, group_rows=group_rows, segments=3).collect()}
    free, want = 21.0, {}
    for k, _, i, a in rows:
        want[i] = k == "a" and a is not None and 0 <= a <= free
        free -= a if want[i] else 0
    assert got == want


def test_admission_rounds_stay_few_on_alternating_amounts(spark, monkeypatch):
    """1, F - 1, 1, F - 1, ...: each round takes at least half of the funds."""
    from payflux.operators import ordered

    n, funds_of = 400, 1000.0
    rows = [("a", i, i, 1.0 if i % 2 == 0 else funds_of - 1 - i / 4) for i in range(n)]
    cand = spark.createDataFrame(rows, "source_bank string, timestamp bigint, _txnID bigint, amount double")
    funds = spark.createDataFrame([("a", funds_of)], "source_bank string, free double")
    rounds, real = [], ordered._prefix_round
    monkeypatch.setattr(ordered, "_prefix_round", lambda *a, **k: rounds.append(1) or real(*a, **k))
    got = {r["_txnID"]: r["admitted"] for r in ordered_admission(cand, funds, group_rows=2, segments=2).collect()}
    free, want = funds_of, {}
    for _, _, i, a in rows:
        want[i] = a <= free
        free -= a if want[i] else 0
    assert got == want and len(rounds) <= 12


def test_rows_without_id_all_pass_durable_dedup(spark):
    from payflux.operators.dedup import dedup_durable

    rows = [(None, 1, "x")] * 3 + [(None, 2, "y"), (5, 2, "b"), (5, 1, "a"), (6, 1, "c")]
    df = spark.createDataFrame(rows, "_txnID bigint, timestamp bigint, v string")
    done = spark.createDataFrame([(6,)], "_txnID bigint")
    got = sorted((r["_txnID"] or 0, r["timestamp"], r["v"]) for r in dedup_durable(df, done).collect())
    assert got == [(0, 1, "x")] * 3 + [(0, 2, "y"), (5, 1, "a")]


def test_ttl_fold_deals_rows_by_key_first(spark):
    """Copies are collapsed after the rows are dealt by key: one exchange, no table of rows on the map side."""
    from payflux.operators.dedup import dedup_ttl

    rows = [(k % 5 or None, a % 7, 1000 * (a % 7), 1.0) for k in range(10) for a in range(14)]
    df = spark.createDataFrame(rows, "_txnID bigint, attempt bigint, timestamp bigint, amount double")
    got = dedup_ttl(df, ttl_ms=3000, with_flag=True)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = {(k, a): a % 3 == 0 for k in (None, 1, 2, 3, 4) for a in range(7)}
    assert {(r._txnID, r.attempt): r.kept for r in got.collect()} == want
    assert {r.copies for r in got.collect()} == {4} and got.count() == len(want)


def test_ttl_successors_take_numbers(spark):
    """Successors need a key, a number in its order and a time; NULL is a key like any other."""
    from payflux.operators.ordered import _spanning_keys, range_segments, ttl_successors

    rows = [(None if i % 3 == 0 else i % 3, i, 1000 * (i // 3)) for i in range(90)]
    nodes = spark.createDataFrame(rows, "k bigint, _id bigint, _t bigint")
    want = {i: (i + 15 if i + 15 < 90 else None) for i in range(90)}
    for n in (1, 4, 40):
        assert {r._id: r._nxt for r in ttl_successors(nodes, "k", 5000, n).collect()} == want
    ordered = spark.createDataFrame([(r[0], j, r[2]) for j, r in enumerate(sorted(rows, key=lambda r: (r[0] or 0, r[1])))], nodes.schema)
    assert _spanning_keys(range_segments(ordered, "k", ["_id"], 1), "k").isEmpty()
    segs = range_segments(ordered, "k", ["_id"], 7)
    want_keys = {r.k for r in segs.groupBy("k").agg({"_seg": "max"}).collect() if segs.where(segs.k.eqNullSafe(r.k)).select("_seg").distinct().count() > 1}
    assert {r._sk for r in _spanning_keys(segs, "k").collect()} == want_keys and None in want_keys
