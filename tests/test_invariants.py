"""Whole-flow invariants on the derived sf0.01 inputs."""

from pyspark.sql import functions as F

from conftest import SF_MID
from payflux.operators import accounts
from payflux.plans import clearing
from payflux.sources import fixtures as fx


def _flow(spark):
    return clearing.clearing_flow(fx.payments(spark, SF_MID), fx.banks(spark, SF_MID),
                                  fx.payment_requests(spark, SF_MID), fx.presence(spark, SF_MID))


def test_clearing_invariants(spark):
    banks = fx.banks(spark, SF_MID)
    out = _flow(spark)
    before = accounts.totals(banks).first()
    after = accounts.totals(out.banks).first()
    # money moves between accounts, it is never created or destroyed
    assert before.total_banks == after.total_banks
    assert round(after.total_balance, 4) == round(float(before.total_balance), 4)
    # Bank B accepts everything, so every reservation of a known home bank is settled
    assert round(after.total_reserved, 6) == 0.0
    # ledger rows = posted confirmations = accepted + rejected
    n_ledger = out.cw.ledger.count()
    assert n_ledger == out.cw.payer.count() == out.cw.accepted.count() + out.cw.rejected.count()
    assert out.cw.unrouted.count() == 0


def test_every_payment_accounted_once(spark):
    pay = fx.payments(spark, SF_MID)
    out = _flow(spark)
    deduped = pay.join(fx.payment_requests(spark, SF_MID).select("_txnID"), "_txnID", "left_semi")
    n_pass = out.pw.settlements.count()
    n_fail = out.pw.failed.count()
    assert n_pass + n_fail + deduped.count() == pay.count()
    ids = out.pw.settlements.select("_txnID").unionByName(out.pw.failed.select("_txnID"))
    assert ids.distinct().count() == n_pass + n_fail


def test_reserve_then_release_restores_reserved(spark):
    banks = fx.banks(spark, SF_MID)
    out = _flow(spark)
    admitted = out.pw.reserve.withColumnRenamed("_key", "source_bank") \
                             .withColumn("amount", F.col("d_reserved"))
    restored = accounts.apply_deltas(out.pw.banks, accounts.release_deltas(admitted))
    got = {r["_key"]: r["reserved"] for r in restored.collect()}
    assert all(abs(v) < 1e-9 for v in got.values())
    assert {r["_key"] for r in banks.collect()} == set(got)
