"""Simplified flow (V3/V4): no validation, name-derived regions, post everything in region."""

from payflux.config import FlowConfig
from payflux.plans import simplified

CFG = FlowConfig(home_region="west", name_regions=(("Chase", "west"),), name_default_region="east")


def test_confirmation_worker_posts_failed_as_accepted(spark):
    banks = spark.createDataFrame(
        [("Chase_1", 100, 10), ("Chase_2", 50, 0), ("Fargo_1", 70, 5)],
        "_key string, balance long, reserved long")
    conf = spark.createDataFrame(
        [("Chase_1", "Chase_2", 10.0, "USD", 1, "failed", 7),    # posted despite 'failed'
         ("Fargo_1", "Chase_2", 5.0, "USD", 2, "settled", 8)],   # other region: ignored
        "source_bank string, target_bank string, amount double, currency string, timestamp long, "
        "status string, _txnID long")
    conf = simplified.settlement_confirm(conf.withColumnRenamed("status", "raw")
                                         .selectExpr("*", "'RJCT' AS status").drop("raw"), CFG)
    ledger, payer, _, after = simplified.confirmation_worker(conf, banks, CFG)
    assert [r["_key"] for r in ledger.collect()] == ["7"]
    assert [r["status"] for r in payer.collect()] == ["ACCP"]
    got = {r["_key"]: (r["balance"], r["reserved"]) for r in after.collect()}
    assert got == {"Chase_1": (90.0, 0.0), "Chase_2": (60.0, 0.0), "Fargo_1": (70.0, 5.0)}


def test_payment_worker_reserves_without_validation(spark):
    banks = spark.createDataFrame([("Chase_1", 100, 0)], "_key string, balance long, reserved long")
    pay = spark.createDataFrame(
        [("Chase_1", "Fargo_9", -1.0, "EUR", 1, 1), ("Chase_1", None, 500.0, None, 2, 2)],
        "source_bank string, target_bank string, amount double, currency string, timestamp long, _txnID long")
    settlements, requests, _, after = simplified.payment_worker(pay, banks, CFG)
    assert {r["source_region"] for r in settlements.collect()} == {"west"}
    assert requests.count() == 2
    assert after.first()["reserved"] == 499.0
    reg = simplified.settlement_register(settlements, CFG)
    # Fargo_9 maps to east and NULL to the default (east): neither is this region's
    assert reg.count() == 0


def test_v8_confirmation_worker_chains_on_answers(spark):
    from payflux.plans.confirmation import confirmation_worker_v8

    cfg = FlowConfig(home_region="west")
    banks = spark.createDataFrame([("A", 100, 10), ("B", 50, 0)], "_key string, balance long, reserved long")
    conf = spark.createDataFrame(
        [("A", "B", 10.0, "USD", 1, "west", "failed", 1),    # both exist: posted although 'failed'
         ("A", "Z", 5.0, "USD", 2, "west", "settled", 2),    # payee unknown: no answer, nothing moves
         ("Q", "B", 7.0, "USD", 3, "west", "settled", 3),    # payer unknown: payee credited only
         ("A", "B", 1.0, "USD", 4, "east", "settled", 4)],   # other region
        "source_bank string, target_bank string, amount double, currency string, timestamp long, "
        "source_region string, status string, _txnID long")
    out = confirmation_worker_v8(conf, banks, cfg)
    got = {r["_key"]: (r["balance"], r["reserved"]) for r in out.banks.collect()}
    assert got == {"A": (90.0, 0.0), "B": (67.0, 0.0)}
    assert sorted(r["_txnID"] for r in out.ledger.collect()) == [1, 3]
    rig = confirmation_worker_v8(conf, banks, cfg, ledger_after="source")
    assert [r["_txnID"] for r in rig.ledger.collect()] == [1]
