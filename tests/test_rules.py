"""Validation chains on hand-made rows: every branch, in rule order, and NULLs."""

from pyspark.sql import functions as F

from payflux.config import FlowConfig
from payflux.operators import rules

COLS = "source_bank string, target_bank string, amount double, currency string, " \
       "source_balance bigint, source_total_reserved bigint, source_region string, expected string"

V2_CASES = [
    # unknown source bank: every bank column NULL -> passes
    ("Bank_9", "Bank_1", 10.0, "USD", None, None, None, None),
    # branch 13: NULL source key with bank columns set (unreachable after the join)
    (None, "Bank_1", 10.0, "USD", 100, 0, "ASIA", "Source bank parameter is not set"),
    ("Bank_2", "Bank_1", 10.0, "USD", 100, 0, "EUROPE", "Source bank Bank_2 belongs to another region"),
    ("Bank_2", None, 10.0, "USD", 100, 0, "ASIA", "Target bank parameter is not set"),
    # NULL region: the region comparison is not true, the later NULL-region rule fires
    ("Bank_2", "Bank_1", 10.0, "USD", 100, 0, None, "Source bank with name Bank_2 parameter is not set"),
    ("Bank_2", "Bank_1", None, "USD", 100, 0, "ASIA", "Amount parameter is not set"),
    ("Bank_2", "Bank_1", 0.0, "USD", 100, 0, "ASIA",
     "Amount of money should be more than 0 and less or equall to 100000"),
    ("Bank_2", "Bank_1", 100000.5, "USD", 10**9, 0, "ASIA",
     "Amount of money should be more than 0 and less or equall to 100000"),
    ("Bank_2", "Bank_1", 10.0, None, 100, 0, "ASIA", "Only USD currency is acceptable"),
    ("Bank_2", "Bank_1", 10.0, "EUR", 100, 0, "ASIA", "Only USD currency is acceptable"),
    ("Bank_2", "Bank_1", 10.0, "USD", 100, 95, "ASIA", "No sufficient funds on source bank"),
    ("Bank_2", "Bank_1", 5.0, "USD", 100, 95, "ASIA", None),  # exactly enough
]


def _check(spark, cases, expr):
    df = spark.createDataFrame(cases, COLS)
    got = df.select(expr.alias("m"), "expected").collect()
    for r, case in zip(got, cases):
        assert r["m"] == r["expected"], (case, r["m"])


def test_v2_rules_every_branch(spark):
    _check(spark, V2_CASES, rules.payment_rules(FlowConfig()))


def test_v2_first_hit_wins(spark):
    # other region AND bad amount AND bad currency: the region rule comes first
    case = [("Bank_2", None, -5.0, "EUR", 1, 0, "EUROPE", "Source bank Bank_2 belongs to another region")]
    _check(spark, case, rules.payment_rules(FlowConfig()))


V1_CASES = [
    # JS truthiness: region '' and balance 0 and reserved 0 pass like an unknown bank
    ("Bank_2", "Bank_1", 10.0, "USD", 0, 0, "", None),
    ("", "Bank_1", 10.0, "USD", 100, 0, "ASIA", "Source bank parameter is not set"),
    # NULL region compares as different in JavaScript
    ("Bank_2", "Bank_1", 10.0, "USD", 100, 0, None, "Source bank Bank_2 belongs to another region"),
    ("Bank_2", "", 10.0, "USD", 100, 0, "ASIA", "Target bank parameter is not set"),
    ("Bank_2", "Bank_1", 0.0, "USD", 100, 0, "ASIA", "Amount parameter is not set"),
    ("Bank_2", "Bank_1", 10001.0, "USD", 10**9, 0, "ASIA",
     "Amount of money should be more than 0 and less or equall to 10000"),
    ("Bank_2", "Bank_1", 10.0, "", 100, 0, "ASIA", "Only USD currency is acceptable"),
    ("Bank_2", "Bank_1", 10.0, "USD", 5, 0, "ASIA", "No sufficient funds on source bank"),
    ("Bank_2", "Bank_1", 10.0, "USD", 10, 0, "ASIA", None),
]


def test_v1_rules_js_truthiness(spark):
    _check(spark, V1_CASES, rules.payment_rules_v1(FlowConfig(max_amount=10000.0)))


def test_settlement_rules_order(spark):
    cols = "source_bank string, target_bank string, amount double, currency string, " \
           "loaded_source_bank string, loaded_target_bank string, loaded_amount double, " \
           "loaded_currency string, loaded_status string, timestamp bigint, expected string"
    cases = [
        ("A", "B", 1.0, "USD", None, None, None, None, None, 0, "Transaction has not been found"),
        ("A", "B", 1.0, "USD", "X", "Y", 2.0, "EUR", "active", 0, "Source bank is different for this transaction"),
        ("A", "B", 1.0, "USD", "A", "Y", 2.0, "EUR", "active", 0, "Target bank is different for this transaction"),
        ("A", "B", 1.0, "USD", "A", "B", 2.0, "EUR", "active", 0, "Amount is different for this transaction"),
        ("A", "B", 1.0, "USD", "A", "B", 1.0, "EUR", "active", 0, "Currency is different for this transaction"),
        ("A", "B", 1.0, "USD", "A", "B", 1.0, "USD", "settled", 0, None),
    ]
    df = spark.createDataFrame(cases, cols)
    got = df.select(rules.settlement_rules().alias("m"), "expected").collect()
    assert [r["m"] for r in got] == [r["expected"] for r in got]
    # opt-in status check catches the completed settlement
    got = df.select(rules.settlement_rules(check_active=True).alias("m")).collect()
    assert got[-1]["m"] == "Transaction already completed"


def test_payee_status_and_region_by_name(spark):
    df = spark.createDataFrame([("ACCP", "Chase_1"), ("RJCT", "Fargo_2"), (None, None)], "s string, b string")
    out = df.select(rules.payee_status(F.col("s")).alias("st"),
                    rules.region_by_name(F.col("b"), [("Chase", "west")], "east").alias("r")).collect()
    assert [(r.st, r.r) for r in out] == [("settled", "west"), ("failed", "east"), ("failed", "east")]
