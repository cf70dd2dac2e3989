"""Declared schemas of the clearing streams and tables.

JSON sources map attributes by name: a missing field becomes NULL, an extra
field is dropped (what ``from_json`` does with a declared schema).
"""

from pyspark.sql.types import (DoubleType, LongType, StringType, StructField,
                               StructType)

S, L, D = StringType(), LongType(), DoubleType()


def _struct(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


PAYMENTS = _struct(("source_bank", S), ("target_bank", S), ("amount", D),
                   ("currency", S), ("_txnID", L), ("timestamp", L))

SETTLEMENTS = _struct(("source_bank", S), ("target_bank", S), ("amount", D),
                      ("currency", S), ("timestamp", L), ("source_region", S),
                      ("target_region", S), ("_txnID", L))

TRANSFERS = _struct(("source_bank", S), ("target_bank", S), ("amount", D),
                    ("currency", S), ("timestamp", L), ("_txnID", L))

PAYEE_CONFIRMATIONS = _struct(("source_bank", S), ("target_bank", S), ("amount", D),
                              ("currency", S), ("timestamp", L), ("status", S),
                              ("_txnID", L))

CONFIRMATIONS = _struct(("settlement_id", L), ("source_bank", S), ("target_bank", S),
                        ("amount", D), ("currency", S), ("timestamp", L),
                        ("source_region", S), ("status", S), ("_txnID", L))

PAYER_CONFIRMATIONS = _struct(("_txnID", L), ("source_bank", S), ("target_bank", S),
                              ("amount", D), ("currency", S), ("status", S),
                              ("timestamp", L), ("message", S))

BANKS = _struct(("_key", S), ("uuid", S), ("name", S), ("balance", L),
                ("reserved", L), ("currency", S), ("region", S))

PAYMENT_REQUESTS = _struct(("source_bank", S), ("target_bank", S), ("amount", D),
                           ("currency", S), ("timestamp", L), ("_txnID", L))

SETTLEMENT = _struct(("_key", S), ("settlement_id", L), ("source_bank", S),
                     ("target_bank", S), ("source_region", S), ("target_region", S),
                     ("amount", D), ("currency", S), ("timestamp", L), ("status", S),
                     ("_txnID", L))

LEDGER = _struct(("settlement_id", L), ("source_bank", S), ("target_bank", S),
                 ("amount", D), ("currency", S), ("timestamp", L), ("status", S),
                 ("_txnID", L))

COUNT_EVENTS = _struct(("c", L), ("t", L))

# signed account deltas appended by the payment and confirmation workers
BANK_DELTAS = _struct(("_key", S), ("d_balance", D), ("d_reserved", D))

# status updates appended by SW2 (last write per transaction wins)
SETTLEMENT_STATUS = _struct(("_txnID", L), ("status", S), ("timestamp", L))

# V2 Settlement rows inserted by SW1
SETTLEMENT_V2 = _struct(("settlement_id", L), ("source_bank", S), ("target_bank", S),
                        ("source_region", S), ("amount", D), ("currency", S),
                        ("timestamp", L), ("status", S), ("_txnID", L))

# SLA monitor entry stream: a payment before it is stamped with its entry time
PAYMENTS_SLA = _struct(("source_bank", S), ("target_bank", S), ("amount", D),
                       ("currency", S), ("_txnID", L))

# V8 Confirmations (SW2 -> CW) and V8 Ledger rows
CONFIRMATIONS_V8 = _struct(("source_bank", S), ("target_bank", S), ("source_region", S),
                           ("target_region", S), ("amount", D), ("currency", S),
                           ("timestamp", L), ("status", S), ("_txnID", L))
LEDGER_V8 = _struct(("source_bank", S), ("target_bank", S), ("amount", D), ("currency", S),
                    ("timestamp", L), ("status", S), ("_txnID", L))

# simplified flow (V3/V4): Settlements carry only the source region
SETTLEMENTS_SIMPLE = _struct(("source_bank", S), ("target_bank", S), ("source_region", S),
                             ("amount", D), ("currency", S), ("timestamp", L), ("_txnID", L))
LEDGER_SIMPLE = _struct(("_key", S), ("source_bank", S), ("target_bank", S), ("amount", D),
                        ("currency", S), ("timestamp", L), ("status", S))

# payment payloads of the malformed-line query
PAYMENT_LINES = _struct(("_txnID", L), ("source_bank", S), ("cents", L))
