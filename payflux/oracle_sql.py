"""Independent DuckDB SQL for every registered query (the correctness oracle).

Fixture derivations are CTEs over the raw driver views (customer, orders,
lineitem, events, ...), written separately from the Spark code. Ordered folds
(admission, TTL dedup) are recursive CTEs that walk each key row by row.
"""

from __future__ import annotations

HOME = "ASIA"

# fixture CTE name -> (dependencies, body)
_FIX: dict[str, tuple[tuple[str, ...], str]] = {
    "banks": ((), """
  SELECT 'Bank_' || CAST(c.c_custkey AS VARCHAR) AS _key, CAST(c.c_custkey AS VARCHAR) AS uuid,
         c.c_name AS name, CAST(round(c.c_acctbal * 20) AS BIGINT) AS balance,
         CAST(0 AS BIGINT) AS reserved, 'USD' AS currency,
         CASE WHEN c.c_custkey % 101 = 0 THEN NULL ELSE r.r_name END AS region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "orders_pay": ((), """
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderkey % 41 = 0 THEN 'Bank_X' || CAST(o_custkey AS VARCHAR)
              ELSE 'Bank_' || CAST(o_custkey AS VARCHAR) END AS source_bank,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL
              ELSE 'Bank_' || CAST((o_custkey * 7 + o_orderkey) % (SELECT count(*) * 16 // 15 FROM customer) AS VARCHAR)
         END AS target_bank,
         CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN CAST(-1.0 AS DOUBLE)
              ELSE o_totalprice / 4 END AS amount,
         CASE WHEN o_orderkey % 17 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
         o_orderkey AS _txnID, epoch_us(o_orderdate) // 1000 AS timestamp, o_orderstatus
  FROM orders"""),
    "payments": (("orders_pay",), """
  SELECT source_bank, target_bank, amount, currency, _txnID, timestamp FROM orders_pay"""),
    "payments_v1": ((), """
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderkey % 41 = 0 THEN 'Unknown#' || CAST(o_custkey AS VARCHAR)
              ELSE 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS source_bank,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL
              ELSE 'Customer#' || lpad(CAST((o_custkey * 7 + o_orderkey)
                                            % (SELECT count(*) * 16 // 15 FROM customer) AS VARCHAR), 9, '0')
         END AS target_bank,
         CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN CAST(-1.0 AS DOUBLE)
              ELSE o_totalprice / 4 END AS amount,
         CASE WHEN o_orderkey % 17 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
         o_orderkey AS _txnID, epoch_us(o_orderdate) // 1000 AS timestamp
  FROM orders"""),
    "payee": (("orders_pay",), """
  SELECT source_bank, CASE WHEN _txnID % 43 = 0 THEN 'Bank_Other' ELSE target_bank END AS target_bank,
         CASE WHEN _txnID % 37 = 0 THEN amount + 1 ELSE amount END AS amount, currency, timestamp,
         CASE WHEN o_orderstatus = 'F' THEN 'RJCT' ELSE 'ACCP' END AS status, _txnID
  FROM orders_pay"""),
    "retries": ((), """
  SELECT l_orderkey AS _txnID, CAST(l_linenumber AS BIGINT) AS attempt,
         l_orderkey * 1000 + l_linenumber * 2000 AS timestamp, l_extendedprice AS amount
  FROM lineitem"""),
    "requests": (("payments",), """
  SELECT source_bank, target_bank, amount, currency, timestamp, _txnID FROM payments
  WHERE _txnID % 10 = 0"""),
    "settlement": (("payments", "banks"), """
  SELECT CAST(p._txnID AS VARCHAR) AS _key, p._txnID AS settlement_id, p.source_bank, p.target_bank,
         s.region AS source_region, t.region AS target_region, p.amount, p.currency, p.timestamp,
         CASE WHEN p._txnID % 29 = 0 THEN 'settled' ELSE 'active' END AS status, p._txnID
  FROM payments p LEFT JOIN banks s ON s._key = p.source_bank LEFT JOIN banks t ON t._key = p.target_bank
  WHERE p._txnID % 31 <> 0"""),
    "presence": ((), """
  SELECT 'Transfers' AS stream, r_name AS region,
         lower(replace(r_name, ' ', '-')) || '-sub1' AS subscriber
  FROM region WHERE r_name <> 'MIDDLE EAST'"""),
    "count_events": ((), """
  SELECT event_id AS c, epoch_us(ts) // 1000 AS t FROM events"""),
    "error_json": ((), r"""
  SELECT event_id,
         '{"c":' || CAST(event_id AS VARCHAR) || ',"t":' || CAST(epoch_us(ts) // 1000 AS VARCHAR)
         || ',"type":"' || coalesce(event_type, '') || '"'
         || CASE WHEN event_id % 2 = 0
                 THEN ',"error":"{\"message\":\"Count is Even.\",\"code\":' || CAST(event_id % 7 AS VARCHAR) || '}"'
                 ELSE '' END || '}' AS evt
  FROM events"""),
    # ---- payment worker (V2), funds applied in (timestamp, _txnID) order per bank
    "pw_distinct": (("payments", "requests"), """
  SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY _txnID ORDER BY timestamp) AS _rn FROM payments p) d
  WHERE _rn = 1 AND NOT EXISTS (SELECT 1 FROM requests r WHERE r._txnID = d._txnID)"""),
    "pw_checked": (("pw_distinct", "banks", "presence"), """
  SELECT p.source_bank, p.target_bank, p.amount, p.currency, p._txnID, p.timestamp,
         tc.region AS target_region, (pr.region IS NOT NULL) AS isDevicePresent,
         b.balance AS source_balance, b.reserved AS source_total_reserved, b.region AS source_region,
         {rules_nofunds} AS failedMsg
  FROM pw_distinct p
  LEFT JOIN banks tc ON tc._key = p.target_bank
  LEFT JOIN (SELECT DISTINCT region FROM presence
             WHERE stream = 'Transfers' AND subscriber LIKE '%-sub1') pr ON pr.region = tc.region
  LEFT JOIN banks b ON b._key = p.source_bank"""),
    "pw_cand": (("pw_checked",), """
  SELECT *, CAST(amount AS DECIMAL(24,6)) AS amt,
         CAST(source_balance - source_total_reserved AS DECIMAL(38,6)) AS free0,
         row_number() OVER (PARTITION BY source_bank ORDER BY timestamp, _txnID) AS rn
  FROM pw_checked
  WHERE isDevicePresent AND failedMsg IS NULL
    AND NOT (source_balance IS NULL AND source_total_reserved IS NULL AND source_region IS NULL)"""),
    "pw_fold": (("pw_cand",), """
  SELECT source_bank, rn,
         CAST(CASE WHEN amt <= free0 THEN free0 - amt ELSE free0 END AS DECIMAL(38,6)) AS r,
         amt <= free0 AS admitted
  FROM pw_cand WHERE rn = 1
  UNION ALL
  SELECT k.source_bank, k.rn,
         CAST(CASE WHEN k.amt <= f.r THEN f.r - k.amt ELSE f.r END AS DECIMAL(38,6)),
         k.amt <= f.r
  FROM pw_fold f JOIN pw_cand k ON k.source_bank = f.source_bank AND k.rn = f.rn + 1"""),
    "pw_decided": (("pw_cand", "pw_fold"), """
  SELECT c.*, f.admitted FROM pw_cand c JOIN pw_fold f USING (source_bank, rn)"""),
    "pw_passed": (("pw_decided", "pw_checked"), """
  SELECT source_bank, target_bank, amount, currency, timestamp, source_region, target_region, _txnID
  FROM pw_decided WHERE admitted
  UNION ALL
  SELECT source_bank, target_bank, amount, currency, timestamp, source_region, target_region, _txnID
  FROM pw_checked WHERE isDevicePresent AND failedMsg IS NULL
    AND source_balance IS NULL AND source_total_reserved IS NULL AND source_region IS NULL"""),
    "pw_failed": (("pw_checked", "pw_decided"), """
  SELECT _txnID, source_bank, target_bank, amount, currency, timestamp, 'Target bank is not present' AS message
  FROM pw_checked WHERE NOT isDevicePresent
  UNION ALL
  SELECT _txnID, source_bank, target_bank, amount, currency, timestamp, failedMsg
  FROM pw_checked WHERE isDevicePresent AND failedMsg IS NOT NULL
  UNION ALL
  SELECT _txnID, source_bank, target_bank, amount, currency, timestamp, 'No sufficient funds on source bank'
  FROM pw_decided WHERE NOT admitted"""),
    "pw_banks": (("banks", "pw_decided"), """
  SELECT b._key,
         CAST(CAST(b.balance AS DECIMAL(38,6)) AS DOUBLE) AS balance,
         CAST(CAST(b.reserved AS DECIMAL(38,6)) + coalesce(d.s, 0) AS DOUBLE) AS reserved
  FROM banks b LEFT JOIN (SELECT source_bank, sum(amt) AS s FROM pw_decided WHERE admitted GROUP BY 1) d
    ON d.source_bank = b._key"""),
    # ---- payment worker (V8): re-sends, TTL dedup, presence stubbed, unknown banks dropped
    "resends": (("payments",), """
  SELECT p.source_bank, p.target_bank, p.amount, p.currency, p._txnID,
         p.timestamp + (l.l_linenumber - 1) * 2000 AS timestamp
  FROM payments p JOIN lineitem l ON l.l_orderkey = p._txnID"""),
    "v8_rs": (("resends",), """
  SELECT *, row_number() OVER (PARTITION BY _txnID ORDER BY timestamp, source_bank, target_bank, amount, currency)
         AS rn FROM (SELECT DISTINCT * FROM resends) x"""),
    "v8_ttl": (("v8_rs",), """
  SELECT _txnID, rn, timestamp AS last, true AS kept FROM v8_rs WHERE rn = 1
  UNION ALL
  SELECT r._txnID, r.rn, CASE WHEN r.timestamp >= f.last + 5000 THEN r.timestamp ELSE f.last END,
         r.timestamp >= f.last + 5000
  FROM v8_ttl f JOIN v8_rs r ON r._txnID = f._txnID AND r.rn = f.rn + 1"""),
    "v8_distinct": (("v8_rs", "v8_ttl"), """
  SELECT r.source_bank, r.target_bank, r.amount, r.currency, r._txnID, r.timestamp
  FROM v8_rs r JOIN v8_ttl t ON t._txnID = r._txnID AND t.rn = r.rn WHERE t.kept"""),
    "v8_checked": (("v8_distinct", "banks"), """
  SELECT p.source_bank, p.target_bank, p.amount, p.currency, p._txnID, p.timestamp,
         tc.region AS target_region, true AS isDevicePresent,
         b.balance AS source_balance, b.reserved AS source_total_reserved, b.region AS source_region,
         {rules_nofunds} AS failedMsg
  FROM v8_distinct p
  LEFT JOIN banks tc ON tc._key = p.target_bank
  LEFT JOIN banks b ON b._key = p.source_bank"""),
    "v8_cand": (("v8_checked",), """
  SELECT *, CAST(amount AS DECIMAL(24,6)) AS amt,
         CAST(source_balance - source_total_reserved AS DECIMAL(38,6)) AS free0,
         row_number() OVER (PARTITION BY source_bank ORDER BY timestamp, _txnID) AS rn
  FROM v8_checked
  WHERE failedMsg IS NULL
    AND NOT (source_balance IS NULL AND source_total_reserved IS NULL AND source_region IS NULL)"""),
    "v8_fold": (("v8_cand",), """
  SELECT source_bank, rn,
         CAST(CASE WHEN amt <= free0 THEN free0 - amt ELSE free0 END AS DECIMAL(38,6)) AS r,
         amt <= free0 AS admitted
  FROM v8_cand WHERE rn = 1
  UNION ALL
  SELECT k.source_bank, k.rn,
         CAST(CASE WHEN k.amt <= f.r THEN f.r - k.amt ELSE f.r END AS DECIMAL(38,6)),
         k.amt <= f.r
  FROM v8_fold f JOIN v8_cand k ON k.source_bank = f.source_bank AND k.rn = f.rn + 1"""),
    "v8_decided": (("v8_cand", "v8_fold"), """
  SELECT c.*, f.admitted FROM v8_cand c JOIN v8_fold f USING (source_bank, rn)"""),
    # ---- V8 end to end: register (first per txn), Bank B, cache-else-table, validate, CW
    "v8f_reg": (("v8_decided",), """
  SELECT * FROM (
    SELECT source_bank, target_bank, source_region, target_region, amount, currency, timestamp, _txnID,
           CAST(_txnID AS VARCHAR) AS _key,
           row_number() OVER (PARTITION BY _txnID ORDER BY timestamp) AS _first
    FROM v8_decided WHERE admitted AND target_region IS NOT NULL) x
  WHERE _first = 1"""),
    # Bank B echoes the registered row at its own time, so a cache hit and a
    # table miss both load that same row: every rule compares equal values and
    # only "not found" (a NULL source bank) can fail; ACCP maps to 'settled'
    "v8f_conf": (("v8f_reg",), """
  SELECT source_bank, target_bank, source_region, target_region, amount, currency, timestamp,
         'settled' AS status, _txnID
  FROM v8f_reg WHERE source_bank IS NOT NULL"""),
    # ---- V8 SW2 tail: validated settlements whose status update answered
    "v8_conf": (("v8_loaded", "settlement"), """
        SELECT loaded_source_bank AS source_bank, loaded_target_bank AS target_bank,
               loaded_source_region AS source_region, loaded_target_region AS target_region,
               loaded_amount AS amount, loaded_currency AS currency, loaded_timestamp AS timestamp,
               CASE WHEN payee_status = 'ACCP' THEN 'settled' ELSE 'failed' END AS status, _txnID
        FROM (SELECT *, CASE WHEN loaded_source_bank IS NULL THEN 'Transaction has not been found'
                    WHEN loaded_source_bank <> source_bank THEN 'Source bank is different for this transaction'
                    WHEN loaded_target_bank <> target_bank THEN 'Target bank is different for this transaction'
                    WHEN loaded_amount <> amount THEN 'Amount is different for this transaction'
                    WHEN loaded_currency <> currency THEN 'Currency is different for this transaction'
                    ELSE NULL END AS failedMsg FROM v8_loaded) v
        WHERE failedMsg IS NULL
          AND EXISTS (SELECT 1 FROM settlement s WHERE s._key = CAST(v._txnID AS VARCHAR))"""),
    # ---- confirmations from the payee answers (V2 SW2 -> CW)
    "confirmations": (("payee",), """
  SELECT _txnID AS settlement_id, source_bank, target_bank, amount, currency, timestamp,
         CASE WHEN status = 'ACCP' THEN 'settled' ELSE 'failed' END AS status, _txnID
  FROM payee"""),
    "cw_valid": (("confirmations", "banks"), f"""
  SELECT c.*, b.region AS source_region FROM confirmations c LEFT JOIN banks b ON b._key = c.source_bank
  WHERE b.region = '{HOME}'"""),
    "v8_cache": (("settlement",), """
  SELECT _txnID, timestamp AS put_ts, source_bank, target_bank, source_region, target_region, amount, currency,
         source_bank IS NOT NULL AND target_bank IS NOT NULL AND source_region IS NOT NULL
         AND target_region IS NOT NULL AND amount IS NOT NULL AND currency IS NOT NULL AS has_json
  FROM settlement WHERE target_region IS NOT NULL"""),
    "v8_loaded": (("payee", "v8_cache", "settlement"), """
  SELECT p._txnID, p.source_bank, p.target_bank, p.amount, p.currency, p.status AS payee_status,
         (c._txnID IS NOT NULL AND c.has_json) AS cache_hit,
         CASE WHEN c.has_json THEN c.source_bank ELSE s.source_bank END AS loaded_source_bank,
         CASE WHEN c.has_json THEN c.target_bank ELSE s.target_bank END AS loaded_target_bank,
         CASE WHEN c.has_json THEN c.source_region ELSE s.source_region END AS loaded_source_region,
         CASE WHEN c.has_json THEN c.target_region ELSE s.target_region END AS loaded_target_region,
         CASE WHEN c.has_json THEN c.amount ELSE s.amount END AS loaded_amount,
         CASE WHEN c.has_json THEN c.currency ELSE s.currency END AS loaded_currency,
         CASE WHEN c.has_json THEN p.ts2 ELSE s.timestamp END AS loaded_timestamp,
         CASE WHEN c.has_json THEN 'active' ELSE s.status END AS loaded_status
  FROM (SELECT *, timestamp + _txnID % 9000 AS ts2 FROM payee) p
  LEFT JOIN v8_cache c ON c._txnID = p._txnID AND c.put_ts <= p.ts2 AND p.ts2 < c.put_ts + 5000
  LEFT JOIN settlement s ON s._key = CAST(p._txnID AS VARCHAR)"""),
}


def _rules(funds: bool, max_amount: str = "100000") -> str:
    body = f"""CASE
    WHEN b.region IS NULL AND b.reserved IS NULL AND b.balance IS NULL THEN NULL
    WHEN p.source_bank IS NULL THEN 'Source bank parameter is not set'
    WHEN b.region <> '{HOME}' THEN 'Source bank ' || p.source_bank || ' belongs to another region'
    WHEN p.target_bank IS NULL THEN 'Target bank parameter is not set'
    WHEN b.region IS NULL THEN 'Source bank with name ' || p.source_bank || ' parameter is not set'
    WHEN p.amount IS NULL THEN 'Amount parameter is not set'
    WHEN p.amount <= 0 OR p.amount > {max_amount} THEN 'Amount of money should be more than 0 and less or equall to {max_amount}'
    WHEN p.currency IS NULL OR p.currency <> 'USD' THEN 'Only USD currency is acceptable'"""
    if funds:
        body += "\n    WHEN b.balance - b.reserved < p.amount THEN 'No sufficient funds on source bank'"
    return body + "\n    ELSE NULL END"


def _with(names: tuple[str, ...], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _FIX[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    recursive = "RECURSIVE " if ("pw_fold" in order or "v8_ttl" in order) else ""
    ctes = ",\n".join(
        f"{n} AS ({_FIX[n][1].replace('{rules_nofunds}', _rules(False))}\n)" for n in order)
    return f"WITH {recursive}{ctes}\n{body}"


def _acct(src: str) -> str:
    return f"SELECT _key, balance, reserved FROM {src}"


_DELTA_APPLY = """
  SELECT b._key,
         CAST(CAST(b.balance AS DECIMAL(38,6)) + coalesce(d.db, 0) AS DOUBLE) AS balance,
         CAST(CAST(b.reserved AS DECIMAL(38,6)) + coalesce(d.dr, 0) AS DOUBLE) AS reserved
  FROM {base} b LEFT JOIN (
    SELECT _key, sum(CAST(d_balance AS DECIMAL(38,6))) AS db, sum(CAST(d_reserved AS DECIMAL(38,6))) AS dr
    FROM ({deltas}) x GROUP BY _key) d ON d._key = b._key"""

_SETTLE = """
    SELECT source_bank AS _key, -amount AS d_balance, -amount AS d_reserved FROM {src}
    UNION ALL SELECT target_bank, amount, 0.0 FROM {src}"""
_RELEASE = "SELECT source_bank AS _key, 0.0 AS d_balance, -amount AS d_reserved FROM {src}"

_TTL_DEDUP = """
WITH RECURSIVE r AS (
  SELECT *, row_number() OVER (PARTITION BY _txnID ORDER BY timestamp, attempt) AS rn FROM retries),
f AS (
  SELECT _txnID, rn, attempt, timestamp, timestamp AS last, true AS kept FROM r WHERE rn = 1
  UNION ALL
  SELECT r._txnID, r.rn, r.attempt, r.timestamp,
         CASE WHEN r.timestamp >= f.last + 5000 THEN r.timestamp ELSE f.last END,
         r.timestamp >= f.last + 5000
  FROM f JOIN r ON r._txnID = f._txnID AND r.rn = f.rn + 1)
SELECT _txnID, attempt, timestamp FROM f WHERE kept"""


def _cache_json(a: str = "") -> str:
    p = f"{a}." if a else ""
    return (f"'{{''sb'':''' || {p}source_bank || ''',''tb'':''' || {p}target_bank || ''',''sr'':''' || "
            f"{p}source_region || ''',''tr'':''' || {p}target_region || ''',''a'':' || "
            f"CAST({p}amount AS VARCHAR) || ',''c'':''' || {p}currency || ''',''s'':''active''}}'")


def oracle_sql() -> dict[str, str]:
    W = _with
    q: dict[str, str] = {}
    q["src_payments"] = W(("payments",), "SELECT * FROM payments")
    q["raw_payload"] = W(("error_json",), "SELECT event_id, evt FROM error_json")
    q["sink_json"] = W(("payments",), """SELECT _txnID, json_object('source_bank', source_bank,
        'target_bank', target_bank, 'amount', amount, 'currency', currency, 'timestamp', timestamp,
        '_txnID', _txnID)::VARCHAR AS payload FROM payments""")
    q["scan_banks"] = W(("banks",), "SELECT * FROM banks")
    q["append_requests"] = W(("requests", "pw_passed"), """
        SELECT source_bank, target_bank, amount, currency, timestamp, _txnID FROM requests
        UNION ALL SELECT source_bank, target_bank, amount, currency, timestamp, _txnID FROM pw_passed""")
    q["seed_banks"] = W(("banks",), """,
        t AS (SELECT o_orderkey + 1 AS c FROM orders),
        rows_ AS (
          SELECT 'Chase_' || CAST(c % 24000 AS VARCHAR) AS _key, CAST(c % 24000 AS VARCHAR) AS uuid,
                 'Fargo_' || CAST(c % 24000 AS VARCHAR) AS name, CAST(10000 AS BIGINT) AS balance,
                 CAST(0 AS BIGINT) AS reserved, 'USD' AS currency, 'cleaninghouse-us-west-1' AS region, c FROM t
          UNION ALL
          SELECT 'Fargo_' || CAST(c % 24000 AS VARCHAR), CAST(c % 24000 AS VARCHAR),
                 'Fargo_' || CAST(c % 24000 AS VARCHAR), CAST(10000 AS BIGINT), CAST(0 AS BIGINT), 'USD',
                 'cleaninghouse-us-east-1', c FROM t),
        firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _key ORDER BY c) AS rn FROM rows_) WHERE rn = 1)
        SELECT _key, uuid, name, balance, reserved, currency, region FROM firsts f
        WHERE NOT EXISTS (SELECT 1 FROM banks b WHERE b._key = f._key)""").replace("\n,\n", ",\n", 1)
    q["payload_template"] = W(("count_events",), """
        SELECT c AS count, '{"status":"Processed","count":' || CAST(c AS VARCHAR) || '}' AS payload
        FROM count_events""")
    q["tick_source"] = W(("count_events",), """
        SELECT x AS tick, x * 60000 AS tick_ts
        FROM generate_series((SELECT min(t) // 60000 FROM count_events), (SELECT max(t) // 60000 FROM count_events)) g(x)""")
    q["tick_counts"] = W(("count_events",), """
        SELECT x AS tick, x * 60000 AS tick_ts, (SELECT count(*) FROM count_events WHERE t // 60000 = x) AS n
        FROM generate_series((SELECT min(t) // 60000 FROM count_events), (SELECT max(t) // 60000 FROM count_events)) g(x)""")
    q["bank_cache"] = W(("banks",), "SELECT _key, region FROM banks")

    q["project_settlement"] = W(("settlement",), f"""
        SELECT _txnID AS settlement_id, source_bank, target_bank, source_region, amount, currency, timestamp,
               'active' AS status, _txnID FROM settlement WHERE target_region = '{HOME}'""")
    q["bank_b_accept"] = W(("settlement",), f"""
        SELECT source_bank, target_bank, amount, currency, timestamp, 'ACCP' AS status, _txnID
        FROM settlement WHERE target_region = '{HOME}'""")
    q["settlement_validate"] = W(("v8_loaded",), """
        SELECT _txnID, loaded_source_bank AS source_bank, loaded_target_bank AS target_bank,
               loaded_amount AS amount, payee_status,
               CASE WHEN loaded_source_bank IS NULL THEN 'Transaction has not been found'
                    WHEN loaded_source_bank <> source_bank THEN 'Source bank is different for this transaction'
                    WHEN loaded_target_bank <> target_bank THEN 'Target bank is different for this transaction'
                    WHEN loaded_amount <> amount THEN 'Amount is different for this transaction'
                    WHEN loaded_currency <> currency THEN 'Currency is different for this transaction'
                    ELSE NULL END AS failedMsg
        FROM v8_loaded""")
    q["v8_confirmations"] = W(("v8_conf",), "SELECT * FROM v8_conf")
    v8_mine = "(SELECT * FROM v8f_conf WHERE source_region = '" + HOME + "')"
    q["v8_flow"] = W(("banks", "v8_decided", "v8f_conf"), _DELTA_APPLY.format(
        base="banks", deltas=f"""SELECT source_bank AS _key, 0.0 AS d_balance, amt AS d_reserved
    FROM v8_decided WHERE admitted
    UNION ALL SELECT target_bank, amount, 0.0 FROM {v8_mine} m
    UNION ALL SELECT source_bank, -amount, -amount FROM {v8_mine} m
    WHERE EXISTS (SELECT 1 FROM banks b WHERE b._key = m.target_bank)"""))
    mine = "(SELECT * FROM v8_conf WHERE source_region = '" + HOME + "')"
    q["v8_confirm_worker"] = W(("banks", "v8_conf"), _DELTA_APPLY.format(
        base="banks", deltas=f"""SELECT target_bank AS _key, amount AS d_balance, 0.0 AS d_reserved FROM {mine} m
    UNION ALL SELECT source_bank, -amount, -amount FROM {mine} m
    WHERE EXISTS (SELECT 1 FROM banks b WHERE b._key = m.target_bank)"""))
    q["region_filter"] = W(("payments", "banks"), f"""
        SELECT p._txnID, p.source_bank, b.region AS source_region
        FROM payments p JOIN banks b ON b._key = p.source_bank WHERE b.region = '{HOME}'""")
    q["null_split"] = W(("payments", "banks"), f"""
        SELECT _txnID, CASE WHEN m IS NULL THEN 'validated' ELSE 'failed' END AS route FROM (
          SELECT p._txnID, {_rules(True)} AS m FROM payments p LEFT JOIN banks b ON b._key = p.source_bank)""")
    q["accept_reject_split"] = W(("cw_valid",), """
        SELECT _txnID, CASE WHEN status = 'settled' THEN 'accepted' WHEN status IS NULL THEN 'unrouted'
                            ELSE 'rejected' END AS route FROM cw_valid""")

    q["enrich_source_bank"] = W(("payments", "banks"), """
        SELECT p._txnID, p.source_bank, b.balance AS source_balance, b.reserved AS source_total_reserved,
               b.region AS source_region FROM payments p LEFT JOIN banks b ON b._key = p.source_bank""")
    q["enrich_target_region"] = W(("payments", "banks"), """
        SELECT p._txnID, p.target_bank, b.region AS target_region
        FROM payments p LEFT JOIN banks b ON b._key = p.target_bank""")
    q["settlement_with_bank"] = W(("payments_v1", "banks"), """
        SELECT p._txnID, p.target_bank, b.region AS target_region
        FROM payments_v1 p JOIN banks b ON b.name = p.target_bank""")
    q["payee_active_settlement"] = W(("payee", "settlement"), """
        SELECT s.settlement_id, s.source_bank, s.target_bank, s.source_region, s.amount, s.currency,
               s.timestamp, CASE WHEN c.status = 'ACCP' THEN 'settled' ELSE 'failed' END AS status, c._txnID
        FROM payee c JOIN settlement s ON c._txnID = s._txnID AND s.status = 'active'""")
    q["settlement_lookup"] = W(("payee", "settlement"), """
        SELECT p._txnID, p.status AS payee_status, s.source_bank AS loaded_source_bank,
               s.target_bank AS loaded_target_bank, s.amount AS loaded_amount, s.status AS loaded_status
        FROM payee p LEFT JOIN settlement s ON s._key = CAST(p._txnID AS VARCHAR)""")
    q["dedup_durable"] = W(("pw_distinct",), """
        SELECT source_bank, target_bank, amount, currency, _txnID, timestamp FROM pw_distinct""")
    q["reserve_returning"] = W(("payments", "banks"), """
        SELECT _txnID, source_bank, target_bank, amount, currency, timestamp FROM payments p
        WHERE EXISTS (SELECT 1 FROM banks b WHERE b._key = p.source_bank)""")
    q["presence_flag"] = W(("payments", "banks", "presence"), """
        SELECT p._txnID, b.region AS target_region, (pr.region IS NOT NULL) AS isDevicePresent
        FROM payments p LEFT JOIN banks b ON b._key = p.target_bank
        LEFT JOIN (SELECT DISTINCT region FROM presence WHERE stream = 'Transfers' AND subscriber LIKE '%-sub1') pr
          ON pr.region = b.region""")
    q["cache_fallback"] = W(("v8_loaded",), """
        SELECT _txnID, cache_hit, loaded_source_bank, loaded_target_bank, loaded_source_region,
               loaded_target_region, loaded_amount, loaded_currency, loaded_timestamp, loaded_status
        FROM v8_loaded""")
    q["point_lookup"] = W(("payments", "banks"), """
        SELECT _key, balance, reserved, region FROM banks b
        WHERE EXISTS (SELECT 1 FROM payments p WHERE p.target_bank = b._key)""")

    q["running_count"] = W(("count_events",), """
        SELECT c, row_number() OVER (ORDER BY t, c) AS count, md5(CAST(c AS VARCHAR)) AS payload FROM count_events""")
    q["cal_total"] = W(("banks",), """
        SELECT count(*) AS total_banks, CAST(sum(balance) AS BIGINT) AS total_balance,
               CAST(sum(reserved) AS BIGINT) AS total_reserved FROM banks""")
    q["admit_payments"] = W(("pw_decided",), "SELECT _txnID, source_bank, amount, admitted FROM pw_decided")
    q["v8_payment_worker"] = W(("v8_checked", "v8_decided"), """
        SELECT _txnID, timestamp, source_bank, amount, 'SETTLE' AS route, CAST(NULL AS VARCHAR) AS message
        FROM v8_decided WHERE admitted
        UNION ALL
        SELECT _txnID, timestamp, source_bank, amount, 'RJCT', failedMsg FROM v8_checked WHERE failedMsg IS NOT NULL
        UNION ALL
        SELECT _txnID, timestamp, source_bank, amount, 'RJCT', 'No sufficient funds on source bank'
        FROM v8_decided WHERE NOT admitted""")
    q["failed_union"] = W(("pw_failed",), "SELECT * FROM pw_failed")
    q["payer_rejections"] = W(("pw_failed",), """
        SELECT _txnID, source_bank, target_bank, amount, currency, 'RJCT' AS status, timestamp, message
        FROM pw_failed""")

    q["str_concat"] = W(("settlement",), f"SELECT _txnID, {_cache_json()} AS json FROM settlement")
    q["region_by_name"] = W(("payments",), """
        SELECT _txnID, source_bank, CASE WHEN contains(source_bank, 'Bank_X') THEN 'EAST'
               ELSE 'WEST' END AS source_region FROM payments""")
    q["convert_types"] = W(("payments",), """
        SELECT _txnID, CAST(_txnID AS VARCHAR) AS txn_str, CAST(amount AS VARCHAR) AS amount_str,
               CAST(trunc(amount) AS BIGINT) AS amount_long FROM payments""")
    q["validate_payment"] = W(("payments", "banks"), f"""
        SELECT p._txnID, {_rules(True)} AS failedMsg FROM payments p LEFT JOIN banks b ON b._key = p.source_bank""")
    q["validate_payment_v1"] = W(("payments_v1", "banks"), f"""
        SELECT p._txnID, CASE
          WHEN coalesce(b.region, '') = '' AND coalesce(b.reserved, 0) = 0 AND coalesce(b.balance, 0) = 0 THEN NULL
          WHEN coalesce(p.source_bank, '') = '' THEN 'Source bank parameter is not set'
          WHEN b.region IS NULL OR b.region <> '{HOME}' THEN 'Source bank ' || p.source_bank || ' belongs to another region'
          WHEN coalesce(p.target_bank, '') = '' THEN 'Target bank parameter is not set'
          WHEN coalesce(b.region, '') = '' THEN 'Source bank with name ' || p.source_bank || ' parameter is not set'
          WHEN p.amount IS NULL OR p.amount = 0 OR isnan(p.amount) THEN 'Amount parameter is not set'
          WHEN p.amount <= 0 OR p.amount > 10000 THEN 'Amount of money should be more than 0 and less or equall to 10000'
          WHEN coalesce(p.currency, '') = '' OR p.currency <> 'USD' THEN 'Only USD currency is acceptable'
          WHEN coalesce(CAST(b.balance AS DOUBLE), 0.0) - coalesce(CAST(b.reserved AS DOUBLE), 0.0)
               < coalesce(p.amount, 0.0) THEN 'No sufficient funds on source bank'
          ELSE NULL END AS failedMsg
        FROM payments_v1 p LEFT JOIN banks b ON b.name = p.source_bank""")
    # One line per feed of the generator, as its payments look for a count n.
    q["gen_payments"] = W(("count_events",), """,
        n AS (SELECT c + 1 AS n, t FROM count_events WHERE c + 1 <= 833),
        rows AS (
          SELECT 'BankA-west_' || (n - 1) AS source_bank, 'BankB-central_' || (n - 1) AS target_bank, n AS id, t FROM n
          UNION ALL SELECT 'BankA-west_' || (833 + n - 1), 'BankB-east_' || (n - 1), 833 + n, t FROM n
          UNION ALL SELECT 'BankA-west_' || (1666 + n - 1), 'BankB-southeast_' || (n - 1), 1666 + n, t FROM n
          UNION ALL SELECT 'BankA-central_' || (n - 1), 'BankB-west_' || (n - 1), 2500 + n, t FROM n
          UNION ALL SELECT 'BankA-central_' || (833 + n - 1), 'BankB-east_' || (833 + n - 1), 2500 + 833 + n, t FROM n
          UNION ALL SELECT 'BankA-central_' || (1666 + n - 1), 'BankB-southeast_' || (833 + n - 1), 2500 + 1666 + n, t FROM n
          UNION ALL SELECT 'BankA-east_' || n, 'BankB-central_' || (833 + n), 5000 + n, t FROM n WHERE n < 833
          UNION ALL SELECT 'BankA-east_' || (833 + n - 1), 'BankB-west_' || (833 + n - 1), 5000 + 833 + n, t FROM n
          UNION ALL SELECT 'BankA-east_' || (1666 + n - 1), 'BankB-southeast_' || (1666 + n - 1), 5000 + 1666 + n, t FROM n
          UNION ALL SELECT 'BankA-southeast_' || (n - 1), 'BankB-central_' || (1666 + n - 1), 7500 + n, t FROM n
          UNION ALL SELECT 'BankA-southeast_' || (833 + n - 1), 'BankB-west_' || (1666 + n - 1), 7500 + 833 + n, t FROM n
          UNION ALL SELECT 'BankA-southeast_' || (1666 + n - 1), 'BankB-east_' || (1666 + n - 1), 7500 + 1666 + n, t FROM n)
        SELECT source_bank, target_bank, CAST(100.0 AS DOUBLE) AS amount, 'USD' AS currency,
               CAST(id AS BIGINT) AS _txnID, t AS timestamp
        FROM rows""").replace("\n,\n", ",\n", 1)
    q["sla_latency"] = W(("pw_failed",), """
        SELECT _txnID, 'RJCT' AS status, timestamp, _txnID % 9000 AS latencyMs FROM pw_failed""")
    q["event_time"] = W(("count_events",), "SELECT c, t AS event_time FROM count_events")
    q["json_extract"] = W(("settlement",), """
        SELECT _txnID, CASE WHEN j THEN source_bank END AS sb, CASE WHEN j THEN target_bank END AS tb,
               CASE WHEN j THEN source_region END AS sr, CASE WHEN j THEN target_region END AS tr,
               CASE WHEN j THEN amount END AS a, CASE WHEN j THEN currency END AS c,
               CASE WHEN j THEN 'active' END AS s
        FROM (SELECT *, source_bank IS NOT NULL AND target_bank IS NOT NULL AND source_region IS NOT NULL
                     AND target_region IS NOT NULL AND amount IS NOT NULL AND currency IS NOT NULL AS j
              FROM settlement)""")
    q["json_object"] = W(("error_json",), """
        SELECT event_id, CAST(len(json_keys(evt)) AS INTEGER) AS n_keys,
               json_extract_string(evt, '$.c') AS c_value, json_extract_string(evt, '$.type') AS type_value
        FROM error_json""")
    q["error_events"] = W(("error_json",), """
        SELECT CAST(json_extract_string(evt, '$.c') AS BIGINT) AS c, CAST(json_extract_string(evt, '$.t') AS BIGINT) AS t,
               json_extract_string(evt, '$.type') AS type,
               CAST(len(list_filter(json_keys(evt), lambda k: k <> 'error')) AS INTEGER) AS n_event_keys,
               json_extract_string(json_extract_string(evt, '$.error'), '$.message') AS error_message,
               CAST(json_extract_string(json_extract_string(evt, '$.error'), '$.code') AS INTEGER) AS error_code
        FROM error_json""")
    q["dead_letter"] = W(("count_events",), """
        SELECT c, t, CASE WHEN c % 2 <> 0 THEN 'Count is Odd.' END AS status,
               CASE WHEN c % 2 = 0 THEN 'Count is Even.' END AS error FROM count_events""")

    q["reserve_funds"] = W(("pw_banks",), _acct("pw_banks"))
    q["atomic_batch"] = W(("pw_banks",), _acct("pw_banks"))
    q["settle_accounts"] = W(("banks", "cw_valid"), _DELTA_APPLY.format(
        base="banks", deltas=_SETTLE.format(src="(SELECT * FROM cw_valid WHERE status = 'settled')")))
    q["release_funds"] = W(("banks", "cw_valid"), _DELTA_APPLY.format(
        base="banks", deltas=_RELEASE.format(src="(SELECT * FROM cw_valid WHERE status <> 'settled')")))
    q["settlement_status"] = W(("settlement", "confirmations"), """
        SELECT s._key, coalesce(c.status, s.status) AS status
        FROM settlement s LEFT JOIN confirmations c ON c._txnID = s._txnID""")
    simple = """(SELECT *, CASE WHEN contains(source_bank, 'Bank_X') THEN 'EAST'
                           ELSE 'WEST' END AS src_region,
                      CASE WHEN contains(target_bank, 'Bank_X') THEN 'EAST'
                           ELSE 'WEST' END AS tgt_region FROM payments)"""
    posted = f"(SELECT * FROM {simple} s WHERE tgt_region = 'WEST' " \
             f"AND src_region = 'WEST')"
    q["simplified_flow"] = W(("banks", "payments"), _DELTA_APPLY.format(
        base="banks", deltas="SELECT source_bank AS _key, 0.0 AS d_balance, amount AS d_reserved FROM payments"
                             "\n    UNION ALL " + _SETTLE.format(src=posted).strip()))
    q["simplified_ledger"] = W(("payments",), f"""
        SELECT CAST(_txnID AS VARCHAR) AS _key, source_bank, target_bank, amount, currency, timestamp,
               'settled' AS status FROM {posted} x""")
    q["reset_balances"] = W(("banks",), """
        SELECT _key, CAST(10000 AS DOUBLE) AS balance, CAST(0 AS DOUBLE) AS reserved FROM banks""")
    q["simplified_event_time"] = W(("payments", "payee"), """
        SELECT leg, _txnID, timestamp + _txnID % 5000 AS timestamp FROM payments, (VALUES ('settlement'), ('request')) l(leg)
        UNION ALL SELECT 'confirmation', _txnID, timestamp + _txnID % 7000 FROM payee""")
    q["truncate_table"] = W(("settlement",), "SELECT * FROM settlement")
    q["admit_payments_rounds"] = q["admit_payments"]
    q["dedup_ttl"] = _TTL_DEDUP.replace("WITH RECURSIVE r AS (",
                                        "WITH RECURSIVE retries AS (" + _FIX["retries"][1] + "),\nr AS (", 1)
    q["dedup_ttl_rounds"] = q["dedup_ttl"]
    q["dedup_ttl_keyed_state"] = q["dedup_ttl"]
    q["running_count_stream"] = W(("count_events",), """
        SELECT c, row_number() OVER (ORDER BY t, c) AS count FROM count_events""")
    q["totals_stream"] = q["cal_total"]
    q["admission_passes"] = W(("pw_cand",), """
        SELECT CASE WHEN fits THEN 'plain' ELSE 'folded' END AS decided, sum(n)::BIGINT AS payments, count(*) AS accounts
        FROM (SELECT source_bank, count(*) AS n, coalesce(sum(CASE WHEN amt >= 0 THEN amt END), 0) <= any_value(free0) AS fits
              FROM pw_cand GROUP BY source_bank) GROUP BY 1""")
    q["guarded_function"] = """
        SELECT c, CASE WHEN c % 2 = 1 AND k % 5 <> 0 THEN 1000 // (k % 5) END AS share,
               CASE WHEN c % 2 = 0 THEN 'ValueError: Count is Even.' WHEN k % 5 = 0 THEN 'ArithmeticError: no share of ' || k END AS error
        FROM (SELECT event_id AS c, json_extract(props, '$.k')::BIGINT AS k FROM events)"""
    q["malformed_payloads"] = """
        WITH l AS (
          SELECT o_orderkey AS k, '{"_txnID":' || o_orderkey || ',"source_bank":'
                 || CASE WHEN o_orderkey % 13 = 0 THEN 'null' ELSE '"Bank_' || o_custkey || '"' END
                 || ',"cents":' || CASE WHEN o_orderkey % 29 = 0 THEN '"many"' ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END || '}' AS line
          FROM orders),
        v AS (SELECT CASE WHEN k % 19 = 0 THEN line[:-6] WHEN k % 23 = 0 THEN 'lost ' || k ELSE line END AS value FROM l),
        j AS (SELECT value, CASE WHEN json_valid(value) THEN json_type(value, '$.cents') IN ('UBIGINT', 'BIGINT') ELSE false END AS ok FROM v)
        SELECT CASE WHEN ok THEN json_extract(value, '$._txnID')::BIGINT END AS _txnID,
               CASE WHEN ok THEN json_extract_string(value, '$.source_bank') END AS source_bank,
               CASE WHEN ok THEN json_extract(value, '$.cents')::BIGINT END AS cents,
               CASE WHEN NOT ok THEN value END AS event, CASE WHEN NOT ok THEN 'malformed payload' END AS error
        FROM j"""
    q["json_variant"] = """
        WITH x AS (
          SELECT event_id, '{"c":' || event_id || ',"tags":["' || coalesce(event_type, '') || '","t' || event_id % 5 || '"]'
                 || CASE WHEN event_id % 2 = 0 THEN ',"error":{"code":' || event_id % 7 || ',"message":"Count is Even."}' ELSE '' END || '}' AS evt
          FROM events),
        y AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN evt[:-2] WHEN event_id % 17 = 0 THEN replace(evt, '"', chr(39)) ELSE evt END AS evt FROM x),
        z AS (SELECT event_id, json_valid(evt) AS is_json, CASE WHEN json_valid(evt) THEN evt::JSON END AS o FROM y)
        SELECT event_id, is_json, json_extract_string(o, '$.error.message') AS message, json_extract(o, '$.error.code')::BIGINT AS code,
               json_extract_string(o, '$.tags[1]') AS second_tag, json_extract(o, '$.error')::VARCHAR AS error
        FROM z"""
    q["counted_split"] = W(("payee",), """
        SELECT route, count(*) AS written, count(*) AS counted, (SELECT count(*) FROM payee) AS input
        FROM (SELECT CASE WHEN status = 'ACCP' AND amount > 0 THEN 'accepted' WHEN NOT (status = 'ACCP' AND amount > 0) THEN 'rejected'
                          ELSE 'unrouted' END AS route FROM payee) GROUP BY route""")
    sessions = """
        WITH g AS (
          SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOURS THEN 0 ELSE 1 END AS new
          FROM events WHERE user_id IS NOT NULL),
        s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g),
        t AS (SELECT user_id, min(ts) AS since, max(ts) + INTERVAL 12 HOURS AS until, count(*) AS n_events FROM s GROUP BY user_id, k)"""
    q["presence_sessions"] = sessions + """
        SELECT user_id, epoch_us(since) // 1000 AS since, epoch_us(until) // 1000 AS until, n_events FROM t"""
    q["presence_latest"] = sessions + """
        SELECT user_id, epoch_us(max(since)) // 1000 AS since, epoch_us(max(until)) // 1000 AS until, count(*) AS n_sessions,
               sum(n_events)::BIGINT AS n_events, max(until) >= (SELECT max(ts) FROM events WHERE user_id IS NOT NULL) AS present
        FROM t GROUP BY user_id"""
    q["pattern_join"] = W(("banks",), """
        SELECT b._key, s.subscriber, s.pattern FROM banks b JOIN (
          SELECT 'sub' || s_suppkey AS subscriber, CASE s_suppkey % 4
            WHEN 0 THEN 'Customer#0000' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') || '%'
            WHEN 1 THEN '%' || lpad((s_suppkey % 1000)::VARCHAR, 3, '0')
            WHEN 2 THEN '%#000' || lpad((s_suppkey % 1000)::VARCHAR, 3, '0') || '__%'
            ELSE '_%0' || lpad((s_suppkey % 1000)::VARCHAR, 3, '0') || '_' END AS pattern
          FROM supplier) s ON b.name LIKE s.pattern""")
    q["trigger_payments"] = W(("count_events",), """
        SELECT 'Chase_' || CAST((c + 1) % 12000 AS VARCHAR) AS source_bank,
               'Chase_' || CAST((c + 1) % 12000 + 12000 AS VARCHAR) AS target_bank,
               CASE WHEN CAST(CAST('0x' || substr(md5('trigger:' || CAST(c + 1 AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE)
                         / 4503599627370496.0 > 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(-1.0 AS DOUBLE) END AS amount,
               'USD' AS currency, CAST(t * 10000 + (c + 1) % 10000 AS VARCHAR) AS txnID
        FROM count_events""")
    q["assign_txn"] = W(("count_events",), """
        SELECT c, CAST(t * 10000 + (c + 1) % 10000 AS VARCHAR) AS txnID FROM count_events""")
    q["settlement_id"] = W(("settlement",), """
        SELECT _txnID, CAST(CAST(_txnID AS HUGEINT) % 999999999999989 * 48271 % 999999999999989 + 1 AS BIGINT) AS settlement_id
        FROM settlement WHERE target_region IS NOT NULL""")
    q["payee_status"] = W(("payee",), """
        SELECT _txnID, CASE WHEN status = 'ACCP' THEN 'settled' ELSE 'failed' END AS status FROM payee""")
    q["confirm_flow"] = W(("cw_valid",), """
        SELECT source_bank, target_bank, amount, currency, timestamp,
               CASE WHEN status = 'settled' THEN 'ACCP' ELSE 'RJCT' END AS status, _txnID
        FROM cw_valid WHERE status IS NOT NULL""")
    q["clearing_flow"] = W(("pw_banks", "pw_passed", "banks"), _DELTA_APPLY.format(
        base="pw_banks", deltas=_SETTLE.format(
            src=f"""(SELECT p.* FROM pw_passed p JOIN banks b ON b._key = p.source_bank
                    WHERE p.target_region IS NOT NULL AND b.region = '{HOME}')""")))
    q["validate_summary"] = W(("payments", "banks"), f"""
        SELECT coalesce(m, 'PASS') AS verdict, count(*) AS n FROM (
          SELECT {_rules(True)} AS m FROM payments p LEFT JOIN banks b ON b._key = p.source_bank) GROUP BY 1""")
    return q
