"""The derived ledger written as DuckDB SQL, used by the SQL oracle.

Mirrors ``ledgerscope.sources.ledger`` expression by expression. Each oracle
query is ``WITH <ledger>, <own CTEs> SELECT ...`` over the raw views.
"""

LEDGER_CTES = r"""
_geo AS (
    SELECT c.c_custkey, n.n_name
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
_tx AS (
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag,
           o.o_orderkey, o.o_custkey, o.o_orderdate,
           CAST(round(l.l_extendedprice * 100) AS BIGINT) AS price_cents,
           CAST((o.o_custkey // 50) * 50 + (l.l_partkey + l.l_suppkey) % 50 AS BIGINT) AS r_key
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
_tx2 AS (
    SELECT _tx.*, price_cents // 5 AS amount_cents,
           (['WIRE_TRANSFER','ACH','CASH_DEPOSIT','CASH_WITHDRAWAL','TRADE_PAYMENT',
             'INTERNAL_TRANSFER','CRYPTO_EXCHANGE','CHECK'])[CAST(l_partkey % 8 AS INTEGER) + 1] AS transaction_type,
           (l_returnflag = 'R' AND o_custkey % 25 = 0) AS is_susp,
           s.n_name AS country_origin, r.n_name AS country_dest
    FROM _tx
    LEFT JOIN _geo s ON _tx.o_custkey = s.c_custkey
    LEFT JOIN _geo r ON _tx.r_key = r.c_custkey
),
transactions AS (
    SELECT
        'TXN_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || price_cents
            AS transaction_id,
        o_orderdate + to_seconds((o_orderkey % 24) * 3600 + (l_linenumber * 521 + l_partkey) % 3600) AS "timestamp",
        'CUST_' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS sender_id,
        'CUST_' || lpad(CAST(r_key AS VARCHAR), CAST(greatest(6, length(CAST(r_key AS VARCHAR))) AS INTEGER), '0') AS receiver_id,
        amount_cents,
        amount_cents / 100.0::DOUBLE AS amount_usd,
        transaction_type,
        country_origin,
        country_dest,
        is_susp AS is_suspicious,
        CASE WHEN NOT is_susp THEN 'normal'
             WHEN (o_custkey // 25) % 3 = 0 THEN 'structuring'
             WHEN (o_custkey // 25) % 3 = 1 THEN 'layering'
             ELSE 'tbml' END AS label,
        (amount_cents BETWEEN 500000 AND 999999
            AND transaction_type IN ('CASH_DEPOSIT', 'WIRE_TRANSFER', 'ACH')) AS structuring_flag,
        (amount_cents % 10000 = 0) AS round_amount,
        (is_susp AND (o_custkey // 25) % 3 = 1 AND l_linenumber <= 2) AS rapid_movement
    FROM _tx2
),
customers AS (
    SELECT
        'CUST_' || lpad(CAST(c.c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER), '0') AS customer_id,
        c.c_name AS name,
        n.n_name AS country,
        CASE WHEN n.n_regionkey IN (0, 1, 2) THEN 'low'
             WHEN n.n_regionkey = 3 THEN 'medium'
             WHEN n.n_regionkey = 4 THEN 'high' END AS jurisdiction_risk,
        CASE WHEN c.c_custkey % 20 <= 13 THEN 'retail'
             WHEN c.c_custkey % 20 <= 18 THEN 'corporate'
             ELSE 'correspondent' END AS account_type,
        CAST(DATE '1990-01-01' + CAST(c.c_custkey % 1500 AS INTEGER) AS DATE) AS onboard_date,
        ((c.c_custkey * 7919) % 10000) / 10000.0::DOUBLE AS risk_score,
        (c.c_custkey % 25 = 0) AS is_suspicious,
        (CAST(round(c.c_acctbal * 100) AS BIGINT) + 100000) * 10 / 100.0::DOUBLE AS annual_income_usd,
        (c.c_custkey % 50 = 0) AS pep
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)
"""


def with_ledger(body: str, ctes: str = "", recursive: bool = False) -> str:
    """Prefix an oracle query with the ledger CTEs (and its own CTEs)."""
    head = ("WITH RECURSIVE " if recursive else "WITH ") + LEDGER_CTES.strip()
    if ctes.strip():
        head += ",\n" + ctes.strip()
    return head + "\n" + body.strip()


#: ``sources/planted.py`` in SQL: the ledger with planted transfers.
PLANTED_CTES = r"""
_po AS (
    SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS day, o_orderkey // 40 AS number, 2 + (o_orderkey // 40) % 4 AS n,
           unnest(generate_series(0, CAST(1 + (o_orderkey // 40) % 4 AS INTEGER))) AS i
    FROM orders WHERE o_orderkey % 40 = 0
),
_pc AS (
    SELECT *, CAST((2 * (10000000 + (k % 1000) * 12345) * CAST(pow(90 + (k * 17 + i * 23) % 10, i) AS BIGINT) + CAST(pow(100, i) AS BIGINT))
                   // (2 * CAST(pow(100, i) AS BIGINT)) AS BIGINT) AS cents,
           (k % 24) * 3600 + CASE WHEN i >= 1 THEN 3600 + (k * 31 + 7919) % 82801 ELSE 0 END
             + CASE WHEN i >= 2 THEN 3600 + (k * 31 + 2 * 7919) % 82801 ELSE 0 END
             + CASE WHEN i >= 3 THEN 3600 + (k * 31 + 3 * 7919) % 82801 ELSE 0 END
             + CASE WHEN i >= 4 THEN 3600 + (k * 31 + 4 * 7919) % 82801 ELSE 0 END AS seconds,
           (c // 50) * 50 + (c + i * 7) % 50 AS a, (c // 50) * 50 + (c + ((i + 1) % n) * 7) % 50 AS b
    FROM _po
),
_fan AS (
    SELECT c_custkey AS k, unnest(generate_series(1, CAST(3 + (c_custkey // 50) % 5 AS INTEGER))) AS j FROM customer WHERE c_custkey % 50 = 7
),
_planted AS (
    SELECT 'PLT_' || k || '_' || i AS transaction_id, day + to_seconds(seconds) AS "timestamp", a, b, NULL AS outsider,
           CASE WHEN number % 5 = 0 AND i = n - 1 THEN cents // 2 ELSE cents END AS amount_cents
    FROM _pc
    UNION ALL
    SELECT 'FAN_' || k || '_' || j, TIMESTAMP '1996-01-01' + to_seconds((k % 1000) * 86400 + j * 3600),
           (k // 50) * 50 + (7 + j) % 50, k, NULL, 100000 + j * 1000
    FROM _fan
    UNION ALL
    SELECT 'EXT_' || c_custkey, TIMESTAMP '1997-01-01' + to_seconds((c_custkey % 1000) * 86400), NULL, c_custkey, 'OUT_' || (c_custkey % 400), 250000 + c_custkey
    FROM customer WHERE c_custkey % 50 = 11
),
planted AS (
    SELECT transaction_id, "timestamp", sender_id, receiver_id, amount_cents, transaction_type FROM transactions
    UNION ALL
    SELECT transaction_id, "timestamp",
           COALESCE(outsider, 'CUST_' || lpad(CAST(a AS VARCHAR), CAST(greatest(6, length(CAST(a AS VARCHAR))) AS INTEGER), '0')),
           'CUST_' || lpad(CAST(b AS VARCHAR), CAST(greatest(6, length(CAST(b AS VARCHAR))) AS INTEGER), '0'),
           CAST(amount_cents AS BIGINT), 'WIRE_TRANSFER'
    FROM _planted
)"""
