"""DuckDB side of the test-data mapping: SQL building blocks for oracles.

Every oracle query starts from the ``raw`` CTE below, which maps
``events JOIN customer`` exactly like :mod:`ledgerline.testdata.mapping`.
Money sums go through ``decimal(38,4)`` like the Spark side, so both engines
produce bit-identical doubles regardless of summation order.
"""

RAW_CTE = """raw AS (
  SELECT e.event_id,
         cast(floor(epoch(e.ts - timestamp '2024-01-01 00:00:00') / 3600) AS INTEGER) + 1 AS step,
         upper(e.event_type) AS type,
         e.value AS amount,
         concat('C', e.user_id) AS "nameOrig",
         c.c_acctbal AS "oldbalanceOrg",
         CASE WHEN e.event_id % 7 = 0 THEN c.c_acctbal ELSE c.c_acctbal - e.value END AS "newbalanceOrig",
         concat('M', e.event_id % 97) AS "nameDest",
         cast(e.event_id % 1000 AS DOUBLE) AS "oldbalanceDest",
         cast(e.event_id % 1000 AS DOUBLE) + e.value AS "newbalanceDest",
         CASE WHEN e.event_id % 11 = 0 OR (e.event_type = 'error' AND e.event_id % 2 = 0)
              THEN 1 ELSE 0 END AS "isFraud",
         CASE WHEN e.value > 150 THEN 1 ELSE 0 END AS "isFlaggedFraud"
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
)"""

IDS_CTE = """rawid AS (
  SELECT *, concat('TXN-', step, '-', event_id) AS transaction_id FROM raw
)"""

FEEDS_CTE = """tx AS (
  SELECT transaction_id, step, type, amount, "nameOrig" AS origin_account_id,
         "nameDest" AS dest_account_id, event_id FROM rawid
), acct AS (
  SELECT transaction_id, "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest",
         "newbalanceDest", step, event_id FROM rawid
), fraud AS (
  SELECT transaction_id, "isFraud", "isFlaggedFraud", step, event_id FROM rawid
)"""

FAULTY_CTE = """acct_f AS (
  SELECT * FROM acct WHERE event_id % 101 <> 0
), fraud_kept AS (
  SELECT * FROM fraud WHERE event_id % 103 <> 0 AND step IS DISTINCT FROM 5
), fraud_f AS (
  SELECT * FROM fraud_kept UNION ALL SELECT * FROM fraud_kept WHERE event_id % 499 = 0
)"""

SILVER_SELECT = """tx.transaction_id, tx.step, tx.type, tx.amount, tx.origin_account_id,
         tx.dest_account_id, a."oldbalanceOrg", a."newbalanceOrig", a."oldbalanceDest",
         a."newbalanceDest", f."isFraud", f."isFlaggedFraud\""""

SILVER_CTE = f"""joined AS (
  SELECT {SILVER_SELECT}
  FROM tx JOIN acct a ON tx.transaction_id = a.transaction_id AND tx.step = a.step
          JOIN fraud f ON tx.transaction_id = f.transaction_id AND tx.step = f.step
), silver AS (
  SELECT j.*,
         timestamp '2025-01-01 00:00:00' + to_hours(j.step)
           + to_microseconds((('0x' || substr(md5(j.transaction_id), 1, 12))::BIGINT % 3600000000)) AS transaction_time,
         abs(("oldbalanceOrg" - amount) - "newbalanceOrig") > 0.01 AS is_corrupt
  FROM joined j
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_ctes(RAW_CTE, IDS_CTE, FEEDS_CTE)
SILVER = with_ctes(RAW_CTE, IDS_CTE, FEEDS_CTE, SILVER_CTE)
FAULTY = with_ctes(RAW_CTE, IDS_CTE, FEEDS_CTE, FAULTY_CTE)


def money_sum(c: str) -> str:
    return f"cast(sum(cast({c} AS DECIMAL(38,4))) AS DOUBLE)"


def money_avg(c: str) -> str:
    return f"{money_sum(c)} / count({c})"
