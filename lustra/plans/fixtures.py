"""Dirty tables derived from the given ones, as one SQL text for Spark and the oracle.

``{name}`` stands for a source table, ``{ts}`` for the zoneless timestamp type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-07-01 00:00:00"

CRM_CUSTOMERS = """
SELECT c_custkey AS customer_id,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CONCAT('  ', LOWER(c_name), ' ') END AS full_name,
 CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'not-an-email'
   WHEN 2 THEN CONCAT('a b', CAST(c_custkey AS VARCHAR(20)), '@x.com')
   ELSE CONCAT('user', CAST(c_custkey AS VARCHAR(20)), '@mail', CAST(c_custkey % 3 AS VARCHAR(20)), '.example.com')
   END AS email,
 CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN CONCAT('+65 ', CAST(81000000 + c_custkey AS VARCHAR(20)))
   WHEN 2 THEN CONCAT('65-', CAST(81000000 + c_custkey AS VARCHAR(20)))
   WHEN 3 THEN CONCAT('0', CAST(81000000 + c_custkey AS VARCHAR(20)))
   WHEN 4 THEN CAST(81000000 + c_custkey AS VARCHAR(20))
   WHEN 5 THEN '+1 (743) 555-3824' ELSE '123' END AS phone,
 CASE c_custkey % 5 WHEN 0 THEN NULL
   WHEN 1 THEN CONCAT(' s', LPAD(CAST(c_custkey AS VARCHAR(20)), 7, '0'), 'd ')
   WHEN 2 THEN CONCAT('G', LPAD(CAST(c_custkey AS VARCHAR(20)), 7, '0'), 'K')
   WHEN 3 THEN CONCAT('A', LPAD(CAST(c_custkey AS VARCHAR(20)), 7, '0'), 'Z') ELSE 'T12345' END AS nric,
 CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'm' WHEN 2 THEN ' F' WHEN 3 THEN 'x ' WHEN 4 THEN 'unknown'
   ELSE 'M' END AS gender,
 CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'usa' WHEN 2 THEN 'UK' WHEN 3 THEN 'Singapore' WHEN 4 THEN 'China'
   WHEN 5 THEN ' taiwan ' WHEN 6 THEN 'France' WHEN 7 THEN 'dk' ELSE 'Brazil' END AS country,
 CASE c_custkey % 4 WHEN 0 THEN NULL
   WHEN 1 THEN CONCAT('Blk ', CAST(c_custkey AS VARCHAR(20)), ' Test Rd S(',
                      LPAD(CAST(c_custkey * 37 % 1000000 AS VARCHAR(20)), 6, '0'), ')')
   WHEN 2 THEN CONCAT('1 Long Road 1234567 Singapore ', LPAD(CAST(c_custkey AS VARCHAR(20)), 6, '0'))
   ELSE '5 No Postal Lane' END AS address,
 CONCAT(CAST(100 + c_custkey % 900 AS VARCHAR(20)), '-', LPAD(CAST(c_custkey % 100 AS VARCHAR(20)), 2, '0'), '-',
        LPAD(CAST(c_custkey % 10000 AS VARCHAR(20)), 4, '0')) AS ssn,
 DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT) AS dob,
 CAST('2020-01-01 00:00:00' AS {ts}) AS signup_ts,
 CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST('2024-06-01 12:00:00' AS {ts}) END AS last_login_ts,
 CASE WHEN c_custkey % 8 = 0 THEN 'inactive' ELSE 'active' END AS status,
 c_mktsegment AS segment,
 CAST(300 + c_custkey % 551 AS INT) AS credit_score,
 c_acctbal AS annual_income
FROM {customer}
"""

CRM_MONEY = """
SELECT c_custkey AS id,
 CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN ' usd ' WHEN 2 THEN 'rmb' WHEN 3 THEN 'CNY' WHEN 4 THEN 'Yen'
   WHEN 5 THEN 'jpy' WHEN 6 THEN 'sgd' ELSE 'eur' END AS currency,
 CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN CONCAT(' ', CAST(c_custkey AS VARCHAR(20)), ' ')
   WHEN 3 THEN '12 34 56' WHEN 4 THEN '1234567' ELSE 'ABC123' END AS postal_code
FROM {customer}
"""

# Grants for eight well-known users, and one or two for every customer, so that
# the grant table grows with the data.
PII_GRANTS = """
SELECT user_email, user_group, access_level, granted_by, granted_at, expires_at, is_active, reason, approval_ticket_id
FROM (
 SELECT user_email, 'staff' AS user_group, access_level, 'system' AS granted_by,
  CAST('2023-01-01 00:00:00' AS {ts}) AS granted_at, expires_at, is_active,
  'Default group access' AS reason, CAST(NULL AS VARCHAR(20)) AS approval_ticket_id
 FROM (VALUES
  ('analyst@company.com',    'masked_only',    TRUE,  CAST(NULL AS {ts})),
  ('scientist@company.com',  'partial_access', TRUE,  CAST(NULL AS {ts})),
  ('governance@company.com', 'full_access',    TRUE,  CAST(NULL AS {ts})),
  ('both@company.com',       'partial_access', TRUE,  CAST(NULL AS {ts})),
  ('both@company.com',       'full_access',    TRUE,  CAST('2025-01-01 00:00:00' AS {ts})),
  ('expired@company.com',    'full_access',    TRUE,  CAST('2024-01-01 00:00:00' AS {ts})),
  ('edge@company.com',       'full_access',    TRUE,  CAST('2024-07-01 00:00:00' AS {ts})),
  ('revoked@company.com',    'full_access',    FALSE, CAST(NULL AS {ts}))
 ) AS t(user_email, access_level, is_active, expires_at)
 UNION ALL
 SELECT CONCAT('user', CAST(c_custkey AS VARCHAR(20)), '@company.com'), 'customer',
  CASE c_custkey % 4 WHEN 0 THEN 'masked_only' WHEN 1 THEN 'partial_access' WHEN 2 THEN 'full_access' ELSE 'other' END,
  'approver', CASE WHEN c_custkey % 11 = 0 THEN CAST('2024-08-01 00:00:00' AS {ts})
   ELSE CAST('2024-02-01 00:00:00' AS {ts}) END,
  CASE c_custkey % 5 WHEN 0 THEN CAST('2024-06-30 23:59:59' AS {ts}) WHEN 1 THEN CAST('2024-07-01 00:00:00' AS {ts})
   WHEN 2 THEN CAST('2024-07-01 00:00:01' AS {ts}) ELSE NULL END,
  c_custkey % 7 <> 0, 'project', CONCAT('T-', CAST(c_custkey AS VARCHAR(20)))
 FROM {customer}
 UNION ALL
 SELECT CONCAT('user', CAST(c_custkey AS VARCHAR(20)), '@company.com'), 'customer', 'partial_access',
  'approver', CAST('2024-03-01 00:00:00' AS {ts}), CAST(NULL AS {ts}), c_custkey % 2 = 0, 'project', NULL
 FROM {customer} WHERE c_acctbal > 0
) AS g
"""

# Grants that overlap, one per order, a third of them to one shared account.
ORDER_GRANTS = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'shared@company.com'
  ELSE CONCAT('user', CAST(o_custkey AS VARCHAR(20)), '@company.com') END AS user_email,
 CASE o_orderkey % 4 WHEN 0 THEN 'masked_only' WHEN 1 THEN 'partial_access' WHEN 2 THEN 'full_access' ELSE 'other' END
  AS access_level,
 CAST(o_orderdate AS {ts}) + INTERVAL '1' HOUR * (o_orderkey % 24) AS granted_at,
 CASE WHEN o_orderkey % 101 > 0
  THEN CAST(o_orderdate AS {ts}) + INTERVAL '1' HOUR * (o_orderkey % 40 - 2) END AS expires_at,
 o_orderkey % 11 <> 0 AS is_active
FROM {orders}
"""

USER_CHANGES = """
SELECT user_id, ts, event_id, event_type = 'signup' AS is_deleted,
 CASE WHEN event_type = 'error' THEN NULL WHEN value < 30 THEN 'lo' ELSE 'hi' END AS band,
 CASE WHEN event_type = 'click' THEN NULL ELSE value END AS last_value
FROM {events}
"""

# The same changes with a third of all rows under one key.
SKEWED_CHANGES = """
SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts, event_id,
 event_type = 'signup' AND event_id % 9 = 0 AS is_deleted,
 CASE WHEN event_type = 'error' THEN NULL WHEN value < 30 THEN 'lo' ELSE 'hi' END AS band,
 CASE WHEN event_type = 'click' THEN NULL ELSE value END AS last_value
FROM {events}
"""

ORDER_CHANGES = """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus AS status, o_totalprice AS amount,
 o_orderpriority AS priority
FROM {orders}
"""

# Dirty change rows of customers: one per order, several per customer, with ties.
CRM_CHANGES = """
SELECT o_custkey AS customer_id, o_orderdate AS changed_at, o_orderkey AS change_id,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CONCAT(' customer ', CAST(o_custkey AS VARCHAR(20)), ' ') END AS full_name,
 CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'not-an-email'
   ELSE CONCAT('user', CAST(o_custkey AS VARCHAR(20)), '@mail.example.com') END AS email,
 CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN CONCAT('65-', CAST(81000000 + o_custkey AS VARCHAR(20)))
   ELSE CONCAT('0', CAST(81000000 + o_custkey AS VARCHAR(20))) END AS phone,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL
   ELSE CONCAT(' s', LPAD(CAST(o_custkey AS VARCHAR(20)), 7, '0'), 'd') END AS nric,
 CASE o_orderkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN ' M' ELSE 'unknown' END AS gender,
 CASE o_custkey % 3 WHEN 0 THEN 'usa' WHEN 1 THEN 'UK' ELSE NULL END AS country,
 CASE o_orderkey % 4 WHEN 0 THEN NULL
   ELSE CONCAT('Blk 1 Singapore ', LPAD(CAST(o_custkey AS VARCHAR(20)), 6, '0')) END AS address,
 o_orderpriority AS segment, o_orderstatus AS status, o_totalprice AS annual_income
FROM {orders}
"""

# Price changes of products: one per order line.
PRICE_CHANGES = """
SELECT l_partkey AS product_id, l_shipdate AS updated_at, l_orderkey, l_linenumber,
 CASE WHEN l_quantity < 5 THEN NULL ELSE ROUND(l_extendedprice / l_quantity, 0) END AS price,
 CASE WHEN l_discount > 0.05 THEN 'low' ELSE 'high' END AS cost,
 l_returnflag AS availability, l_linestatus AS status, l_tax AS tax
FROM {lineitem}
"""

# Four tables of one cleansing job: (source table, key, dirty columns).
MANY_TABLES = {
    "customer": "SELECT c_custkey AS id, CONCAT(' ', LOWER(c_name)) AS name, c_mktsegment AS code,"
    " CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'sg' END AS country FROM {customer}",
    "supplier": "SELECT s_suppkey AS id, CONCAT(LOWER(s_name), ' ') AS name, 'usd' AS currency,"
    " CASE WHEN s_suppkey % 2 = 0 THEN 'China' ELSE 'Brazil' END AS country FROM {supplier}",
    "orders": "SELECT o_orderkey AS id, LOWER(o_orderpriority) AS name,"
    " CASE WHEN o_orderkey % 4 = 0 THEN 'rmb' ELSE 'eur' END AS currency FROM {orders}",
    "part": "SELECT p_partkey AS id, p_name AS name,"
    " CASE WHEN p_size > 25 THEN 'Yen' ELSE NULL END AS currency, 'france' AS country FROM {part}",
}

FIXTURES = {
    "crm_customers": CRM_CUSTOMERS,
    "crm_money": CRM_MONEY,
    "pii_grants": PII_GRANTS,
    "order_grants": ORDER_GRANTS,
    "user_changes": USER_CHANGES,
    "skewed_changes": SKEWED_CHANGES,
    "order_changes": ORDER_CHANGES,
    "crm_changes": CRM_CHANGES,
    "price_changes": PRICE_CHANGES,
    **{f"dirty_{name}": text for name, text in MANY_TABLES.items()},
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a Spark frame."""
    text = FIXTURES[name].replace("{ts}", "TIMESTAMP_NTZ")
    sources = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **sources)


def fixture_sql(name: str) -> str:
    """A derived table as oracle SQL over the registered views."""
    return FIXTURES[name].format(ts="TIMESTAMP", **{t: t for t in TABLES}).strip()
