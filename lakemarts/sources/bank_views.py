"""Bank-shaped tables computed from the given star-schema tables.

Each view is one SELECT over whole given tables, in SQL that reads the same in
Spark and in a second engine; ``{name}`` stands for an input table and
``{ntz}`` for the engine's timestamp type without a zone. The given tables are
clean, so the views add what the source is known to hold: padding, case
variants, blanks, nulls, repeated and orphaned keys. Dirt is a function of the
keys, so it is the same in every run, and no row is left out.

Customers come from ``customer``; accounts and loans from ``orders``;
transactions and repayments from ``lineitem``; alerts from ``events``; scores
and cards from ``customer``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# The spending sectors of the source, in its spelling.
SPENDING_SECTORS = (
    "Groceries & Supermarkets",
    "Restaurants & Fast Food",
    "Utilities & Bills",
    "Public Transport",
    "Aviation & Travel",
    "Streaming & Subscriptions",
    "E-Commerce & Retail",
    "Health & Pharmacy",
    "Fuel & Automotive",
    "Home Improvement",
    "Gaming & Entertainment",
    "Luxury Goods",
    "Charity & Donations",
)


def _pick(number: str, values: tuple[str, ...]) -> str:
    """CASE that picks one of ``values`` by ``number``."""
    arms = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(values))
    return f"CASE {number} % {len(values)} {arms} END"


def _cents(number: str, digits: int) -> str:
    """Whole cents as DECIMAL(digits, 2)."""
    return (
        f"CAST(CAST({number} AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2))"
        f" AS DECIMAL({digits},2))"
    )


def _dirty(value: str, number: str) -> str:
    """Upper case, lower case, padded or blank for some rows."""
    return (
        f"CASE WHEN {number} % 20 = 3 THEN upper({value})"
        f" WHEN {number} % 20 = 7 THEN lower({value})"
        f" WHEN {number} % 20 = 11 THEN '  ' || {value} || '   '"
        f" WHEN {number} % 41 = 0 THEN '   ' ELSE {value} END"
    )


CUSTOMERS = f"""SELECT
  CAST(c_custkey AS INT) AS customer_id,
  CAST(c_custkey AS STRING) AS customer_uuid,
  {_dirty("c_name", "c_custkey")} AS first_name,
  {_dirty("c_mktsegment", "(c_custkey + 5)")} AS last_name,
  CASE WHEN c_custkey % 25 = 0 THEN NULL ELSE c_name || '@example.test' END AS email,
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN ''
    ELSE '+44 ' || CAST(c_custkey AS STRING) END AS phone_number,
  CAST(DATE '1945-01-01' + CAST(c_custkey % 20000 AS INT) AS DATE) AS date_of_birth,
  CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE {_dirty("n_name", "(c_custkey + 9)")} END AS city,
  'PC' || CAST(c_nationkey AS STRING) AS postcode,
  r_name AS country,
  {_pick("c_custkey", ("Retired", "Student", "Contractor"))} AS employment_status,
  CAST(20000 + c_acctbal AS DECIMAL(12,2)) AS annual_income,
  c_mktsegment AS customer_segment,
  CAST('2024-01-01 00:00:00' AS {{ntz}}) AS created_at
FROM {{customer}} AS customer
LEFT JOIN {{nation}} AS nation ON c_nationkey = n_nationkey
LEFT JOIN {{region}} AS region ON n_regionkey = r_regionkey"""

# Every eleventh customer has no account: theirs belong to a closed customer.
ACCOUNTS = f"""SELECT
  CAST(o_orderkey AS INT) AS account_id,
  'acc-' || CAST(o_orderkey AS STRING) AS account_uuid,
  CASE WHEN o_custkey % 11 = 0 THEN 'closed-' || CAST(o_custkey AS STRING)
    ELSE CAST(o_custkey AS STRING) END AS customer_uuid,
  {_pick("o_orderkey", ("Current Account", "Instant Savings", "Fixed ISA", "Student Account"))}
    AS account_type,
  CASE WHEN o_orderkey % 4 IN (1, 2) OR o_orderkey % 57 = 0
    THEN {_cents("25 + o_orderkey % 626", 5)} ELSE {_cents("0", 5)} END AS interest_rate_apr,
  CASE WHEN o_orderkey % 4 <> 3 OR o_orderkey % 59 = 0
    THEN {_cents("300 + o_orderkey % 3 * 700", 6)} ELSE {_cents("0", 6)} END
    AS monthly_maintenance_fee,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL
    ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) - 150000 AS DECIMAL(15,2)) END AS current_balance,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 'GBP' END AS currency,
  CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE 'Active' END AS status,
  CAST(o_orderdate AS DATE) AS opened_date
FROM {{orders}} AS orders"""

TRANSACTIONS = f"""SELECT
  l_orderkey * 8 + l_linenumber AS transaction_id,
  CAST(l_orderkey AS INT) AS account_id,
  {_pick("l_linenumber", ("Direct Debit", "Standing Order", "Debit Card Purchase"))}
    AS transaction_type,
  CASE WHEN l_partkey % 47 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS amount,
  CAST(l_quantity * 100 AS DECIMAL(15,2)) AS running_balance,
  CASE WHEN l_suppkey % 33 = 0 THEN NULL ELSE {_dirty("merchant", "l_suppkey")} END
    AS merchant_name,
  {_dirty("sector", "(l_orderkey + 1)")} AS spending_sector,
  {_pick("l_linenumber", ("Web Portal", "Mobile Banking App", "Telephone Banking"))} AS channel,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'City' END AS transaction_city,
  CAST(l_shipdate AS {{ntz}}) AS transaction_timestamp,
  CASE WHEN l_linestatus = 'O' THEN 'Completed' ELSE 'Failed' END AS status
FROM (SELECT *, 'Merchant ' || CAST(l_suppkey AS STRING) AS merchant,
    {_pick("l_linenumber", SPENDING_SECTORS)} AS sector
  FROM {{lineitem}} AS lineitem) AS named"""

FRAUD_ALERTS = f"""SELECT
  CAST(event_id AS INT) AS alert_id,
  event_id AS transaction_id,
  CAST(user_id AS STRING) AS customer_uuid,
  {_dirty("event_type", "event_id")} AS alert_type,
  CAST(CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 101
    ELSE 55 + event_id % 45 END AS INT) AS risk_score,
  CASE WHEN event_id % 4 = 0 THEN 'Resolved' ELSE 'Under Review' END AS status,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '' ELSE props END
    AS resolution_notes,
  CAST(ts AS {{ntz}}) AS flagged_at
FROM {{events}} AS events"""

# Some customers lost their score to an unknown key; some have two.
_SCORE = "(299 + (c_custkey * 37) % 553)"
CREDIT_SCORES = f"""SELECT
  CAST(c_custkey AS INT) AS score_id,
  CASE WHEN c_custkey % 7 = 0 THEN 'lost-' || CAST(c_custkey AS STRING)
    WHEN c_custkey % 101 = 1 THEN CAST(c_custkey + 1 AS STRING)
    ELSE CAST(c_custkey AS STRING) END AS customer_uuid,
  CAST({_SCORE} AS INT) AS bureau_score,
  CASE WHEN {_SCORE} > 740 THEN 'Excellent' WHEN {_SCORE} > 670 THEN '  Good'
    WHEN {_SCORE} > 580 THEN 'Fair' ELSE 'Poor' END AS risk_rating,
  CAST(c_custkey % 4 AS INT) AS delinquency_history_count,
  CASE WHEN c_custkey % 67 = 0 THEN NULL ELSE {_cents("500 + (c_custkey * 13) % 5300", 5)} END
    AS debt_to_income_ratio,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INT) AS DATE) AS last_updated
FROM {{customer}} AS customer"""

CREDIT_CARDS = f"""SELECT
  CAST(c_custkey AS INT) AS card_id,
  '****-****-****-' || right('000' || CAST(c_custkey AS STRING), 4) AS card_number_masked,
  CASE WHEN c_custkey % 13 = 0 THEN 'gone-' || CAST(c_custkey AS STRING)
    ELSE CAST(c_custkey AS STRING) END AS customer_uuid,
  CAST({_pick("c_custkey", ("500", "3000", "15000"))} AS DECIMAL(12,2)) AS credit_limit,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(abs(c_acctbal) AS DECIMAL(12,2)) END
    AS current_balance,
  {_cents("1290 + (c_custkey * 17) % 2201", 5)} AS apr,
  CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE 'Active' END AS card_status
FROM {{customer}} AS customer"""

LOAN_APPLICATIONS = f"""SELECT
  CAST(o_orderkey AS INT) AS loan_id,
  CASE WHEN o_custkey % 17 = 0 THEN 'gone-' || CAST(o_custkey AS STRING)
    ELSE CAST(o_custkey AS STRING) END AS customer_uuid,
  {_dirty("o_orderpriority", "(o_orderkey + 2)")} AS loan_type,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(15,2)) END
    AS principal_amount,
  {_cents("320 + o_orderkey % 1130", 5)} AS interest_rate,
  CAST({_pick("o_orderkey", ("12", "60", "300"))} AS INT) AS term_months,
  CAST(o_orderdate AS DATE) AS start_date,
  CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Defaulted' END
    AS loan_status
FROM {{orders}} AS orders"""

LOAN_REPAYMENTS = """SELECT
  l_orderkey * 8 + l_linenumber AS repayment_id,
  CAST(l_orderkey AS INT) AS loan_id,
  CAST(l_shipdate AS {ntz}) AS payment_date,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS amount_paid,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_quantity AS DECIMAL(12,2))
    AS DECIMAL(12,2)) AS principal_component,
  CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(12,2)) END
    AS interest_component,
  CAST(CASE WHEN l_linenumber = 7 THEN 25 ELSE 0 END AS DECIMAL(8,2)) AS late_fee_applied
FROM {lineitem} AS lineitem"""

# The given tables as they are stored. Declared, so that opening
# a table starts no job to look at file footers.
GIVEN_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,"
    " o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
}

BANK_VIEWS = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "fraud_alerts": FRAUD_ALERTS,
    "credit_scores": CREDIT_SCORES,
    "credit_cards": CREDIT_CARDS,
    "loan_applications": LOAN_APPLICATIONS,
    "loan_repayments": LOAN_REPAYMENTS,
}


def inputs_of(view: str) -> list[str]:
    """Given tables that a view reads."""
    return [name for name in re.findall(r"{(\w+)}", BANK_VIEWS[view]) if name != "ntz"]


def given_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN_SCHEMAS[name]).parquet(f"{data_dir}/{name}.parquet")


def bank_table(spark: SparkSession, data_dir: str, view: str) -> DataFrame:
    """A bank-shaped Bronze table over the Parquet files in ``data_dir``."""
    tables = {name: given_table(spark, data_dir, name) for name in inputs_of(view)}
    return spark.sql(BANK_VIEWS[view].replace("{ntz}", "TIMESTAMP_NTZ"), **tables)


def bank_tables(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    return {view: bank_table(spark, data_dir, view) for view in BANK_VIEWS}
