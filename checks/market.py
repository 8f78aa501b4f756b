"""The given sales and event tables read as raw transaction sources.

Sales lines become raw text transactions with the kinds of dirt that cleaning and validation are
for: mixed date and amount spellings, blanks, unknown ids, invalid names. Which rows carry which
dirt follows from their own column values."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.numbering import number_by_position, number_in_groups, sent_if_small
from ledgerflow.settings import Settings
from ledgerflow.sources.staging import Staging

SETTINGS = Settings(
    start_date=date(1995, 6, 1),
    end_date=date(2001, 6, 30),
    high_value_transaction=100000,
    negative_balance_warning=-40000,
    detected_timestamp="2024-01-01T00:00:00+00:00",
)

# State codes of the first nations; the others keep a code of their own.
STATE_CODES = "array('NY','MA','PA','GA','FL','TX','IL','OH','MN','CO','AZ','CA','WA','INT')"
STATE = f"coalesce(try_element_at({STATE_CODES}, n_nationkey + 1), concat('n', n_nationkey))"

# Category spellings by brand number.
CATEGORY_TEXTS = (
    "array('groceries','Grocery',' dinning ','RESTAURANTS','transport','travel','entertainment','utility',"
    "'rent','mortgage','health-care','healthcare','shopping','retail','education','ATM','atm_withdrawal',"
    "'transfer','Transfers','subscriptions','subscription  services','fees','fees and charges','housing','dining')"
)
CATEGORY = f"element_at({CATEGORY_TEXTS}, cast(substring(p_brand, 7) as int))"

CUSTOMERS = f"""
SELECT 0 AS part, c_custkey AS number,
  concat(' cust', c_custkey) AS customer_id,
  lower(c_name) AS customer_display_name,
  CASE WHEN c_acctbal < 1000 THEN '18-24' WHEN c_acctbal < 4000 THEN '25-34'
       WHEN c_acctbal < 7000 THEN ' 35-44 ' ELSE '45+' END AS age_group,
  lower(n_name) AS city, lower({STATE}) AS state,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'students' WHEN 'BUILDING' THEN 'young  professionals'
       WHEN 'FURNITURE' THEN 'FAMILIES' WHEN 'HOUSEHOLD' THEN ' affluent' ELSE c_mktsegment END AS customer_segment,
  CASE WHEN c_nationkey = 24 THEN 'n/a' ELSE cast(cast(floor(c_acctbal / 50) AS int) AS string) END AS account_tenure_months,
  date_format(date_add(date'1994-01-01', cast(c_custkey % 365 AS int)), 'MM/dd/yyyy') AS join_date,
  CASE WHEN c_nationkey < 8 THEN 'mobile' WHEN c_nationkey < 16 THEN 'point-of-sale' ELSE 'online ' END AS preferred_channel,
  CASE WHEN c_acctbal < 2000 THEN 'high' ELSE 'low' END AS risk_tier,
  '$40k-$75k' AS income_band
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
UNION ALL
SELECT 1, s_suppkey, concat('CUST', s_suppkey), s_name, '45+', n_name, {STATE}, 'small business',
  '120', '1994-01-01', 'branch', 'medium', ''
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
"""

ACCOUNTS = """
SELECT o_custkey AS number, o_orderpriority AS priority,
  concat('acc', o_custkey, '-', substring(o_orderpriority, 1, 1)) AS account_id,
  CASE WHEN count(*) >= 6 THEN 'CUST-GONE' ELSE concat('cust', o_custkey) END AS customer_id,
  CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'checking' WHEN '2' THEN 'SAVINGS'
       WHEN '3' THEN 'credit_card' WHEN '4' THEN 'money-market' ELSE 'brokerage' END AS account_type,
  date_format(date_add(cast(min(o_orderdate) AS date), 7), 'MMM dd, yyyy') AS open_date,
  CASE count(*) WHEN 1 THEN 'closed' WHEN 2 THEN 'dormant' ELSE 'ACTIVE' END AS account_status,
  CASE count(*) WHEN 1 THEN cast(date_add(cast(max(o_orderdate) AS date), 90) AS string) ELSE '' END AS close_date,
  concat('$', format_number(sum(cast(o_totalprice AS decimal(18,2))), 2)) AS current_balance,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN '(5,000.00)' ELSE '' END AS credit_limit,
  concat('br', o_custkey % 30) AS branch_id,
  'usd' AS currency,
  'standard' AS product_tier
FROM {orders}
GROUP BY o_custkey, o_orderpriority
"""

TRANSACTIONS = f"""
SELECT source_row_number,
  CASE WHEN l_quantity = 50 AND l_discount = 0.0 AND l_tax = 0.0 THEN '  '
       ELSE concat('txn-', l_orderkey, '-', l_linenumber, '-', l_suppkey) END AS transaction_id,
  CASE WHEN l_quantity = 47 AND l_discount = 0.02 THEN 'acc-unknown'
       WHEN l_quantity = 46 AND l_discount = 0.02 THEN ''
       ELSE concat('acc', o_custkey, '-', substring(o_orderpriority, 1, 1)) END AS account_id,
  CASE WHEN l_quantity = 49 AND l_discount = 0.01 THEN ''
       WHEN l_quantity = 48 AND l_discount = 0.01 THEN 'cust-missing'
       ELSE concat(' cust', o_custkey) END AS customer_id,
  CASE WHEN l_quantity = 45 AND l_discount = 0.03 THEN 'mer-unknown' ELSE concat('mer', l_suppkey) END AS merchant_id,
  CASE WHEN l_quantity = 44 AND l_discount = 0.04 THEN 'not a date'
       WHEN l_linenumber = 1 THEN date_format(cast(l_shipdate AS date), 'MM/dd/yyyy')
       WHEN l_linenumber = 2 THEN date_format(cast(l_shipdate AS date), 'MMM dd, yyyy')
       ELSE cast(cast(l_shipdate AS date) AS string) END AS transaction_date,
  CASE WHEN l_quantity = 43 AND l_discount = 0.05 THEN ''
       ELSE cast(timestampadd(SECOND, cast((l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 3571) % 86400 AS int),
                              l_shipdate) AS string) END AS transaction_timestamp,
  CASE WHEN l_quantity = 42 AND l_discount = 0.06 THEN '0.00'
       WHEN l_quantity = 42 AND l_discount = 0.07 THEN concat('(', cast(cast(l_extendedprice AS decimal(18,2)) AS string), ')')
       WHEN l_quantity = 42 AND l_discount = 0.08 THEN 'n/a'
       WHEN l_quantity = 42 AND l_discount = 0.09 THEN ''
       WHEN l_linenumber = 3 THEN concat('$', format_number(cast(l_extendedprice AS decimal(18,2)), 2))
       WHEN l_linenumber = 4 THEN concat(cast(cast(l_extendedprice AS decimal(18,2)) AS string), ' USD')
       ELSE cast(cast(l_extendedprice AS decimal(18,2)) AS string) END AS transaction_amount,
  CASE WHEN l_quantity = 41 AND l_discount = 0.05 THEN 'gambling' ELSE {CATEGORY} END AS transaction_category,
  CASE WHEN l_quantity = 41 AND l_discount = 0.06 THEN 'barter'
       WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 'direct deposit'
       WHEN l_returnflag = 'R' AND l_linenumber <= 4 THEN 'Refund'
       WHEN l_returnflag = 'R' THEN 'cash_deposit'
       ELSE element_at(array('card purchase','ACH-payment','bank_transfer','ATM withdrawal','bill payment',
                             'automatic payment','bank  fee'), l_linenumber) END AS transaction_type,
  CASE WHEN l_quantity = 40 AND l_discount = 0.05 THEN 'Unknown'
       WHEN o_orderstatus = 'P' AND l_returnflag = 'R' THEN 'declined'
       WHEN o_orderstatus = 'P' AND l_returnflag = 'A' THEN ' reversed'
       WHEN o_orderstatus = 'O' AND l_returnflag = 'R' THEN 'PENDING'
       WHEN o_orderstatus = 'F' THEN ' apprved ' ELSE 'Approved' END AS transaction_status,
  CASE WHEN l_quantity = 40 AND l_discount = 0.06 THEN ''
       WHEN l_quantity = 1 THEN 'auto payment'
       WHEN o_orderpriority = '1-URGENT' THEN 'mobile' WHEN o_orderpriority = '2-HIGH' THEN 'ONLINE'
       WHEN o_orderpriority = '3-MEDIUM' AND l_linenumber < 4 THEN 'pos' WHEN o_orderpriority = '3-MEDIUM' THEN 'point-of-sale'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'atm' ELSE 'branch' END AS transaction_channel,
  CASE WHEN l_quantity = 39 AND l_discount = 0.05 THEN 'dev-unknown'
       WHEN l_tax = 0.0 OR substring(o_orderpriority, 1, 1) IN ('4', '5') THEN ''
       ELSE concat('dev', o_custkey) END AS device_id,
  CASE WHEN l_quantity = 37 AND l_discount = 0.05 THEN 'br999'
       WHEN l_quantity = 38 OR substring(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN ''
       ELSE concat('br', s_nationkey) END AS branch_id,
  lower(n_name) AS city, lower({STATE}) AS state,
  CASE WHEN l_quantity = 36 AND l_discount = 0.05 THEN 'eur' WHEN l_linestatus = 'O' THEN ' usd' ELSE 'USD' END AS currency,
  CASE WHEN l_quantity = 35 AND l_discount = 0.05 THEN 'hold' WHEN l_returnflag = 'R' THEN 'credit' ELSE 'DEBIT' END
    AS debit_credit_indicator,
  concat(' purchase   of ', p_name, ' ') AS description,
  CASE WHEN n_regionkey = 4 AND l_linestatus = 'O' THEN 'Yes' ELSE 'no' END AS is_international,
  CASE WHEN l_linenumber = 1 THEN '1' ELSE '' END AS is_recurring,
  CASE WHEN l_quantity = 34 AND l_discount = 0.05 THEN 'unknown'
       WHEN l_quantity * 1000 < l_extendedprice
       THEN concat('(', format_number(cast(l_extendedprice - l_quantity * 1000 AS decimal(18,2)), 2), ')')
       ELSE concat('$', format_number(cast(l_quantity * 1000 - l_extendedprice AS decimal(18,2)), 2)) END
    AS balance_after_transaction,
  CASE WHEN l_extendedprice > 100000 THEN 'TRUE' ELSE 'False' END AS synthetic_anomaly_flag
FROM {{numbered_lines}}
JOIN {{orders}} ON l_orderkey = o_orderkey
JOIN {{part}} ON l_partkey = p_partkey
JOIN {{supplier}} ON l_suppkey = s_suppkey
JOIN {{nation}} ON s_nationkey = n_nationkey
"""

MERCHANTS = f"""
SELECT s_suppkey + 1 AS source_row_number,
  concat('mer', s_suppkey) AS merchant_id, lower(s_name) AS merchant_name,
  CASE WHEN n_regionkey < 2 THEN 'grocery' WHEN n_regionkey < 4 THEN 'rent' ELSE 'travel' END AS merchant_category,
  lower(n_name) AS city, {STATE} AS state, lower(r_name) AS region,
  CASE WHEN s_acctbal > 5000 THEN 'Yes' ELSE 'n' END AS is_online_only
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
"""

CATEGORIES = f"""
SELECT DISTINCT cast(substring(p_brand, 7) AS bigint) AS source_row_number,
  concat('cat', substring(p_brand, 7)) AS category_id, {CATEGORY} AS transaction_category,
  CASE WHEN cast(substring(p_brand, 7) AS int) <= 12 THEN 'spending' ELSE 'other  money' END AS category_group
FROM {{part}}
"""

BRANCHES = f"""
SELECT n_nationkey + 1L AS source_row_number, concat('br', n_nationkey) AS branch_id, concat(n_name, ' branch') AS branch_name,
  lower(n_name) AS city, {STATE} AS state, r_name AS region, 'Retail' AS branch_type
FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey
"""

DEVICES = """
SELECT c_custkey + 1 AS source_row_number, concat('dev', c_custkey) AS device_id, concat('cust', c_custkey) AS customer_id,
  CASE WHEN c_nationkey < 12 THEN 'Mobile App' ELSE 'Browser' END AS device_type,
  CASE WHEN c_nationkey < 6 THEN 'iOS' ELSE 'Android' END AS operating_system,
  CASE WHEN c_acctbal > 0 THEN 'y' ELSE '' END AS trusted_device
FROM {customer}
"""

SEGMENTS = """
SELECT cast(row_number() OVER (ORDER BY c_mktsegment) AS bigint) AS source_row_number,
  concat('seg', row_number() OVER (ORDER BY c_mktsegment)) AS segment_id,
  lower(c_mktsegment) AS segment_name, '1.0' AS spend_multiplier, '0.8' AS digital_preference
FROM (SELECT DISTINCT c_mktsegment FROM {customer})
"""

TRANSACTION_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


class RawMarket:
    """Raw tables by name, each derived and stored when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str, staging: Staging):
        self.spark, self.folder, self.staging = spark, folder, staging

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _query(self, text: str, *names: str, **others: DataFrame) -> DataFrame:
        return self.spark.sql(text, **{name: self.given(name) for name in names}, **others)

    def build(self, name: str) -> DataFrame:
        if name == "transactions":
            # Lines are numbered before their text is made, where the join with their orders needs them anyway.
            lines = number_in_groups(self.given("lineitem"), TRANSACTION_ORDER[0], TRANSACTION_ORDER[1:], "source_row_number")
            # Suppliers are few next to the lines: while they can be broadcast, no line is shuffled to them.
            supplier = sent_if_small(self.given("supplier"))
            return self._query(TRANSACTIONS, "orders", "part", "nation", numbered_lines=lines, supplier=supplier)
        if name == "customers":
            rows = self._query(CUSTOMERS, "customer", "supplier", "nation")
            return number_by_position(rows, "source_row_number", "number", stage="part").drop("part", "number")
        if name == "accounts":
            # One row per customer and priority: a range of customer numbers holds few rows.
            # They are stored before they are numbered, which reads them twice: the orders are grouped once.
            rows = self.staging.save(self._query(ACCOUNTS, "orders"), "account_rows")
            numbered = number_by_position(rows, "source_row_number", "number", tie_break=["priority"], bits=13)
            return numbered.drop("number", "priority")
        queries = {
            "merchants": (MERCHANTS, ["supplier", "nation", "region"]),
            "transaction_categories": (CATEGORIES, ["part"]),
            "branches": (BRANCHES, ["nation", "region"]),
            "devices": (DEVICES, ["customer"]),
            "customer_segments": (SEGMENTS, ["customer"]),
        }
        text, names = queries[name]
        return self._query(text, *names)


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as cleaned transactions: one row per event, in one scan."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    code = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    state = F.element_at(F.array(*[F.lit(name) for name in ("NY", "GA", "IL", "INT", "ZZ")]), code % 5 + 1)
    amount = F.col("value").cast("decimal(18,2)")
    return events.select(
        (F.col("event_id") + 1).alias("source_row_number"),
        F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("account_id"),
        F.concat(F.lit("M"), (code % 20).cast("string")).alias("merchant_id"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.col("ts").alias("transaction_timestamp"),
        amount.alias("transaction_amount"),
        kind.alias("transaction_category"),
        F.when(kind == "error", "Declined").otherwise("Approved").alias("transaction_status"),
        kind.alias("transaction_channel"),
        state.alias("state"),
        (code >= 90).alias("is_international"),
        (code * 20 - amount * 10).cast("decimal(18,2)").alias("balance_after_transaction"),
        (code == 0).alias("synthetic_anomaly_flag"),
    )
