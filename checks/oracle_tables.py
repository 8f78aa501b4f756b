"""The expected tables in DuckDB SQL, written from the typed columns of the given tables.

The Spark side reads these values back out of dirty text; nothing here parses text."""

from __future__ import annotations


def ratio(numerator: str, denominator: str, places: int) -> str:
    """Quotient of non-negative numbers with at most two decimals, rounded half up exactly."""
    scale = 10**places
    cents = f"CAST({numerator} * 100 AS HUGEINT)"
    return (
        f"CAST((2 * {scale} * {cents} + 100 * {denominator}) // (200 * {denominator}) AS DOUBLE) / {scale}"
    )


def title(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({text}), '[a-z]+|[^a-z]+'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


STATE = (
    "CASE WHEN n_nationkey < 14 THEN (['NY','MA','PA','GA','FL','TX','IL','OH','MN','CO','AZ','CA','WA','INT'])"
    "[n_nationkey + 1] ELSE 'N' || n_nationkey END"
)
CITY = "'Nation_' || n_nationkey"
CATEGORY = (
    "(['Groceries','Groceries','Dining','Dining','Transportation','Travel','Entertainment','Utilities','Housing',"
    "'Housing','Healthcare','Healthcare','Retail','Retail','Education','Cash Withdrawal','Cash Withdrawal','Transfers',"
    "'Transfers','Subscription Services','Subscription Services','Fees and Charges','Fees and Charges','Housing',"
    "'Dining'])[CAST(p_brand[7:] AS INTEGER)]"
)


def region(state: str) -> str:
    return (
        f"CASE WHEN {state} IN ('NY','MA','PA') THEN 'Northeast' WHEN {state} IN ('GA','FL','TX') THEN 'South' "
        f"WHEN {state} IN ('IL','OH','MN') THEN 'Midwest' WHEN {state} IN ('CO','AZ','CA','WA') THEN 'West' "
        f"WHEN {state} = 'INT' THEN 'International' ELSE 'Unknown' END"
    )


def money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


CLEAN = f"""
t AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)
      AS source_row_number,
    CASE WHEN l_quantity = 50 AND l_discount = 0.0 AND l_tax = 0.0 THEN NULL
         ELSE 'TXN-' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey END AS transaction_id,
    CASE WHEN l_quantity = 47 AND l_discount = 0.02 THEN 'ACC-UNKNOWN'
         WHEN l_quantity = 46 AND l_discount = 0.02 THEN NULL
         ELSE 'ACC' || o_custkey || '-' || o_orderpriority[1] END AS account_id,
    CASE WHEN l_quantity = 49 AND l_discount = 0.01 THEN NULL
         WHEN l_quantity = 48 AND l_discount = 0.01 THEN 'CUST-MISSING' ELSE 'CUST' || o_custkey END AS customer_id,
    CASE WHEN l_quantity = 45 AND l_discount = 0.03 THEN 'MER-UNKNOWN' ELSE 'MER' || l_suppkey END AS merchant_id,
    CASE WHEN l_quantity = 44 AND l_discount = 0.04 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS transaction_date,
    CASE WHEN l_quantity = 43 AND l_discount = 0.05 THEN NULL
         ELSE l_shipdate + to_seconds((l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 3571) % 86400) END
      AS transaction_timestamp,
    CASE WHEN l_quantity = 42 AND l_discount = 0.06 THEN 0 WHEN l_quantity = 42 AND l_discount = 0.07 THEN -{money('l_extendedprice')}
         WHEN l_quantity = 42 AND l_discount IN (0.08, 0.09) THEN NULL ELSE {money('l_extendedprice')} END AS transaction_amount,
    CASE WHEN l_quantity = 42 AND l_discount = 0.06 THEN 0
         WHEN l_quantity = 42 AND l_discount IN (0.07, 0.08, 0.09) OR l_linenumber = 4 THEN NULL
         ELSE {money('l_extendedprice')} END AS raw_amount,
    CASE WHEN l_quantity = 41 AND l_discount = 0.05 THEN 'Gambling' ELSE {CATEGORY} END AS transaction_category,
    CASE WHEN l_quantity = 41 AND l_discount = 0.06 THEN 'Barter'
         WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 'Direct Deposit'
         WHEN l_returnflag = 'R' AND l_linenumber <= 4 THEN 'Refund'
         WHEN l_returnflag = 'R' THEN 'Cash Deposit'
         ELSE (['Card Purchase','ACH Payment','Bank Transfer','ATM Withdrawal','Bill Payment','Bill Payment','Bank Fee'])
              [l_linenumber] END AS transaction_type,
    CASE WHEN l_quantity = 40 AND l_discount = 0.05 THEN 'Unknown'
         WHEN o_orderstatus = 'P' AND l_returnflag = 'R' THEN 'Declined'
         WHEN o_orderstatus = 'P' AND l_returnflag = 'A' THEN 'Reversed'
         WHEN o_orderstatus = 'O' AND l_returnflag = 'R' THEN 'Pending' ELSE 'Approved' END AS transaction_status,
    CASE WHEN l_quantity = 40 AND l_discount = 0.06 THEN NULL WHEN l_quantity = 1 THEN 'Automatic Payment'
         ELSE (['Mobile','Online','Point of Sale','ATM','Branch'])[CAST(o_orderpriority[1] AS INTEGER)] END AS transaction_channel,
    CASE WHEN l_quantity = 39 AND l_discount = 0.05 THEN 'DEV-UNKNOWN'
         WHEN l_tax = 0.0 OR o_orderpriority[1] IN ('4', '5') THEN NULL ELSE 'DEV' || o_custkey END AS device_id,
    CASE WHEN l_quantity = 37 AND l_discount = 0.05 THEN 'BR999'
         WHEN l_quantity = 38 OR o_orderpriority[1] IN ('1', '2', '3') THEN NULL ELSE 'BR' || s_nationkey END AS branch_id,
    {CITY} AS city, {STATE} AS state,
    CASE WHEN l_quantity = 36 AND l_discount = 0.05 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN l_quantity = 35 AND l_discount = 0.05 THEN 'Hold' WHEN l_returnflag = 'R' THEN 'Credit' ELSE 'Debit' END
      AS debit_credit_indicator,
    'purchase of ' || p_name AS description,
    n_regionkey = 4 AND l_linestatus = 'O' AS is_international,
    l_linenumber = 1 AS is_recurring,
    CASE WHEN l_quantity = 34 AND l_discount = 0.05 THEN NULL ELSE {money('l_quantity * 1000 - l_extendedprice')} END
      AS balance_after_transaction,
    l_extendedprice > 100000 AS synthetic_anomaly_flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
customers AS (
  SELECT row_number() OVER (ORDER BY part, number) AS source_row_number, * EXCLUDE (part, number) FROM (
    SELECT 0 AS part, c_custkey AS number, 'CUST' || c_custkey AS customer_id, c_name AS customer_display_name,
      CASE WHEN c_acctbal < 1000 THEN '18-24' WHEN c_acctbal < 4000 THEN '25-34' WHEN c_acctbal < 7000 THEN '35-44' ELSE '45+' END
        AS age_group,
      {CITY} AS city, {STATE} AS state,
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Students' WHEN 'BUILDING' THEN 'Young Professionals' WHEN 'FURNITURE' THEN 'Families'
        WHEN 'HOUSEHOLD' THEN 'Affluent' ELSE c_mktsegment[1] || lower(c_mktsegment[2:]) END AS customer_segment,
      CASE WHEN c_nationkey <> 24 THEN CAST(floor(c_acctbal / 50) AS INTEGER) END AS account_tenure_months,
      DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS join_date,
      CASE WHEN c_nationkey < 8 THEN 'Mobile' WHEN c_nationkey < 16 THEN 'Point of Sale' ELSE 'Online' END AS preferred_channel,
      CASE WHEN c_acctbal < 2000 THEN 'High' ELSE 'Low' END AS risk_tier, '$40k-$75k' AS income_band
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL
    SELECT 1, s_suppkey, 'CUST' || s_suppkey, s_name, '45+', {CITY}, {STATE}, 'Small Business', 120, DATE '1994-01-01',
      'Branch', 'Medium', NULL
    FROM supplier JOIN nation ON s_nationkey = n_nationkey)
),
accounts AS (
  SELECT row_number() OVER (ORDER BY o_custkey, o_orderpriority) AS source_row_number,
    'ACC' || o_custkey || '-' || o_orderpriority[1] AS account_id,
    CASE WHEN count(*) >= 6 THEN 'CUST-GONE' ELSE 'CUST' || o_custkey END AS customer_id,
    (['Checking','Savings','Credit Card','Money Market','Brokerage'])[CAST(o_orderpriority[1] AS INTEGER)] AS account_type,
    CAST(min(o_orderdate) AS DATE) + 7 AS open_date,
    CASE count(*) WHEN 1 THEN 'Closed' WHEN 2 THEN 'Dormant' ELSE 'Active' END AS account_status,
    CASE count(*) WHEN 1 THEN CAST(max(o_orderdate) AS DATE) + 90 END AS close_date,
    {money(f"sum({money('o_totalprice')})")} AS current_balance,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(-5000 AS DECIMAL(18,2)) END AS credit_limit,
    'BR' || (o_custkey % 30) AS branch_id, 'USD' AS currency, 'Standard' AS product_tier
  FROM orders GROUP BY o_custkey, o_orderpriority
),
merchants AS (
  SELECT s_suppkey + 1 AS source_row_number, 'MER' || s_suppkey AS merchant_id, s_name AS merchant_name,
    CASE WHEN n_regionkey < 2 THEN 'Groceries' WHEN n_regionkey < 4 THEN 'Housing' ELSE 'Travel' END AS merchant_category,
    {CITY} AS city, {STATE} AS state, {title('r_name')} AS region, s_acctbal > 5000 AS is_online_only
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
categories AS (
  SELECT DISTINCT CAST(p_brand[7:] AS BIGINT) AS source_row_number, 'CAT' || p_brand[7:] AS category_id,
    {CATEGORY} AS transaction_category,
    CASE WHEN CAST(p_brand[7:] AS INTEGER) <= 12 THEN 'Spending' ELSE 'Other Money' END AS category_group
  FROM part
),
branches AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS source_row_number, 'BR' || n_nationkey AS branch_id,
    'Nation_' || n_nationkey || ' Branch' AS branch_name, {CITY} AS city, {STATE} AS state, {title('r_name')} AS region,
    'Retail' AS branch_type
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
devices AS (
  SELECT c_custkey + 1 AS source_row_number, 'DEV' || c_custkey AS device_id, 'CUST' || c_custkey AS customer_id,
    CASE WHEN c_nationkey < 12 THEN 'Mobile App' ELSE 'Browser' END AS device_type,
    CASE WHEN c_nationkey < 6 THEN 'iOS' ELSE 'Android' END AS operating_system, c_acctbal > 0 AS trusted_device
  FROM customer
)"""

CATEGORY_NAMES = (
    "'Groceries','Dining','Transportation','Travel','Entertainment','Utilities','Housing','Healthcare','Retail',"
    "'Education','Cash Withdrawal','Transfers','Subscription Services','Fees and Charges'"
)

# rule -> (source, condition, column, severity, description, blocking); conditions read the CTEs below.
RULES = {
    "duplicate_customer_id": (
        "customers", "id_copies > 1", "customer_id", "Warning", "Duplicate customer record found", False),
    "valid_customer_segment": (
        "customers",
        "customer_segment IS NULL OR customer_segment NOT IN "
        "('Students','Young Professionals','Families','Affluent','Retirees','Small Business')",
        "customer_segment", "Error", "Customer segment is not in the configured segment list", False),
    "account_customer_exists": (
        "accounts", "NOT customer_known", "customer_id", "Error", "Account references a customer that does not exist", False),
    "valid_account_type": (
        "accounts", "account_type NOT IN ('Checking','Savings','Credit Card','Money Market')", "account_type", "Error",
        "Account type is not valid", False),
    "account_branch_exists": (
        "accounts", "NOT branch_known", "branch_id", "Error", "Account references a branch that does not exist", False),
    "transaction_id_present": (
        "transactions", "transaction_id IS NULL", "transaction_id", "Critical", "Transaction ID is missing", True),
    "transaction_id_unique": (
        "transactions", "transaction_id IS NOT NULL AND id_copies > 1", "transaction_id", "Error", "Transaction ID is duplicated", True),
    "customer_id_exists": (
        "transactions", "NOT customer_known", "customer_id", "Error", "Customer ID does not exist", True),
    "account_id_exists": (
        "transactions", "owner IS NULL", "account_id", "Error", "Account ID does not exist", True),
    "account_belongs_to_customer": (
        "transactions", "owner IS NOT NULL AND owner IS DISTINCT FROM customer_id", "account_id", "Error",
        "Account does not belong to the listed customer", True),
    "transaction_after_account_open": (
        "transactions", "owner = customer_id AND transaction_date < open_date", "transaction_date", "Error",
        "Transaction date is before account open date", True),
    "transaction_before_account_close": (
        "transactions", "owner = customer_id AND account_status = 'Closed' AND transaction_date > close_date",
        "transaction_date", "Error", "Transaction occurs after the account close date", True),
    "merchant_id_exists": (
        "transactions", "NOT merchant_known", "merchant_id", "Error", "Merchant ID does not exist", True),
    "transaction_amount_numeric": (
        "transactions", "transaction_amount IS NULL", "transaction_amount", "Error", "Transaction amount is not numeric", True),
    "transaction_amount_not_zero": (
        "transactions", "transaction_amount = 0", "transaction_amount", "Error", "Transaction amount is zero", True),
    "purchase_amount_positive": (
        "transactions", "transaction_amount < 0", "transaction_amount", "Error",
        "Transaction amount should be positive with debit or credit direction stored separately", True),
    "transaction_date_valid": (
        "transactions", "transaction_date IS NULL", "transaction_date", "Error", "Transaction date is not valid", True),
    "transaction_date_in_reporting_range": (
        "transactions", "transaction_date NOT BETWEEN DATE '1995-06-01' AND DATE '2001-06-30'", "transaction_date", "Error",
        "Transaction date is outside the configured reporting range", True),
    "transaction_timestamp_valid": (
        "transactions", "transaction_timestamp IS NULL", "transaction_timestamp", "Error", "Transaction timestamp is not valid", True),
    "transaction_category_valid": (
        "transactions", f"NOT category_known OR transaction_category NOT IN ({CATEGORY_NAMES})",
        "transaction_category", "Error", "Transaction category is not valid", True),
    "transaction_type_valid": (
        "transactions",
        "transaction_type NOT IN ('Card Purchase','ACH Payment','Bank Transfer','ATM Withdrawal','Direct Deposit',"
        "'Bill Payment','Refund','Bank Fee','Cash Deposit')",
        "transaction_type", "Error", "Transaction type is not valid", True),
    "transaction_status_valid": (
        "transactions", "transaction_status NOT IN ('Approved','Declined','Pending','Reversed')", "transaction_status", "Error",
        "Transaction status is not valid", True),
    "transaction_channel_valid": (
        "transactions",
        "transaction_channel IS NULL OR transaction_channel NOT IN "
        "('Mobile','Online','ATM','Branch','Point of Sale','Automatic Payment')",
        "transaction_channel", "Error", "Transaction channel is not valid", True),
    "currency_supported": (
        "transactions", "currency <> 'USD'", "currency", "Error", "Currency is not supported", True),
    "branch_id_exists": (
        "transactions", "branch_id IS NOT NULL AND NOT branch_known", "branch_id", "Error", "Branch ID does not exist", True),
    "branch_required_for_channel": (
        "transactions", "transaction_channel IN ('Branch','ATM') AND branch_id IS NULL", "branch_id", "Warning",
        "Branch or ATM transactions should include a branch ID", False),
    "device_id_exists": (
        "transactions", "device_id IS NOT NULL AND NOT device_known", "device_id", "Warning", "Device ID does not exist", False),
    "device_expected_for_digital_transaction": (
        "transactions", "transaction_channel IN ('Mobile','Online','Point of Sale') AND device_id IS NULL", "device_id",
        "Warning", "Digital transactions usually include a device ID", False),
    "balance_numeric": (
        "transactions", "balance_after_transaction IS NULL", "balance_after_transaction", "Error",
        "Balance after transaction is not numeric", True),
}

RECORD = {
    "customers": ("checked_customers", "customer_id", "CASE WHEN rule_name = 'duplicate_customer_id' THEN 1 ELSE 2 END"),
    "accounts": ("checked_accounts", "account_id", "3"),
    "transactions": ("checked", "coalesce(transaction_id, 'row_' || source_row_number)", "4"),
}

_blocking = " OR ".join(f"coalesce({rule[1]}, FALSE)" for rule in RULES.values() if rule[5])

CHECKED = f""",
checked_customers AS (
  SELECT *, CASE WHEN customer_id IS NOT NULL THEN count(*) OVER (PARTITION BY customer_id) END AS id_copies FROM customers
),
checked_accounts AS (
  SELECT *, customer_id IN (SELECT customer_id FROM customers) AS customer_known,
    branch_id IN (SELECT branch_id FROM branches) AS branch_known FROM accounts
),
checked AS (
  SELECT t.*, count(*) OVER (PARTITION BY transaction_id) AS id_copies,
    coalesce(t.customer_id IN (SELECT customer_id FROM customers), FALSE) AS customer_known,
    a.customer_id AS owner, a.open_date, a.close_date, a.account_status,
    t.merchant_id IN (SELECT merchant_id FROM merchants) AS merchant_known,
    t.branch_id IN (SELECT branch_id FROM branches) AS branch_known,
    t.device_id IN (SELECT device_id FROM devices) AS device_known,
    t.transaction_category IN (SELECT transaction_category FROM categories) AS category_known
  FROM t LEFT JOIN accounts a ON t.account_id = a.account_id
),
marked AS (SELECT *, {_blocking} AS has_blocking_quality_issue FROM checked),
valid AS (SELECT * FROM marked WHERE NOT has_blocking_quality_issue)"""


def _issue_part(order: int, name: str) -> str:
    source, condition, column, severity, description, _ = RULES[name]
    table, record, stage = RECORD[source]
    return (
        f"SELECT {stage} AS stage, source_row_number, {order} AS rule_order, '{source}.csv' AS source_file, "
        f"{record} AS record_identifier, '{column}' AS column_name, rule_name, '{severity}' AS severity, "
        f"'{description}' AS description, coalesce(CAST({column} AS VARCHAR), '') AS original_value "
        f"FROM (SELECT *, '{name}' AS rule_name FROM {table}) WHERE {condition}"
    )


ISSUES = (
    ",\nissue_rows AS (\n"
    + "\nUNION ALL ".join(_issue_part(order, name) for order, name in enumerate(RULES))
    + """),
issues AS (
  SELECT 'DQI' || lpad(CAST(row_number() OVER (ORDER BY stage, source_row_number, rule_order) AS VARCHAR), 7, '0') AS issue_id,
    source_file, record_identifier, column_name, rule_name, severity, description, original_value,
    'Open' AS resolution_status
  FROM issue_rows
)"""
)


def _first(table: str, key: str) -> str:
    return f"(SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY source_row_number) = 1)"


def _dimension(name: str, table: str, key: str, business: str, unknown: str, columns: str) -> str:
    return (
        f"{name} AS (SELECT CAST(0 AS BIGINT) AS {key}, {unknown} UNION ALL "
        f"SELECT row_number() OVER (ORDER BY source_row_number), {columns} FROM {_first(table, business)})"
    )


_U = "'Unknown'"
MODEL = ",\n" + ",\n".join(
    [
        _dimension(
            "dim_customer", "customers", "customer_key", "customer_id",
            f"{_U} AS customer_id, {_U} AS customer_display_name, {_U} AS age_group, {_U} AS city, {_U} AS state, "
            f"{_U} AS customer_segment, NULL AS account_tenure_months, NULL AS join_date, {_U} AS preferred_channel, "
            f"{_U} AS risk_tier, {_U} AS income_band",
            "customer_id, customer_display_name, age_group, city, state, customer_segment, account_tenure_months, join_date, "
            "preferred_channel, risk_tier, income_band"),
        _dimension(
            "dim_account", "accounts", "account_key", "account_id",
            f"{_U} AS account_id, {_U} AS customer_id, {_U} AS account_type, NULL AS open_date, {_U} AS account_status, "
            f"NULL AS close_date, NULL AS current_balance, NULL AS credit_limit, {_U} AS branch_id, {_U} AS currency, {_U} AS product_tier",
            "account_id, customer_id, account_type, open_date, account_status, close_date, current_balance, credit_limit, "
            "branch_id, currency, product_tier"),
        _dimension(
            "dim_merchant", "merchants", "merchant_key", "merchant_id",
            f"{_U} AS merchant_id, {_U} AS merchant_name, {_U} AS merchant_category, {_U} AS city, {_U} AS state, {_U} AS region, "
            "NULL AS is_online_only",
            "merchant_id, merchant_name, merchant_category, city, state, region, is_online_only"),
        _dimension(
            "dim_transaction_category", "categories", "transaction_category_key", "transaction_category",
            f"{_U} AS category_id, {_U} AS transaction_category, {_U} AS category_group",
            "category_id, transaction_category, category_group"),
        _dimension(
            "dim_device", "devices", "device_key", "device_id",
            f"{_U} AS device_id, {_U} AS customer_id, {_U} AS device_type, {_U} AS operating_system, NULL AS trusted_device",
            "device_id, customer_id, device_type, operating_system, trusted_device"),
        _dimension(
            "dim_branch", "branches", "branch_key", "branch_id",
            f"{_U} AS branch_id, {_U} AS branch_name, {_U} AS city, {_U} AS state, {_U} AS region, {_U} AS branch_type",
            "branch_id, branch_name, city, state, region, branch_type"),
        f"""dim_channel AS (SELECT CAST(0 AS BIGINT) AS channel_key, {_U} AS transaction_channel UNION ALL
  SELECT row_number() OVER (ORDER BY transaction_channel), transaction_channel FROM (SELECT DISTINCT transaction_channel FROM valid))""",
        f"""dim_transaction_status AS (SELECT CAST(0 AS BIGINT) AS transaction_status_key, {_U} AS transaction_status UNION ALL
  SELECT row_number() OVER (ORDER BY transaction_status), transaction_status FROM (SELECT DISTINCT transaction_status FROM valid))""",
        f"""places AS (
  SELECT city, state, min(CAST(source AS BIGINT) * 1000000000 + source_row_number) AS seen FROM (
    SELECT 0 AS source, source_row_number, city, state FROM valid
    UNION ALL SELECT 1, source_row_number, city, state FROM {_first('customers', 'customer_id')}
    UNION ALL SELECT 2, source_row_number, city, state FROM merchants
    UNION ALL SELECT 3, source_row_number, city, state FROM branches) GROUP BY city, state)""",
        f"""dim_location AS (SELECT CAST(0 AS BIGINT) AS location_key, {_U} AS city, {_U} AS state, {_U} AS region, {_U} AS location_business_key
  UNION ALL SELECT row_number() OVER (ORDER BY seen), city, state, {region('state')}, city || '|' || state FROM places)""",
        """dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
    'Q' || quarter(d) AS quarter, CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
    CAST(date_trunc('month', d) AS DATE) AS month_start_date, CAST(weekofyear(d) AS INTEGER) AS week_number,
    dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
  FROM range(DATE '1995-06-01', DATE '2001-07-01', INTERVAL 1 DAY) r(d))""",
        """fact AS (
  SELECT row_number() OVER (ORDER BY v.source_row_number) AS transaction_key, v.transaction_id,
    CAST(strftime(v.transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
    coalesce(c.customer_key, 0) AS customer_key, coalesce(a.account_key, 0) AS account_key,
    coalesce(m.merchant_key, 0) AS merchant_key, coalesce(k.transaction_category_key, 0) AS transaction_category_key,
    coalesce(h.channel_key, 0) AS channel_key, coalesce(p.location_key, 0) AS location_key,
    coalesce(d.device_key, 0) AS device_key, coalesce(b.branch_key, 0) AS branch_key,
    coalesce(s.transaction_status_key, 0) AS transaction_status_key,
    v.source_row_number, v.account_id, v.customer_id, v.merchant_id, v.transaction_timestamp, v.transaction_amount,
    CASE WHEN debit_credit_indicator = 'Credit' THEN transaction_amount ELSE -transaction_amount END AS signed_transaction_amount,
    CASE WHEN debit_credit_indicator = 'Debit' THEN transaction_amount ELSE 0 END AS debit_amount,
    CASE WHEN debit_credit_indicator = 'Credit' THEN transaction_amount ELSE 0 END AS credit_amount,
    CASE WHEN v.transaction_status = 'Approved' THEN transaction_amount ELSE 0 END AS approved_amount,
    1 AS transaction_count,
    v.transaction_status = 'Approved' AS is_approved, v.transaction_status = 'Declined' AS is_declined,
    v.transaction_status = 'Pending' AS is_pending, v.transaction_status = 'Reversed' AS is_reversed,
    v.is_international, v.is_recurring, v.debit_credit_indicator, v.balance_after_transaction
  FROM valid v
  LEFT JOIN dim_customer c ON v.customer_id = c.customer_id LEFT JOIN dim_account a ON v.account_id = a.account_id
  LEFT JOIN dim_merchant m ON v.merchant_id = m.merchant_id
  LEFT JOIN dim_transaction_category k ON v.transaction_category = k.transaction_category
  LEFT JOIN dim_channel h ON v.transaction_channel = h.transaction_channel
  LEFT JOIN dim_location p ON v.city = p.city AND v.state = p.state
  LEFT JOIN dim_device d ON v.device_id = d.device_id LEFT JOIN dim_branch b ON v.branch_id = b.branch_id
  LEFT JOIN dim_transaction_status s ON v.transaction_status = s.transaction_status)""",
        """monthly AS (
  SELECT row_number() OVER (ORDER BY customer_key, month_start_date) AS customer_monthly_summary_key, * FROM (
    SELECT customer_key, month_start_date, count(transaction_id) AS transaction_count,
      count(*) FILTER (is_approved) AS approved_transaction_count, count(*) FILTER (is_declined) AS declined_transaction_count,
      CAST(sum(debit_amount) AS DOUBLE) AS debit_transaction_value, CAST(sum(credit_amount) AS DOUBLE) AS credit_transaction_value,
      CAST(sum(signed_transaction_amount) AS DOUBLE) AS net_transaction_flow,
      CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS average_transaction_amount,
      count(*) FILTER (is_recurring) AS recurring_transaction_count,
      count(*) FILTER (is_international) AS international_transaction_count,
      CAST(strftime(month_start_date, '%Y%m%d') AS INTEGER) AS month_date_key
    FROM fact LEFT JOIN dim_date USING (date_key) GROUP BY customer_key, month_start_date))""",
        """daily_balance AS (
  SELECT row_number() OVER (ORDER BY account_key, date_key) AS account_daily_balance_key, account_key, date_key,
    balance_after_transaction AS ending_balance
  FROM (SELECT *, row_number() OVER (PARTITION BY account_key, date_key
                 ORDER BY transaction_timestamp DESC, source_row_number DESC) AS place FROM fact WHERE is_approved) WHERE place = 1)""",
    ]
)


def review_rules(source: str, high_value: str, minutes: str, balance: str) -> str:
    """CTEs from a transaction table to ``reviewed``: every row with its eight flags."""
    return f""",
spending AS (
  SELECT customer_id, avg(CAST(transaction_amount AS DOUBLE)) AS mean_amount,
    coalesce(stddev_samp(CAST(transaction_amount AS DOUBLE)), 0) AS deviation,
    median(CAST(transaction_amount AS DOUBLE)) AS median_amount
  FROM {source} GROUP BY customer_id
),
history AS (
  SELECT *, {region('state')} AS region, round_even(CAST(transaction_amount AS DOUBLE), 0) AS rounded_amount FROM {source}
),
previous AS (
  SELECT *,
    lag(transaction_timestamp) OVER (PARTITION BY customer_id, merchant_id, rounded_amount
      ORDER BY transaction_timestamp, source_row_number) AS previous_repeat,
    lag(transaction_timestamp) OVER same_customer AS previous_timestamp,
    lag(region) OVER same_customer AS previous_region,
    sum(CAST(is_international AS INTEGER)) OVER same_customer - CAST(is_international AS INTEGER) AS prior_international,
    count(*) FILTER (transaction_status = 'Declined') OVER (PARTITION BY customer_id, transaction_date) AS declines
  FROM history
  WINDOW same_customer AS (PARTITION BY customer_id ORDER BY transaction_timestamp, source_row_number)
),
reviewed AS (
  SELECT p.*,
    transaction_amount >= {high_value} AS high_value_transaction,
    CAST(transaction_amount AS DOUBLE) > greatest(mean_amount + 3 * deviation, median_amount * 4, 500) AS spending_deviation,
    coalesce(date_diff('microsecond', previous_repeat, transaction_timestamp) BETWEEN 0 AND CAST({minutes} AS BIGINT) * 60000000, FALSE)
      AS rapid_repeat_transaction,
    coalesce(region <> previous_region AND region <> 'Unknown' AND previous_region <> 'Unknown'
      AND date_diff('microsecond', previous_timestamp, transaction_timestamp) <= 7200000000, FALSE) AS geographic_inconsistency,
    is_international AND prior_international <= 1 AS unusual_international_activity,
    hour(transaction_timestamp) BETWEEN 0 AND 5 AS unusual_transaction_time,
    transaction_status = 'Declined' AND declines >= 3 AS repeated_declines,
    balance_after_transaction <= {balance} AND transaction_amount >= 1000 AS balance_issue
  FROM previous p JOIN spending USING (customer_id)
),
scored AS (
  SELECT *, 2 * CAST(high_value_transaction AS INTEGER) + 3 * CAST(spending_deviation AS INTEGER)
      + 2 * CAST(rapid_repeat_transaction AS INTEGER) + 3 * CAST(geographic_inconsistency AS INTEGER)
      + 2 * CAST(unusual_international_activity AS INTEGER) + CAST(unusual_transaction_time AS INTEGER)
      + 2 * CAST(repeated_declines AS INTEGER) + 2 * CAST(balance_issue AS INTEGER) AS anomaly_score,
    concat_ws(', ', CASE WHEN high_value_transaction THEN 'high_value_transaction' END,
      CASE WHEN spending_deviation THEN 'spending_deviation' END,
      CASE WHEN rapid_repeat_transaction THEN 'rapid_repeat_transaction' END,
      CASE WHEN geographic_inconsistency THEN 'geographic_inconsistency' END,
      CASE WHEN unusual_international_activity THEN 'unusual_international_activity' END,
      CASE WHEN unusual_transaction_time THEN 'unusual_transaction_time' END,
      CASE WHEN repeated_declines THEN 'repeated_declines' END,
      CASE WHEN balance_issue THEN 'balance_issue' END) AS triggered_rules
  FROM reviewed
),
flags AS (
  SELECT 'ANOM' || lpad(CAST(row_number() OVER (ORDER BY source_row_number) AS VARCHAR), 7, '0') AS anomaly_id,
    transaction_id, customer_id, account_id, transaction_date, transaction_amount, transaction_category, transaction_channel,
    high_value_transaction, spending_deviation, rapid_repeat_transaction, geographic_inconsistency,
    unusual_international_activity, unusual_transaction_time, repeated_declines, balance_issue, triggered_rules,
    anomaly_score, CASE WHEN anomaly_score >= 6 THEN 'High' WHEN anomaly_score >= 3 THEN 'Medium' ELSE 'Low' END AS review_priority,
    synthetic_anomaly_flag
  FROM scored WHERE anomaly_score > 0
)"""


EVENTS = """
event_tx AS (
  SELECT event_id + 1 AS source_row_number, 'EV' || event_id AS transaction_id, 'U' || user_id AS customer_id,
    'A' || user_id AS account_id, 'M' || (k % 20) AS merchant_id, CAST(ts AS DATE) AS transaction_date,
    ts AS transaction_timestamp, CAST(value AS DECIMAL(18,2)) AS transaction_amount, event_type AS transaction_category,
    CASE WHEN event_type = 'error' THEN 'Declined' ELSE 'Approved' END AS transaction_status,
    event_type AS transaction_channel, (['NY','GA','IL','INT','ZZ'])[k % 5 + 1] AS state, k >= 90 AS is_international,
    CAST(k * 20 - CAST(value AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2)) AS balance_after_transaction,
    k = 0 AS synthetic_anomaly_flag
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

FLAGS = review_rules("valid", "100000", "10", "-40000")


def over_clean(select: str) -> str:
    return f"WITH {CLEAN}\n{select}"


def over_checked(select: str) -> str:
    return f"WITH {CLEAN}{CHECKED}\n{select}"


def over_issues(select: str) -> str:
    return f"WITH {CLEAN}{CHECKED}{ISSUES}\n{select}"


def over_model(select: str) -> str:
    return f"WITH {CLEAN}{CHECKED}{MODEL}\n{select}"


def over_flags(select: str) -> str:
    return f"WITH {CLEAN}{CHECKED}{MODEL}{FLAGS}\n{select}"


def over_everything(select: str) -> str:
    return f"WITH {CLEAN}{CHECKED}{ISSUES}{MODEL}{FLAGS}\n{select}"


def over_events(select: str, high_value: str = "200", minutes: str = "1440", balance: str = "-500") -> str:
    return f"WITH {EVENTS}{review_rules('event_tx', high_value, minutes, balance)}\n{select}"
