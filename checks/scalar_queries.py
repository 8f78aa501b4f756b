"""Scalar functions and cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle_tables import CATEGORY, over_clean, ratio, region, title
from checks.registry import add_given, add_star
from ledgerflow.functions import numbers, parsing, text
from ledgerflow.operators.dimensions import build_dim_date
from checks.market import CATEGORY as CATEGORY_TEXT
from checks.market import STATE as STATE_TEXT

col, expr = F.col, F.expr

LINE = ["l_orderkey", "l_linenumber", "l_partkey"]
LINE_SQL = "SELECT l_orderkey, l_linenumber, l_partkey"

add_given(
    "c01_clean_text",
    "part",
    lambda part: part.select(
        "p_partkey",
        text.clean_text(expr("CASE WHEN p_size = 1 THEN '  ' ELSE concat('  ', p_name, '\t\n of   ', p_type, ' ') END")).alias("cleaned"),
    ),
    "SELECT p_partkey, CASE WHEN p_size <> 1 THEN p_name || ' of ' || p_type END AS cleaned FROM part",
)
_TITLED = "concat(lower(p_type), '-', p_name, ' o''', lower(p_type), ' ', p_size, 'm')"
add_given(
    "c02_title_clean",
    "part",
    lambda part: part.select("p_partkey", text.title_clean(expr(_TITLED.replace("''", "\\'"))).alias("titled")),
    f"SELECT p_partkey, {title(_TITLED)} AS titled FROM part",
)
add_given(
    "c03_upper_id",
    "orders",
    lambda orders: orders.select("o_orderkey", text.upper_clean(expr("concat(' ord  ', o_orderkey, ' ')")).alias("order_id")),
    "SELECT o_orderkey, 'ORD ' || o_orderkey AS order_id FROM orders",
)
add_given(
    "c04_lookup_normalized",
    "orders",
    lambda orders: orders.select(
        "o_orderkey", text.canonical(expr("replace(lower(substring(o_orderpriority, 3)), ' ', '-')"), {"low": "Low Priority"}).alias("priority")
    ),
    "SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'Low Priority' WHEN '4-NOT SPECIFIED' THEN 'Not-Specified' "
    "ELSE o_orderpriority[3] || lower(o_orderpriority[4:]) END AS priority FROM orders",
)
add_given(
    "c05_normalize_category",
    "part",
    lambda part: part.select("p_partkey", text.normalize_category(expr(CATEGORY_TEXT)).alias("category")),
    f"SELECT p_partkey, {CATEGORY} AS category FROM part",
)
add_given(
    "c06_normalize_status",
    "orders",
    lambda orders: orders.select(
        "o_orderkey",
        text.normalize_status(
            expr("CASE o_orderstatus WHEN 'F' THEN ' apprved ' WHEN 'O' THEN 'PENDING' ELSE 'on_hold' END")
        ).alias("status"),
    ),
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Pending' ELSE 'On_Hold' END AS status FROM orders",
)
add_given(
    "c07_normalize_channel",
    "orders",
    lambda orders: orders.select(
        "o_orderkey",
        text.normalize_channel(
            expr(
                "element_at(array('POS', 'point-of-sale', ' auto_payment', 'Atm', 'call-centre'),"
                " cast(substring(o_orderpriority, 1, 1) AS int))"
            )
        ).alias("channel"),
    ),
    "SELECT o_orderkey, (['Point of Sale','Point of Sale','Automatic Payment','ATM','Call-Centre'])"
    "[CAST(o_orderpriority[1] AS INTEGER)] AS channel FROM orders",
)
add_given(
    "c08_normalize_account_type",
    "orders",
    lambda orders: orders.select(
        "o_orderkey",
        text.normalize_account_type(
            expr(
                "element_at(array('CHECKING', ' savings', 'credit_card', 'Money-Market', 'brokerage'),"
                " cast(substring(o_orderpriority, 1, 1) AS int))"
            )
        ).alias("account_type"),
    ),
    "SELECT o_orderkey, (['Checking','Savings','Credit Card','Money Market','Brokerage'])"
    "[CAST(o_orderpriority[1] AS INTEGER)] AS account_type FROM orders",
)
add_given(
    "c09_normalize_transaction_type",
    "lineitem",
    lambda lines: lines.select(
        *LINE,
        text.normalize_transaction_type(
            expr(
                "element_at(array('card-purchase', 'ACH payment', 'Cash Withdrawal', 'automatic  payment', 'refund', 'bank_fee',"
                " 'swap'), l_linenumber)"
            )
        ).alias("transaction_type"),
    ),
    f"{LINE_SQL}, (['Card Purchase','ACH Payment','ATM Withdrawal','Bill Payment','Refund','Bank Fee','Swap'])"
    "[l_linenumber] AS transaction_type FROM lineitem",
)
add_given(
    "c10_normalize_currency",
    "lineitem",
    lambda lines: lines.select(
        *LINE, text.normalize_currency(expr("CASE l_linestatus WHEN 'O' THEN ' usd ' ELSE '' END")).alias("currency")
    ),
    f"{LINE_SQL}, CASE l_linestatus WHEN 'O' THEN 'USD' END AS currency FROM lineitem",
)
_PRICE = "cast(cast(l_extendedprice AS decimal(18,2)) AS string)"
# Amount spellings by quantity, beside those by line number: more than two places, brackets, many digits, exponents.
_ODD_AMOUNTS = {1: "0.004", 2: "12.345", 3: "(0.001)", 4: "12345678901234567890", 5: "1e2", 6: "1e40"}
_ODD_VALUES = {1: "0.004", 2: "12.345", 3: "-0.001", 4: "12345678901234567890", 5: "100", 6: "1e30"}
add_given(
    "c11_parse_currency",
    "lineitem",
    lambda lines: lines.select(
        *LINE,
        parsing.parse_currency(
            expr(
                "CASE " + " ".join(f"WHEN l_quantity = {at} THEN '{text}'" for at, text in _ODD_AMOUNTS.items())
                + " WHEN l_linenumber = 1 THEN concat('$', format_number(cast(l_extendedprice AS decimal(18,2)), 2))"
                f" WHEN l_linenumber = 2 THEN concat('(', {_PRICE}, ')') WHEN l_linenumber = 3 THEN concat(' ', {_PRICE}, ' USD')"
                f" WHEN l_linenumber = 4 THEN 'n/a' WHEN l_linenumber = 5 THEN ''"
                f" WHEN l_linenumber = 6 THEN concat({_PRICE}, ' usd') ELSE {_PRICE} END"
            )
        ).alias("amount"),
    ),
    f"{LINE_SQL}, CASE " + " ".join(f"WHEN l_quantity = {at} THEN {value}::DOUBLE" for at, value in _ODD_VALUES.items())
    + " WHEN l_linenumber IN (1, 3, 7) THEN l_extendedprice WHEN l_linenumber = 2 THEN -l_extendedprice END AS amount "
    "FROM lineitem",
)
_DAY = "cast(l_shipdate AS date)"
# Date spellings by quantity, beside those by line number.
_DATE_SPELLINGS = (
    "yyyy/MM/dd", "MM-dd-yyyy", "dd-MMM-yyyy", "dd MMM yyyy", "MMM dd yyyy", "yyyyMMdd", "MM/dd/yy", "yyyy.MM.dd", "MMMM d, yyyy"
)
add_given(
    "c12_parse_date",
    "lineitem",
    lambda lines: lines.select(
        *LINE,
        parsing.parse_date(
            expr(
                "CASE " + " ".join(f"WHEN l_quantity = {at} THEN date_format({_DAY}, '{p}')" for at, p in enumerate(_DATE_SPELLINGS, 1))
                + f" WHEN l_quantity = 10 AND month({_DAY}) = 9 THEN concat('Sept ', day({_DAY}), ', ', year({_DAY}))"
                f" WHEN l_quantity = 11 THEN date_format({_DAY}, 'dd/MM/yyyy')"
                f" WHEN l_quantity = 12 THEN date_format({_DAY}, 'MM/dd/yyyy') || ' 2:30 PM'"
                f" WHEN l_linenumber = 1 THEN date_format({_DAY}, 'MM/dd/yyyy')"
                f" WHEN l_linenumber = 2 THEN date_format({_DAY}, 'MMM dd, yyyy')"
                " WHEN l_linenumber = 3 THEN cast(l_shipdate AS string) WHEN l_linenumber = 4 THEN 'soon'"
                f" WHEN l_linenumber = 5 THEN CASE WHEN day({_DAY}) > 12 THEN date_format({_DAY}, 'dd/MM/yyyy') END"
                f" ELSE cast({_DAY} AS string) END"
            )
        ).alias("ship_date"),
    ),
    # A day up to 12 in front of the month is read as the month.
    f"{LINE_SQL}, CASE WHEN l_quantity < 10 OR l_quantity = 10 AND month(l_shipdate) = 9 OR l_quantity = 12 THEN CAST(l_shipdate AS DATE) "
    "WHEN l_quantity = 11 AND day(l_shipdate) <= 12 THEN make_date(year(l_shipdate), day(l_shipdate), month(l_shipdate)) "
    "WHEN l_quantity = 11 THEN CAST(l_shipdate AS DATE) "
    "WHEN l_linenumber = 4 OR l_linenumber = 5 AND day(l_shipdate) <= 12 THEN NULL "
    "ELSE CAST(l_shipdate AS DATE) END AS ship_date FROM lineitem",
)
_TIME = "concat(date_format({0}, '{1}'), substring(cast(ts AS string), 11, 9))"
_HOUR = "cast(substring(cast(ts AS string), 12, 2) AS int)"
_TWELVE = (
    f"concat(date_format(cast(ts AS date), 'MM/dd/yyyy'), ' ', CASE WHEN {_HOUR} % 12 = 0 THEN 12 ELSE {_HOUR} % 12 END, "
    f"substring(cast(ts AS string), 14, 3), CASE WHEN {_HOUR} < 12 THEN ' AM' ELSE ' PM' END)"
)
add_given(
    "c13_parse_timestamp",
    "events",
    lambda events: events.select(
        "event_id",
        parsing.parse_timestamp(
            expr(
                f"CASE WHEN user_id % 5 = 0 THEN {_TWELVE} WHEN user_id % 5 = 1 THEN {_TIME.format('cast(ts AS date)', 'dd-MMM-yyyy')}"
                f" WHEN user_id % 5 = 2 THEN {_TIME.format('cast(ts AS date)', 'yyyy/MM/dd')}"
                f" WHEN event_type = 'view' THEN {_TIME.format('cast(ts AS date)', 'MM/dd/yyyy')}"
                f" WHEN event_type = 'click' THEN {_TIME.format('cast(ts AS date)', 'MMM dd, yyyy')}"
                " WHEN event_type = 'error' THEN 'late' ELSE cast(ts AS string) END"
            )
        ).alias("parsed_ts"),
    ),
    "SELECT event_id, CASE WHEN user_id % 5 = 0 THEN date_trunc('minute', ts) WHEN user_id % 5 IN (1, 2) THEN date_trunc('second', ts) "
    "WHEN event_type IN ('view', 'click') THEN date_trunc('second', ts) WHEN event_type <> 'error' THEN ts END "
    "AS parsed_ts FROM events",
)
add_given(
    "c14_parse_bool",
    "lineitem",
    lambda lines: lines.select(
        *LINE,
        parsing.parse_bool(
            expr("element_at(array(' TRUE', 'Yes', '1', 't', 'no', 'on', null), l_linenumber)")
        ).alias("flag"),
    ),
    f"{LINE_SQL}, l_linenumber <= 4 AS flag FROM lineitem",
)
add_given(
    "c15_parse_integer",
    "part",
    lambda part: part.select(
        "p_partkey",
        parsing.parse_integer(
            expr(
                "CASE WHEN p_type = 'SMALL' THEN 'few' WHEN p_size % 5 = 0 THEN concat(p_size, '.0') WHEN p_size % 5 = 1 THEN concat(p_size, 'e2')"
                " WHEN p_size % 5 = 2 THEN concat('30000000', p_size) WHEN p_size = 3 THEN '12.5' ELSE concat(' ', p_size) END"
            )
        ).alias("size"),
    ),
    "SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN NULL WHEN p_size % 5 = 1 THEN p_size * 100 "
    "WHEN p_size % 5 = 2 THEN CAST('30000000' || p_size AS BIGINT) WHEN p_size = 3 THEN NULL ELSE p_size END AS size FROM part",
)
add_given(
    "c16_month_start",
    "orders",
    lambda orders: orders.select("o_orderkey", numbers.month_start(col("o_orderdate").cast("date")).alias("month_start_date")),
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start_date FROM orders",
)
add_given(
    "c17_safe_divide",
    "customer",
    lambda customers: customers.select("c_custkey", numbers.safe_divide(col("c_acctbal"), col("c_nationkey")).alias("quotient")),
    "SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 0.0 ELSE c_acctbal / c_nationkey END AS quotient FROM customer",
)
add_given(
    "c18_date_key",
    "orders",
    lambda orders: orders.select("o_orderkey", numbers.date_key(col("o_orderdate")).alias("date_key")),
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders",
)
_STATE_SQL = (
    "CASE WHEN n_nationkey < 14 THEN (['NY','MA','PA','GA','FL','TX','IL','OH','MN','CO','AZ','CA','WA','INT'])[n_nationkey + 1] END"
)
add_given(
    "c19_region_of_state",
    "nation",
    lambda nations: nations.select("n_nationkey", text.region_of_state(expr(STATE_TEXT)).alias("region")),
    f"SELECT n_nationkey, {region(f'({_STATE_SQL})')} AS region FROM nation",
)
add_given(
    "c20_hour_of_day",
    "events",
    lambda events: events.select("event_id", F.hour("ts").alias("hour")),
    "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events",
)
add_given(
    "c21_elapsed_time",
    "events",
    lambda events: events.select(
        "event_id",
        numbers.elapsed(col("ts").cast("date").cast("timestamp_ntz"), col("ts"), 60).alias("minutes"),
        numbers.elapsed(col("ts").cast("date").cast("timestamp_ntz"), col("ts"), 3600).alias("hours"),
    ),
    "SELECT event_id, date_diff('microsecond', date_trunc('day', ts), ts) / 60000000 AS minutes, "
    "date_diff('microsecond', date_trunc('day', ts), ts) / 3600000000 AS hours FROM events",
)
add_given(
    "c22_round_half_even",
    "part",
    lambda part: part.select("p_partkey", numbers.whole_units((col("p_size") / 2).cast("decimal(18,2)")).alias("rounded")),
    "SELECT p_partkey, round_even(p_size / 2, 0) AS rounded FROM part",
)
add_given(
    "c23_round_decimal_places",
    "lineitem",
    lambda lines: lines.groupBy("l_partkey")
    .agg(
        F.sum(col("l_extendedprice").cast("decimal(18,2)")).alias("value"),
        F.count("*").alias("lines"),
        F.count_if(col("l_returnflag") == "R").alias("returned"),
    )
    .select(
        "l_partkey",
        numbers.rounded_ratio(col("value"), col("lines"), 2).alias("mean_price"),
        numbers.rounded_ratio(col("returned"), col("lines"), 4).alias("return_rate"),
    ),
    f"SELECT l_partkey, {ratio('sum(CAST(l_extendedprice AS DECIMAL(18,2)))', 'count(*)', 2)} AS mean_price, "
    f"{ratio('count(*) FILTER (l_returnflag = $$R$$)', 'count(*)', 4)} AS return_rate FROM lineitem GROUP BY l_partkey",
)
add_given(
    "c24_zero_padded_ids",
    "orders",
    lambda orders: orders.select(
        text.numbered_id("DQI", col("o_orderkey")).alias("issue_id"), text.numbered_id("ANOM", col("o_orderkey")).alias("anomaly_id")
    ),
    "SELECT 'DQI' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS issue_id, "
    "'ANOM' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS anomaly_id FROM orders",
)
add_given(
    "c25_fired_rule_names",
    "lineitem",
    lambda lines: lines.select(
        *LINE,
        (col("l_quantity") > 25).alias("large"),
        (col("l_discount") > 0.05).alias("reduced"),
        (col("l_tax") > 0.04).alias("taxed"),
    ).select(*LINE, text.fired_names(["large", "reduced", "taxed"]).alias("fired")),
    f"{LINE_SQL}, concat_ws(', ', CASE WHEN l_quantity > 25 THEN 'large' END, CASE WHEN l_discount > 0.05 THEN 'reduced' END, "
    "CASE WHEN l_tax > 0.04 THEN 'taxed' END) AS fired FROM lineitem",
)
add_given(
    "c26_location_business_key",
    "nation",
    lambda nations: nations.select(
        "n_nationkey", text.location_business_key(col("n_name"), expr("nullif(n_regionkey, 0)").cast("string")).alias("place")
    ),
    "SELECT n_nationkey, n_name || '|' || CASE WHEN n_regionkey = 0 THEN 'None' ELSE CAST(n_regionkey AS VARCHAR) END AS place "
    "FROM nation",
)
add_given(
    "c27_calendar_attributes",
    "orders",
    lambda orders: orders.select(col("o_orderdate").cast("date").alias("day"))
    .distinct()
    .select(
        "day",
        F.year("day").alias("year"),
        numbers.quarter_label(col("day")).alias("quarter"),
        F.month("day").alias("month_number"),
        F.date_format("day", "MMMM").alias("month_name"),
        F.weekofyear("day").alias("week_number"),
        F.date_format("day", "EEEE").alias("day_of_week"),
        numbers.is_weekend(col("day")).alias("is_weekend"),
    ),
    "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS year, 'Q' || quarter(o_orderdate) AS quarter, "
    "CAST(month(o_orderdate) AS INTEGER) AS month_number, monthname(o_orderdate) AS month_name, "
    "CAST(weekofyear(o_orderdate) AS INTEGER) AS week_number, dayname(o_orderdate) AS day_of_week, "
    "isodow(o_orderdate) >= 6 AS is_weekend FROM orders",
)
add_given(
    "c28_labels",
    "customer",
    lambda customers: customers.select(
        "c_custkey",
        text.pretty_label(expr("concat('account_balance_', lower(c_mktsegment))")).alias("label"),
        text.currency_label(col("c_acctbal").cast("decimal(18,2)")).alias("balance"),
        text.percent_label(col("c_nationkey") / 8).alias("share"),
    ),
    "SELECT c_custkey, 'Account Balance ' || c_mktsegment[1] || lower(c_mktsegment[2:]) AS label, "
    "'$' || format('{:,}', CAST(round_even(CAST(c_acctbal AS DECIMAL(18,2)), 0) AS BIGINT)) AS balance, "
    "format('{:.1f}%', c_nationkey * 12.5) AS share FROM customer",
)

TRANSACTION_COLUMNS = (
    "source_row_number, transaction_id, account_id, customer_id, merchant_id, transaction_date, transaction_timestamp, "
    "CAST(transaction_amount AS DOUBLE) AS transaction_amount, transaction_category, transaction_type, transaction_status, "
    "transaction_channel, device_id, branch_id, city, state, currency, debit_credit_indicator, description, is_international, "
    "is_recurring, CAST(balance_after_transaction AS DOUBLE) AS balance_after_transaction, synthetic_anomaly_flag"
)
add_star("cl1_clean_customers", lambda tables: tables["customers"], over_clean("SELECT * FROM customers"))
add_star(
    "cl2_clean_accounts",
    lambda tables: tables["accounts"],
    over_clean(
        "SELECT * REPLACE (CAST(current_balance AS DOUBLE) AS current_balance, CAST(credit_limit AS DOUBLE) AS credit_limit) FROM accounts"
    ),
)
add_star(
    "cl3_clean_transactions", lambda tables: tables["transactions"], over_clean(f"SELECT {TRANSACTION_COLUMNS} FROM t")
)
add_star("cl4_clean_merchants", lambda tables: tables["merchants"], over_clean("SELECT * FROM merchants"))
add_star("cl4_clean_categories", lambda tables: tables["transaction_categories"], over_clean("SELECT * FROM categories"))
add_star("cl4_clean_branches", lambda tables: tables["branches"], over_clean("SELECT * FROM branches"))
add_star("cl4_clean_devices", lambda tables: tables["devices"], over_clean("SELECT * FROM devices"))
add_star(
    "cl4_clean_segments",
    lambda tables: tables["customer_segments"],
    "SELECT row_number() OVER (ORDER BY c_mktsegment) AS source_row_number, "
    "'SEG' || row_number() OVER (ORDER BY c_mktsegment) AS segment_id, c_mktsegment[1] || lower(c_mktsegment[2:]) AS segment_name, "
    "'1.0' AS spend_multiplier, '0.8' AS digital_preference FROM (SELECT DISTINCT c_mktsegment FROM customer)",
)
add_given(
    "d04_dim_date",
    "orders",
    lambda orders: build_dim_date(orders.sparkSession, "1995-01-01", "2001-12-31").join(
        orders.select(col("o_orderdate").cast("date").alias("date")).groupBy("date").agg(F.count("*").alias("orders")), "date", "left"
    ),
    "SELECT date, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, "
    "CAST(year(date) AS INTEGER) AS year, 'Q' || quarter(date) AS quarter, "
    "CAST(month(date) AS INTEGER) AS month_number, monthname(date) AS month_name, "
    "CAST(date_trunc('month', date) AS DATE) AS month_start_date, CAST(weekofyear(date) AS INTEGER) AS week_number, "
    "dayname(date) AS day_of_week, isodow(date) >= 6 AS is_weekend, orders FROM "
    "(SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS date) LEFT JOIN "
    "(SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1) USING (date)",
)
