"""Small cleaned tables: one valid row each, with changes on demand."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

# The columns of the cleaned tables and one valid row of each.
SCHEMAS = {
    "customers": "source_row_number bigint, customer_id string, customer_display_name string, age_group string, city string, state string, "
    "customer_segment string, account_tenure_months int, join_date date, preferred_channel string, risk_tier string, income_band string",
    "accounts": "source_row_number bigint, account_id string, customer_id string, account_type string, open_date date, account_status string, "
    "close_date date, current_balance decimal(18,2), credit_limit decimal(18,2), branch_id string, currency string, product_tier string",
    "transactions": "source_row_number bigint, transaction_id string, account_id string, customer_id string, merchant_id string, "
    "transaction_date date, transaction_timestamp timestamp_ntz, transaction_amount decimal(18,2), transaction_category string, "
    "transaction_type string, transaction_status string, transaction_channel string, device_id string, branch_id string, city string, "
    "state string, currency string, debit_credit_indicator string, description string, is_international boolean, is_recurring boolean, "
    "balance_after_transaction decimal(18,2), synthetic_anomaly_flag boolean",
    "merchants": "source_row_number bigint, merchant_id string, merchant_name string, merchant_category string, city string, state string, "
    "region string, is_online_only boolean",
    "transaction_categories": "source_row_number bigint, category_id string, transaction_category string, category_group string",
    "branches": "source_row_number bigint, branch_id string, branch_name string, city string, state string, region string, branch_type string",
    "devices": "source_row_number bigint, device_id string, customer_id string, device_type string, operating_system string, trusted_device boolean",
    "customer_segments": "source_row_number bigint, segment_id string, segment_name string, spend_multiplier string, digital_preference string",
}

ROWS = {
    "customers": dict(
        source_row_number=1, customer_id="CUST000001", customer_display_name="Synthetic Customer", age_group="25-34", city="Dallas",
        state="TX", customer_segment="Students", account_tenure_months=12, join_date=date(2023, 1, 1), preferred_channel="Mobile",
        risk_tier="Low", income_band="$40k-$75k"),
    "accounts": dict(
        source_row_number=1, account_id="ACC000001", customer_id="CUST000001", account_type="Checking", open_date=date(2024, 1, 1),
        account_status="Active", close_date=None, current_balance=Decimal("500.00"), credit_limit=None, branch_id="BR001", currency="USD",
        product_tier="Standard"),
    "transactions": dict(
        source_row_number=1, transaction_id="TXN00000001", account_id="ACC000001", customer_id="CUST000001", merchant_id="MER0001",
        transaction_date=date(2024, 2, 1), transaction_timestamp=datetime(2024, 2, 1, 10), transaction_amount=Decimal("100.00"),
        transaction_category="Groceries", transaction_type="Card Purchase", transaction_status="Approved", transaction_channel="Mobile",
        device_id="DEV00001", branch_id=None, city="Dallas", state="TX", currency="USD", debit_credit_indicator="Debit",
        description="Card Purchase - Groceries", is_international=False, is_recurring=False, balance_after_transaction=Decimal("400.00"),
        synthetic_anomaly_flag=False),
    "merchants": dict(
        source_row_number=1, merchant_id="MER0001", merchant_name="Merchant", merchant_category="Groceries", city="Dallas", state="TX",
        region="South", is_online_only=False),
    "transaction_categories": dict(source_row_number=1, category_id="CAT01", transaction_category="Groceries", category_group="Spending"),
    "branches": dict(
        source_row_number=1, branch_id="BR001", branch_name="Dallas Branch", city="Dallas", state="TX", region="South", branch_type="Retail"),
    "devices": dict(
        source_row_number=1, device_id="DEV00001", customer_id="CUST000001", device_type="Mobile App", operating_system="iOS",
        trusted_device=True),
    "customer_segments": dict(
        source_row_number=1, segment_id="SEG01", segment_name="Students", spend_multiplier="1.0", digital_preference="0.8"),
}


def table(spark, name, *changes):
    """The table with one row per change set; rows are numbered unless a change numbers them."""
    rows = [{**ROWS[name], "source_row_number": at, **change} for at, change in enumerate(changes or ({},), 1)]
    columns = [part.split()[0] for part in SCHEMAS[name].split(", ")]
    # One partition: a fixture of a few rows.
    return spark.createDataFrame([tuple(row[column] for column in columns) for row in rows], SCHEMAS[name]).coalesce(1)


def tables(spark, **changed):
    return {name: table(spark, name, *changed.get(name, ())) for name in SCHEMAS}


def amounts(frame, column):
    return [row[0] for row in frame.select(F.col(column).cast("double")).collect()]
