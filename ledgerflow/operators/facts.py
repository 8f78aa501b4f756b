"""Fact tables of the star model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import numbers, text
from ledgerflow.functions.parsing import MONEY
from ledgerflow.operators.numbering import lookup_key, number_by_position
from ledgerflow.settings import Settings

# (dimension, surrogate key, column of the transaction, business key of the dimension)
LOOKUPS = (
    ("dim_customer", "customer_key", "customer_id", "customer_id"),
    ("dim_account", "account_key", "account_id", "account_id"),
    ("dim_merchant", "merchant_key", "merchant_id", "merchant_id"),
    ("dim_transaction_category", "transaction_category_key", "transaction_category", "transaction_category"),
    ("dim_channel", "channel_key", "transaction_channel", "transaction_channel"),
    ("dim_location", "location_key", "location_business_key", "location_business_key"),
    ("dim_device", "device_key", "device_id", "device_id"),
    ("dim_branch", "branch_key", "branch_id", "branch_id"),
    ("dim_transaction_status", "transaction_status_key", "transaction_status", "transaction_status"),
)

FACT_COLUMNS = (
    "transaction_key",
    "transaction_id",
    "date_key",
    *[key for _, key, _, _ in LOOKUPS],
    "source_row_number",
    "account_id",
    "customer_id",
    "merchant_id",
    "transaction_timestamp",
    "transaction_amount",
    "signed_transaction_amount",
    "debit_amount",
    "credit_amount",
    "approved_amount",
    "transaction_count",
    "is_approved",
    "is_declined",
    "is_pending",
    "is_reversed",
    "is_international",
    "is_recurring",
    "debit_credit_indicator",
    "balance_after_transaction",
)

FLAGGED_BY_STATUS = {
    "is_approved": "Approved",
    "is_declined": "Declined",
    "is_pending": "Pending",
    "is_reversed": "Reversed",
}


def _amount_if(column: str, value: str) -> Column:
    return F.when(F.col(column) == value, F.col("transaction_amount")).otherwise(F.lit(0).cast(MONEY))


def amount_columns() -> dict[str, Column]:
    """Signed, one-sided and approved amounts. Every indicator but Credit counts as an outflow."""
    amount = F.col("transaction_amount")
    signed = F.when(F.col("debit_credit_indicator") == "Credit", amount).otherwise(-amount)
    return {
        "signed_transaction_amount": signed.cast(MONEY),
        "debit_amount": _amount_if("debit_credit_indicator", "Debit"),
        "credit_amount": _amount_if("debit_credit_indicator", "Credit"),
        "approved_amount": _amount_if("transaction_status", "Approved"),
        "transaction_count": F.lit(1),
    }


def status_columns() -> dict[str, Column]:
    status = F.col("transaction_status")
    return {flag: F.coalesce(status == name, F.lit(False)) for flag, name in FLAGGED_BY_STATUS.items()}


def with_business_keys(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns(
        {
            "date_key": numbers.date_key(F.col("transaction_date")),
            "location_business_key": text.location_business_key(F.col("city"), F.col("state")),
        }
    )


def lookup_dimension(frame: DataFrame, dimensions: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Adds one of the nine surrogate keys by its business column."""
    name, _, column, business_key = next(row for row in LOOKUPS if row[1] == key)
    dimension = dimensions[name]
    if name == "dim_location":
        # A missing city and the text "None" share a business key; the later place wins.
        dimension = dimension.groupBy(business_key).agg(F.max(key).alias(key))
    return lookup_key(frame, dimension, key, column, business_key)


def resolve_keys(transactions: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Adds date key and the nine surrogate keys. Keys that the check has found are taken over, 0 where there is none."""
    resolved = with_business_keys(transactions)
    for _, key, _, _ in LOOKUPS:
        if key in transactions.columns:
            resolved = resolved.withColumn(key, F.coalesce(key, F.lit(0).cast("bigint")))
        else:
            resolved = lookup_dimension(resolved, dimensions, key)
    return resolved


def in_cents(valid: DataFrame) -> DataFrame:
    return valid.withColumns({name: F.round(name, 2).cast(MONEY) for name in ("transaction_amount", "balance_after_transaction")})


def measured(transactions: DataFrame) -> DataFrame:
    """Adds amounts and flags to transactions whose amounts are in cents."""
    return transactions.withColumns({**amount_columns(), **status_columns()})


def build_fact_transaction(valid: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Valid transactions with keys, amounts in cents and flags, numbered in source order unless they have their key."""
    numbered = in_cents(valid)
    if "transaction_key" not in valid.columns:
        numbered = number_by_position(numbered, "transaction_key", "source_row_number")
    return measured(resolve_keys(numbered, dimensions)).select(*FACT_COLUMNS)


def monthly_totals(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Customer-month totals; a transaction without calendar day goes to a null month."""
    totals = (
        fact.join(dim_date.select("date_key", "month_start_date"), "date_key", "left")
        .groupBy("customer_key", "month_start_date")
        .agg(
            F.count("transaction_id").alias("transaction_count"),
            F.count_if("is_approved").alias("approved_transaction_count"),
            F.count_if("is_declined").alias("declined_transaction_count"),
            F.sum("debit_amount").alias("debit_transaction_value"),
            F.sum("credit_amount").alias("credit_transaction_value"),
            F.sum("signed_transaction_amount").alias("net_transaction_flow"),
            F.sum("transaction_amount").alias("total"),
            F.count("transaction_amount").alias("amounts"),
            F.count_if("is_recurring").alias("recurring_transaction_count"),
            F.count_if("is_international").alias("international_transaction_count"),
        )
    )
    mean = numbers.blank_divide(F.col("total"), F.col("amounts"))
    return totals.withColumn("average_transaction_amount", mean)


def calculate_customer_monthly_summary(fact: DataFrame, dim_date: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Customer-month totals with a key in (customer, month) order.

    A customer has one row per calendar month, so numbering by customer key is bounded. ``totals`` may hold the
    ``monthly_totals`` as a stored table: numbering reads its input twice."""
    totals = monthly_totals(fact, dim_date) if totals is None else totals
    numbered = number_by_position(
        totals,
        "customer_monthly_summary_key",
        "customer_key",
        tie_break=[F.col("month_start_date").asc_nulls_last()],
        bits=10,
    )
    return numbered.select(
        "customer_monthly_summary_key",
        "customer_key",
        "month_start_date",
        "transaction_count",
        "approved_transaction_count",
        "declined_transaction_count",
        "debit_transaction_value",
        "credit_transaction_value",
        "net_transaction_flow",
        "average_transaction_amount",
        "recurring_transaction_count",
        "international_transaction_count",
        numbers.date_key(F.col("month_start_date")).alias("month_date_key"),
    )


def daily_balances(fact: DataFrame) -> DataFrame:
    """Balance after the last approved transaction of each account and day; source order decides equal timestamps."""
    last = F.max_by("balance_after_transaction", F.struct("transaction_timestamp", "source_row_number"))
    return fact.where("is_approved").groupBy("account_key", "date_key").agg(last.alias("ending_balance"))


def build_account_daily_balance(fact: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """The daily balances with a key; one row per account and day is numbered. ``daily`` may hold them as a stored
    table: numbering reads its input twice."""
    daily = daily_balances(fact) if daily is None else daily
    return number_by_position(daily, "account_daily_balance_key", "account_key", tie_break=["date_key"], bits=8)


def build_fact_data_quality_issue(issues: DataFrame) -> DataFrame:
    """The issue log with a whole-number key, taken from the issue id's own number."""
    if "data_quality_issue_key" in issues.columns:
        return issues
    number = F.regexp_extract("issue_id", r"(\d+)$", 1).cast("bigint")
    return issues.select(number.alias("data_quality_issue_key"), *issues.columns)


def attach_transaction_keys(flags: DataFrame, fact: DataFrame) -> DataFrame:
    """Anomaly flags with the key of their transaction, for flags that do not carry it."""
    if "transaction_key" in flags.columns:
        return flags
    keys = fact.select("transaction_key", "transaction_id")
    others = [name for name in flags.columns if name != "anomaly_id"]
    return flags.join(keys, "transaction_id", "left").select("anomaly_id", "transaction_key", *others)


def build_model_tables(
    tables: Mapping[str, DataFrame], dimensions: Mapping[str, DataFrame], settings: Settings
) -> dict[str, DataFrame]:
    """Ten dimensions and the four facts that need no review rules."""
    fact = build_fact_transaction(tables["valid_transactions"], dimensions)
    return {
        **dimensions,
        "fact_transaction": fact,
        "fact_account_daily_balance": build_account_daily_balance(fact),
        "fact_customer_monthly_summary": calculate_customer_monthly_summary(fact, dimensions["dim_date"]),
        "fact_data_quality_issue": build_fact_data_quality_issue(tables["data_quality_issues"]),
    }
