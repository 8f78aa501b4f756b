"""Fourteen checks that totals survive the way from raw rows to the star model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.parsing import parse_plain_amount
from ledgerflow.plans.rollup import one_row, per_key, totals_by_key
from ledgerflow.settings import Settings

TOLERANCE = 0.01


# The checks in report order, with their notes.
CHECK_NOTES = {
    "Raw transaction count versus valid processed count": "Difference represents rejected records with blocking validation issues.",
    "Raw transaction count versus valid plus rejected count": "Valid and rejected rows should reconcile to raw transaction rows.",
    "Raw transaction amount versus processed transaction amount": "Difference is expected when invalid records are rejected.",
    "Approved transaction total versus fact-table total": "Approved transaction value should match between validated data and fact table.",
    "Transactions without valid accounts": "Count of relationship issues found during validation.",
    "Transactions without valid customers": "Count of relationship issues found during validation.",
    "Accounts without valid customers": "Count of relationship issues found during validation.",
    "Customers without accounts": "Synthetic customers can exist without active accounts.",
    "Merchant transaction totals before and after transformation": "Merchant totals should match after fact loading.",
    "Category totals before and after transformation": "Category totals should match after fact loading.",
    "Daily transaction totals before and after loading": "Daily row counts should match after date-key assignment.",
    "Transaction totals versus customer monthly summaries": "Monthly summaries should roll up to the fact transaction count.",
    "Debit value versus customer monthly summaries": "Monthly summaries should roll up to debit transaction value.",
    "Database row counts versus exported reporting tables": "Fact table and processed export row counts should match before SQLite load.",
}


@dataclass(frozen=True)
class Check:
    """One comparison; without ``status`` the difference decides."""

    source: Column
    target: Column
    status: Column | None = None


def status_of(difference: Column) -> Column:
    return F.when(F.abs(difference) <= TOLERANCE, "Passed").otherwise("Warning")


def check_row(name: str, notes: str, check: Check) -> Column:
    source, target = check.source.cast("double"), check.target.cast("double")
    difference = source - target
    status = status_of(difference) if check.status is None else check.status
    return F.struct(
        F.lit(name).alias("reconciliation_name"),
        source.alias("source_value"),
        target.alias("target_value"),
        F.round(difference, 4).alias("difference"),
        status.alias("status"),
        F.lit(notes).alias("notes"),
    )


def calculate_reconciliation_totals(fact: DataFrame, monthly: DataFrame) -> DataFrame:
    """Row count and debit value of the fact and of the monthly summary, in one row."""
    return _totals(per_key(fact, [], ["rows", "debit_transaction_value"]), monthly)


def _totals(of_rows: DataFrame, monthly: DataFrame) -> DataFrame:
    of_fact = of_rows.select(
        F.col("rows").cast("double").alias("fact_transaction_count"),
        F.coalesce(F.col("debit_transaction_value").cast("double"), F.lit(0.0)).alias("fact_debit_value"),
    )
    of_months = monthly.agg(
        F.coalesce(F.sum("transaction_count").cast("double"), F.lit(0.0)).alias("monthly_summary_transaction_count"),
        F.coalesce(F.sum("debit_transaction_value").cast("double"), F.lit(0.0)).alias("monthly_debit_value"),
    )
    names = [
        "fact_transaction_count",
        "monthly_summary_transaction_count",
        "fact_debit_value",
        "monthly_debit_value",
    ]
    return one_row([of_fact, of_months]).select(*names)


def _zero_if_none(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def _amount_where(condition: Column) -> Column:
    return _zero_if_none(F.sum(F.when(condition, F.col("transaction_amount"))))


def reconciliation_inputs(
    raw_transactions: DataFrame, validated: Mapping[str, DataFrame], model: Mapping[str, DataFrame]
) -> DataFrame:
    """Every compared total in one row: one aggregate per table, each a single pass. The fact's totals come from the stored
    rollups where the model has them."""
    raw = raw_transactions.agg(
        F.count("*").alias("raw_rows"),
        _zero_if_none(F.sum(parse_plain_amount(F.col("transaction_amount")))).alias("raw_amount"),
    )
    amount = F.col("transaction_amount")
    valid = validated["valid_transactions"].agg(
        F.count("*").alias("valid_rows"),
        _zero_if_none(F.sum(amount)).alias("valid_amount"),
        _amount_where(F.col("transaction_status") == "Approved").alias("approved_amount"),
        _amount_where(F.col("merchant_id").isNotNull()).alias("merchant_amount"),
        _amount_where(F.col("transaction_category").isNotNull()).alias("category_amount"),
        F.count_if(F.col("transaction_date").isNotNull() & F.col("transaction_id").isNotNull()).alias("daily_rows"),
    )
    rejected = validated["rejected_transactions"].agg(F.count("*").alias("rejected_rows"))
    of_rows = totals_by_key(model, [], ["rows", "debit_transaction_value", "approved_transaction_value", "total_transaction_value"])
    fact = of_rows.select(
        _zero_if_none(F.col("approved_transaction_value")).alias("fact_approved"),
        _zero_if_none(F.col("total_transaction_value")).alias("fact_amount"),
    )
    days = totals_by_key(model, ["date_key"], ["transaction_count"]).where("date_key is not null")
    daily = days.agg(_zero_if_none(F.sum("transaction_count")).alias("fact_daily_rows"))
    rule = F.col("rule_name")
    issues = validated["data_quality_issues"].agg(
        *[
            F.count_if(rule == name).alias(name)
            for name in ("account_id_exists", "customer_id_exists", "account_customer_exists")
        ]
    )
    holders = validated["accounts"].select("customer_id").distinct()
    idle = (
        validated["customers"]
        .select("customer_id")
        .where("customer_id is not null")
        .distinct()
        .join(holders, "customer_id", "left_anti")
        .agg(F.count("*").alias("customers_without_accounts"))
    )
    totals = _totals(of_rows, model["fact_customer_monthly_summary"])
    return one_row([raw, valid, rejected, fact, daily, issues, idle, totals])


def checks(settings: Settings) -> list[Check]:
    """The comparisons, in the order of ``CHECK_NOTES``."""
    col, none = F.col, F.lit(0)
    enough = F.when(col("valid_rows") > settings.minimum_valid_rows, "Passed").otherwise("Failed")

    def warn_if(found: str) -> Column:
        return F.when(col(found) > 0, "Warning").otherwise("Passed")

    def expect_none(found: str) -> Check:
        return Check(col(found), none, warn_if(found))

    return [
        Check(col("raw_rows"), col("valid_rows"), enough),
        Check(col("raw_rows"), col("valid_rows") + col("rejected_rows")),
        Check(col("raw_amount"), col("valid_amount"), warn_if("rejected_rows")),
        Check(col("approved_amount"), col("fact_approved")),
        expect_none("account_id_exists"),
        expect_none("customer_id_exists"),
        expect_none("account_customer_exists"),
        expect_none("customers_without_accounts"),
        Check(col("merchant_amount"), col("fact_amount")),
        Check(col("category_amount"), col("fact_amount")),
        Check(col("daily_rows"), col("fact_daily_rows")),
        Check(col("fact_transaction_count"), col("monthly_summary_transaction_count")),
        Check(col("fact_debit_value"), col("monthly_debit_value")),
        Check(col("fact_transaction_count"), col("valid_rows")),
    ]


def build_reconciliation_report(
    raw: Mapping[str, DataFrame],
    validated: Mapping[str, DataFrame],
    model: Mapping[str, DataFrame],
    settings: Settings,
) -> DataFrame:
    inputs = reconciliation_inputs(raw["transactions"], validated, model)
    rows = [check_row(name, notes, check) for (name, notes), check in zip(CHECK_NOTES.items(), checks(settings), strict=True)]
    return inputs.select(F.inline(F.array(*rows)))
