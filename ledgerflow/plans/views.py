"""The fifteen reporting views, as functions of the star tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import blank_divide, rounded_ratio
from ledgerflow.plans.rollup import Tables, additive, one_row, per_attribute, totals_by_key, with_attributes

COUNT, VALUE, APPROVED = "rows", "total_transaction_value", "approved_transaction_value"


def _mean(total: str = VALUE, count: str = COUNT) -> Column:
    return rounded_ratio(F.col(total), F.col(count), 2).alias("average_transaction_amount")


def _rate(part: str, name: str, count: str = COUNT) -> Column:
    return rounded_ratio(F.col(part), F.col(count), 4).alias(name)


def _count() -> Column:
    return F.col(COUNT).alias("transaction_count")


def transaction_overview(tables: Tables) -> DataFrame:
    attributes = {
        "dim_date": ["date"],
        "dim_customer": ["customer_id", "customer_display_name", "customer_segment", "age_group"],
        "dim_account": ["account_id", "account_type"],
        "dim_merchant": ["merchant_id", "merchant_name"],
        "dim_transaction_category": ["transaction_category"],
        "dim_transaction_status": ["transaction_status"],
        "dim_channel": ["transaction_channel"],
        "dim_location": ["city", "state", "region"],
    }
    fact = tables["fact_transaction"].drop("customer_id", "account_id", "merchant_id")
    return with_attributes(fact, tables, attributes, "left").select(
        "transaction_id",
        F.col("date").alias("transaction_date"),
        "transaction_timestamp",
        "customer_id",
        "customer_display_name",
        "customer_segment",
        "age_group",
        "account_id",
        "account_type",
        "merchant_id",
        "merchant_name",
        "transaction_category",
        "transaction_status",
        "transaction_channel",
        "city",
        "state",
        "region",
        "transaction_amount",
        "signed_transaction_amount",
        "debit_amount",
        "credit_amount",
        "debit_credit_indicator",
        "is_international",
        "is_recurring",
        "balance_after_transaction",
    )


def daily_transaction_trends(tables: Tables) -> DataFrame:
    totals = per_attribute(tables, {"dim_date": ["date", "day_of_week", "is_weekend"]}, [COUNT, VALUE, APPROVED])
    return totals.select(
        F.col("date").alias("transaction_date"),
        "day_of_week",
        "is_weekend",
        _count(),
        VALUE,
        APPROVED,
        blank_divide(F.col(VALUE), F.col(COUNT)).alias("average_transaction_amount"),
    )


def monthly_transaction_trends(tables: Tables) -> DataFrame:
    months = ["month_start_date", "year", "month_number"]
    totals = per_attribute(tables, {"dim_date": months}, [COUNT, VALUE, APPROVED, "net_transaction_flow"])
    return totals.select(*months, _count(), VALUE, APPROVED, "net_transaction_flow", _mean()).orderBy("month_start_date")


def category_performance(tables: Tables) -> DataFrame:
    category = {"dim_transaction_category": ["transaction_category"]}
    totals = per_attribute(tables, category, [COUNT, VALUE, APPROVED, "declined_count"])
    return totals.select(
        "transaction_category", _count(), VALUE, APPROVED, _mean(), _rate("declined_count", "decline_rate")
    )


def customer_spending_summary(tables: Tables) -> DataFrame:
    """Totals per customer key are the result: a customer id has one key."""
    columns = ["customer_id", "customer_display_name", "customer_segment", "age_group"]
    flows = ["debit_transaction_value", "credit_transaction_value", "net_transaction_flow"]
    totals = totals_by_key(tables, ["customer_key"], [COUNT, "transaction_count", VALUE, *flows])
    described = with_attributes(totals, tables, {"dim_customer": columns})
    return described.select(*columns, "transaction_count", *flows, _mean())


def merchant_performance(tables: Tables) -> DataFrame:
    columns = ["merchant_id", "merchant_name", "merchant_category"]
    totals = totals_by_key(tables, ["merchant_key"], [COUNT, VALUE])
    return with_attributes(totals, tables, {"dim_merchant": columns}).select(*columns, _count(), VALUE, _mean())


def channel_performance(tables: Tables) -> DataFrame:
    channel = {"dim_channel": ["transaction_channel"]}
    totals = per_attribute(tables, channel, [COUNT, VALUE, "approved_count", "declined_count"])
    return totals.select(
        "transaction_channel",
        _count(),
        VALUE,
        _rate("approved_count", "approval_rate"),
        _rate("declined_count", "decline_rate"),
    )


def transaction_status_summary(tables: Tables) -> DataFrame:
    """Shares are of the whole fact, also of rows whose status key has no dimension row."""
    totals = totals_by_key(tables, ["transaction_status_key"], [COUNT, VALUE])
    totals = totals.withColumn("all_rows", F.sum(COUNT).over(Window.partitionBy()))
    status = {"dim_transaction_status": ["transaction_status"]}
    described = with_attributes(totals, tables, status).groupBy("transaction_status", "all_rows")
    summed = described.agg(F.sum(COUNT).alias(COUNT), F.sum(VALUE).alias(VALUE))
    return summed.select("transaction_status", _count(), VALUE, _rate(COUNT, "transaction_share", "all_rows"))


def account_activity(tables: Tables) -> DataFrame:
    columns = ["account_id", "account_type", "account_status"]
    on_calendar = with_attributes(
        tables["fact_transaction"].select("account_key", "date_key", "transaction_id", "transaction_amount", "signed_transaction_amount"),
        tables,
        {"dim_date": ["date"]},
    )
    totals = on_calendar.groupBy("account_key").agg(
        *[total.alias(name) for name, total in additive("transaction_count", VALUE, "net_transaction_flow").items()],
        F.min("date").alias("first_transaction_date"),
        F.max("date").alias("last_transaction_date"),
    )
    described = with_attributes(totals, tables, {"dim_account": columns})
    return described.select(
        *columns, "transaction_count", VALUE, "net_transaction_flow", "first_transaction_date", "last_transaction_date"
    )


def customer_segment_analysis(tables: Tables) -> DataFrame:
    names = [COUNT, "transaction_count", "debit_transaction_value", VALUE]
    totals = totals_by_key(tables, ["customer_key"], names)
    described = with_attributes(totals, tables, {"dim_customer": ["customer_id", "customer_segment"]})
    segments = described.groupBy("customer_segment").agg(
        F.count("customer_id").alias("active_customer_count"), *[F.sum(name).alias(name) for name in names]
    )
    return segments.select(
        "customer_segment",
        "active_customer_count",
        "transaction_count",
        "debit_transaction_value",
        _mean(),
        rounded_ratio(F.col("transaction_count"), F.col("active_customer_count"), 2).alias("transactions_per_customer"),
    )


def geographic_transaction_summary(tables: Tables) -> DataFrame:
    place = ["region", "state", "city"]
    totals = per_attribute(tables, {"dim_location": place}, [COUNT, VALUE, "international_transaction_count"])
    return totals.select(*place, _count(), VALUE, "international_transaction_count")


def anomaly_review(tables: Tables) -> DataFrame:
    flags = tables["fact_anomaly_flag"].select(
        "anomaly_id", "transaction_key", "transaction_id", "triggered_rules", "anomaly_score", "review_priority"
    )
    fact = tables["fact_transaction"].select(
        "transaction_key", "date_key", "customer_key", "transaction_category_key", "channel_key", "transaction_amount"
    )
    attributes = {
        "dim_date": ["date"],
        "dim_customer": ["customer_id", "customer_display_name"],
        "dim_transaction_category": ["transaction_category"],
        "dim_channel": ["transaction_channel"],
    }
    return with_attributes(flags.join(fact, "transaction_key"), tables, attributes, "left").select(
        "anomaly_id",
        "transaction_id",
        F.col("date").alias("transaction_date"),
        "customer_id",
        "customer_display_name",
        "transaction_category",
        "transaction_channel",
        "transaction_amount",
        "triggered_rules",
        "anomaly_score",
        "review_priority",
    )


def declined_transaction_analysis(tables: Tables) -> DataFrame:
    attributes = {
        "dim_date": ["month_start_date"],
        "dim_transaction_category": ["transaction_category"],
        "dim_channel": ["transaction_channel"],
    }
    totals = per_attribute(tables, attributes, [COUNT, "declined_count"])
    return totals.select(
        "month_start_date",
        "transaction_category",
        "transaction_channel",
        _count(),
        F.col("declined_count").alias("declined_transaction_count"),
        _rate("declined_count", "decline_rate"),
    )


def data_quality_summary(tables: Tables) -> DataFrame:
    groups = ["source_file", "rule_name", "severity", "resolution_status"]
    return tables["fact_data_quality_issue"].groupBy(*groups).agg(F.count("*").alias("issue_count"))


def executive_kpis(tables: Tables) -> DataFrame:
    flows = ["debit_transaction_value", "credit_transaction_value", "net_transaction_flow"]
    flags = [
        "approved_count",
        "declined_count",
        "reversed_count",
        "pending_count",
        "international_transaction_count",
        "recurring_transaction_count",
    ]
    names = [COUNT, VALUE, APPROVED, *flows, *flags]
    sums = totals_by_key(tables, [], [*names, "largest_transaction_amount"])
    customers = totals_by_key(tables, ["customer_key"], [COUNT]).agg(F.count("customer_key").alias("active_customer_count"))
    accounts = totals_by_key(tables, ["account_key"], [COUNT]).agg(F.count("account_key").alias("active_account_count"))
    anomalies = tables["fact_anomaly_flag"].agg(F.count("*").alias("potential_anomaly_count"))
    return one_row([sums, customers, accounts, anomalies]).select(
        F.col(COUNT).alias("total_transaction_count"),
        VALUE,
        APPROVED,
        _mean(),
        "largest_transaction_amount",
        "active_customer_count",
        "active_account_count",
        _rate("approved_count", "approval_rate"),
        _rate("declined_count", "decline_rate"),
        _rate("reversed_count", "reversal_rate"),
        _rate("pending_count", "pending_transaction_rate"),
        *flows,
        _rate("international_transaction_count", "international_transaction_percentage"),
        _rate("recurring_transaction_count", "recurring_transaction_percentage"),
        "potential_anomaly_count",
    )


# The view names.
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "vw_transaction_overview": transaction_overview,
    "vw_daily_transaction_trends": daily_transaction_trends,
    "vw_monthly_transaction_trends": monthly_transaction_trends,
    "vw_category_performance": category_performance,
    "vw_customer_spending_summary": customer_spending_summary,
    "vw_merchant_performance": merchant_performance,
    "vw_channel_performance": channel_performance,
    "vw_transaction_status_summary": transaction_status_summary,
    "vw_account_activity": account_activity,
    "vw_customer_segment_analysis": customer_segment_analysis,
    "vw_geographic_transaction_summary": geographic_transaction_summary,
    "vw_anomaly_review": anomaly_review,
    "vw_declined_transaction_analysis": declined_transaction_analysis,
    "vw_data_quality_summary": data_quality_summary,
    "vw_executive_kpis": executive_kpis,
}


def register_views(spark: SparkSession, tables: Tables) -> list[str]:
    """Star tables and reporting views as temporary views, so that SQL can read them by name."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(name)
    return [*tables, *VIEWS]
