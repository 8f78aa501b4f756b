"""The ten report tables: unrounded, sorted, rows without a group left out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import blank_divide
from ledgerflow.plans.kpis import calculate_kpis
from ledgerflow.plans.rollup import Tables, per_attribute, totals_by_key, with_attributes

TOP_MERCHANTS = 100
TOP_ANOMALIES = 1000
VALUE = "total_transaction_value"


def _present(tables: Tables, attributes: Mapping[str, Sequence[str]], names: Sequence[str]) -> DataFrame:
    totals = per_attribute(tables, attributes, names, "left")
    groups = [name for columns in attributes.values() for name in columns]
    return totals.dropna(subset=groups)


def _mean() -> Column:
    return blank_divide(F.col(VALUE), F.col("rows")).alias("average_transaction_amount")


def _share(part: str, name: str) -> Column:
    return blank_divide(F.col(part), F.col("transaction_count")).alias(name)


def monthly_trends(tables: Tables) -> DataFrame:
    names = [
        "transaction_count",
        VALUE,
        "approved_transaction_value",
        "debit_transaction_value",
        "credit_transaction_value",
        "net_transaction_flow",
    ]
    months = _present(tables, {"dim_date": ["month_start_date"]}, [*names, "rows"])
    return months.select("month_start_date", *names, _mean()).orderBy("month_start_date")


def category_analysis(tables: Tables) -> DataFrame:
    names = ["transaction_count", VALUE, "approved_transaction_value", "declined_count", "rows"]
    totals = _present(tables, {"dim_transaction_category": ["transaction_category"]}, names)
    return totals.select(
        "transaction_category",
        "transaction_count",
        VALUE,
        "approved_transaction_value",
        _mean(),
        F.col("declined_count").alias("declined_transaction_count"),
        _share("declined_count", "decline_rate"),
    ).orderBy(F.desc(VALUE), "transaction_category")


def segment_analysis(tables: Tables) -> DataFrame:
    """A customer key has one row of totals, so counting those rows counts distinct customers."""
    names = ["transaction_count", VALUE, "debit_transaction_value", "credit_transaction_value", "rows"]
    totals = totals_by_key(tables, ["customer_key"], names)
    described = with_attributes(totals, tables, {"dim_customer": ["customer_segment"]}, "left")
    segments = (
        described.where("customer_segment is not null")
        .groupBy("customer_segment")
        .agg(F.count("customer_key").alias("active_customers"), *[F.sum(name).alias(name) for name in names])
    )
    per_customer = blank_divide(F.col("transaction_count"), F.col("active_customers"))
    return segments.select(
        "customer_segment",
        "active_customers",
        "transaction_count",
        VALUE,
        "debit_transaction_value",
        "credit_transaction_value",
        _mean(),
        per_customer.alias("transactions_per_customer"),
    ).orderBy(F.desc(VALUE), "customer_segment")


def channel_analysis(tables: Tables) -> DataFrame:
    names = ["transaction_count", VALUE, "approved_count", "declined_count"]
    totals = _present(tables, {"dim_channel": ["transaction_channel"]}, names)
    return totals.select(
        "transaction_channel", *names, _share("approved_count", "approval_rate"), _share("declined_count", "decline_rate")
    ).orderBy(F.desc("transaction_count"), "transaction_channel")


def merchant_analysis(tables: Tables) -> DataFrame:
    groups = ["merchant_id", "merchant_name", "merchant_category"]
    totals = _present(tables, {"dim_merchant": groups}, ["transaction_count", VALUE, "rows"])
    return (
        totals.select(*groups, "transaction_count", VALUE, _mean())
        .orderBy(F.desc(VALUE), *groups)
        .limit(TOP_MERCHANTS)
    )


def status_analysis(tables: Tables) -> DataFrame:
    names = ["transaction_count", VALUE]
    totals = _present(tables, {"dim_transaction_status": ["transaction_status"]}, names)
    # One row per status reaches this window.
    share = blank_divide(F.col("transaction_count"), F.sum("transaction_count").over(Window.partitionBy()))
    return totals.select("transaction_status", *names, share.alias("transaction_share")).orderBy(
        F.desc("transaction_count"), "transaction_status"
    )


def anomaly_top(tables: Tables) -> DataFrame:
    return tables["fact_anomaly_flag"].orderBy(F.desc("anomaly_score"), "anomaly_id").limit(TOP_ANOMALIES)


def quality_summary(tables: Tables) -> DataFrame:
    groups = ["source_file", "rule_name", "severity"]
    counts = tables["fact_data_quality_issue"].groupBy(*groups).agg(F.count("*").alias("issue_count"))
    return counts.orderBy(F.desc("issue_count"), *groups)


def reconciliation(tables: Tables) -> DataFrame:
    return tables["reconciliation_report"]


# The report names and their order.
REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "Executive Summary": calculate_kpis,
    "Monthly Trends": monthly_trends,
    "Category Analysis": category_analysis,
    "Customer Segments": segment_analysis,
    "Channel Analysis": channel_analysis,
    "Merchant Analysis": merchant_analysis,
    "Transaction Status": status_analysis,
    "Anomaly Review": anomaly_top,
    "Data Quality": quality_summary,
    "Reconciliation": reconciliation,
}


def build_reports(tables: Tables) -> dict[str, DataFrame]:
    return {name: report(tables) for name, report in REPORTS.items()}
