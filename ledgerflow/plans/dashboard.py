"""Group-bys behind the dashboard pages that no reporting view covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import blank_divide, cents
from ledgerflow.functions.vocabulary import CUSTOMER_SEGMENTS
from ledgerflow.operators.quantiles import exact_quantiles
from ledgerflow.plans.kpis import rule_counts
from ledgerflow.plans.rollup import Tables, one_row, per_attribute, totals_by_key, with_attributes

VALUE = "total_transaction_value"
COUNT = "transaction_count"
QUARTILES = {"minimum": 0.0, "first_quartile": 0.25, "median": 0.5, "third_quartile": 0.75, "maximum": 1.0}
RELATIONSHIP_RULES = (
    "account_branch_exists",
    "account_customer_exists",
    "account_id_exists",
    "branch_id_exists",
    "customer_id_exists",
    "device_id_exists",
    "merchant_id_exists",
)


def top_segments(tables: Tables, count: int = 5) -> DataFrame:
    totals = per_attribute(tables, {"dim_customer": ["customer_segment"]}, [COUNT, VALUE])
    return totals.orderBy(F.desc(VALUE), "customer_segment").limit(count)


def debit_credit_by_month(tables: Tables) -> DataFrame:
    return per_attribute(
        tables, {"dim_date": ["month_start_date"]}, ["debit_transaction_value", "credit_transaction_value"]
    )


def category_by_segment(tables: Tables) -> DataFrame:
    attributes = {"dim_transaction_category": ["transaction_category"], "dim_customer": ["customer_segment"]}
    return per_attribute(tables, attributes, [COUNT, VALUE])


def category_segment_matrix(tables: Tables, segments: Sequence[str] = (*CUSTOMER_SEGMENTS, "Unknown")) -> DataFrame:
    """One column per given segment, so the pivot needs no pass to find them, and ``Other`` for all others."""
    listed = F.when(F.col("customer_segment").isin(*segments), F.col("customer_segment")).otherwise("Other")
    cells = category_by_segment(tables).withColumn("segment", listed).groupBy("transaction_category")
    return cells.pivot("segment", [*segments, "Other"]).agg(F.sum(VALUE))


def weekend_activity(tables: Tables) -> DataFrame:
    return per_attribute(tables, {"dim_date": ["is_weekend"]}, [COUNT, VALUE])


def recurring_activity(tables: Tables) -> DataFrame:
    return per_attribute(tables, {}, [COUNT, VALUE], extra=["is_recurring"])


def customer_spend(tables: Tables) -> DataFrame:
    return totals_by_key(tables, ["customer_key"], ["debit_transaction_value"])


def spend_quartiles(tables: Tables) -> DataFrame:
    spend = customer_spend(tables).select(cents(F.col("debit_transaction_value")).alias("cents"))
    quartiles = exact_quantiles(spend, [], "cents", QUARTILES)
    return quartiles.select(*[(F.col(name) / 100).alias(name) for name in QUARTILES])


def spend_histogram(tables: Tables, lowest: float, highest: float, bins: int) -> DataFrame:
    """Customers per spend band; bands 0 and bins + 1 hold what lies outside the range."""
    spend = F.col("debit_transaction_value").cast("double")
    band = F.width_bucket(spend, F.lit(float(lowest)), F.lit(float(highest)), F.lit(bins))
    return (
        customer_spend(tables)
        .groupBy(band.alias("spend_band"))
        .agg(F.count("*").alias("customers"), F.sum("debit_transaction_value").alias("debit_transaction_value"))
    )


def spend_per_customer(tables: Tables) -> DataFrame:
    totals = customer_spend(tables)
    spend = F.col("debit_transaction_value")
    return totals.agg(
        F.count("*").alias("active_customers"),
        blank_divide(F.sum(spend), F.count("*")).alias("average_customer_spend"),
    )


def category_share(tables: Tables) -> DataFrame:
    totals = per_attribute(tables, {"dim_transaction_category": ["transaction_category"]}, [VALUE])
    share = blank_divide(F.col(VALUE), F.sum(VALUE).over(Window.partitionBy()))
    return totals.select("transaction_category", VALUE, share.alias("value_share"))


def _by_customer_band(tables: Tables, band: Column, name: str, needed: Sequence[str]) -> DataFrame:
    totals = totals_by_key(tables, ["customer_key"], [COUNT, VALUE])
    described = with_attributes(totals, tables, {"dim_customer": needed})
    return described.groupBy(band.alias(name)).agg(
        F.count("customer_key").alias("active_customers"), F.sum(COUNT).alias(COUNT), F.sum(VALUE).alias(VALUE)
    )


def age_group_activity(tables: Tables) -> DataFrame:
    return _by_customer_band(tables, F.col("age_group"), "age_group", ["age_group"])


def tenure_band(months: Column) -> Column:
    return (
        F.when(months < 12, "Under 1 year")
        .when(months < 36, "1-3 years")
        .when(months < 60, "3-5 years")
        .when(months < 120, "5-10 years")
        .when(months >= 120, "10+ years")
        .otherwise("Unknown")
    )


def tenure_activity(tables: Tables) -> DataFrame:
    column = "account_tenure_months"
    return _by_customer_band(tables, tenure_band(F.col(column)), "tenure_band", [column])


def preferred_channel_activity(tables: Tables) -> DataFrame:
    return _by_customer_band(tables, F.col("preferred_channel"), "preferred_channel", ["preferred_channel"])


def busiest_customers(tables: Tables, count: int = 20) -> DataFrame:
    totals = totals_by_key(tables, ["customer_key"], [COUNT, VALUE])
    columns = ["customer_id", "customer_display_name", "customer_segment"]
    described = with_attributes(totals, tables, {"dim_customer": columns})
    return described.select(*columns, COUNT, VALUE).orderBy(F.desc(COUNT), "customer_id").limit(count)


def customer_transactions(overview: DataFrame, customer_id: str) -> DataFrame:
    """Drill-through: the overview rows of one customer."""
    return overview.where(F.col("customer_id") == customer_id)


def merchant_category_performance(tables: Tables) -> DataFrame:
    return per_attribute(tables, {"dim_merchant": ["merchant_category"]}, [COUNT, VALUE])


def channel_by_segment(tables: Tables) -> DataFrame:
    attributes = {"dim_channel": ["transaction_channel"], "dim_customer": ["customer_segment"]}
    return per_attribute(tables, attributes, [COUNT, VALUE])


def status_by_month(tables: Tables) -> DataFrame:
    attributes = {"dim_date": ["month_start_date"], "dim_transaction_status": ["transaction_status"]}
    return per_attribute(tables, attributes, [COUNT, VALUE])


def flag_overview(tables: Tables) -> DataFrame:
    return tables["fact_anomaly_flag"].agg(
        F.count("*").alias("flagged_transactions"),
        F.sum("transaction_amount").alias("flagged_value"),
        F.count_distinct("customer_id").alias("customers_with_flags"),
        F.count_if(F.col("review_priority") == "High").alias("high_priority_reviews"),
    )


def flags_by_rule(tables: Tables) -> DataFrame:
    return rule_counts(tables["fact_anomaly_flag"]).select(
        F.col("label").alias("rule_name"), F.col("value").cast("bigint").alias("flags")
    )


def flags_by(tables: Tables, column: str) -> DataFrame:
    """Flags per customer_id, transaction_category, transaction_channel or review_priority."""
    return tables["fact_anomaly_flag"].groupBy(column).agg(
        F.count("*").alias("flags"), F.sum("transaction_amount").alias("flagged_value")
    )


def flags_by_month(tables: Tables) -> DataFrame:
    month = F.trunc("transaction_date", "MM").alias("month_start_date")
    return tables["fact_anomaly_flag"].groupBy(month).agg(F.count("*").alias("flags"))


def issue_overview(tables: Tables) -> DataFrame:
    rule, severity = F.col("rule_name"), F.col("severity")
    return tables["fact_data_quality_issue"].agg(
        F.count("*").alias("issues"),
        F.count_if(severity == "Critical").alias("critical_issues"),
        F.count_if(severity == "Error").alias("errors"),
        F.count_if(severity == "Warning").alias("warnings"),
        F.count_if(rule == "transaction_id_unique").alias("duplicate_transactions"),
        F.count_if(rule.isin(*RELATIONSHIP_RULES)).alias("missing_relationships"),
        F.count_if(F.col("resolution_status") == "Open").alias("unresolved"),
        F.count_if(F.col("resolution_status") != "Open").alias("resolved"),
    )


def issues_by(tables: Tables, *columns: str) -> DataFrame:
    return tables["fact_data_quality_issue"].groupBy(*columns).agg(F.count("*").alias("issues"))


def reconciliation_status(tables: Tables) -> DataFrame:
    return tables["reconciliation_report"].groupBy("status").agg(F.count("*").alias("checks"))


def headline(tables: Tables) -> DataFrame:
    return one_row([flag_overview(tables), issue_overview(tables)])
