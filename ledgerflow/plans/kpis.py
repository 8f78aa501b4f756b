"""The KPI table and the computed business insights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import blank_divide, cents, safe_divide
from ledgerflow.functions.text import pretty_label
from ledgerflow.operators.quantiles import exact_quantiles
from ledgerflow.plans.rollup import Tables, additive, as_rows, one_row, per_attribute
from ledgerflow.settings import DEFAULT_WEIGHTS

HIGH_VALUE_AMOUNT = 5000
APP_CHANNELS = ("Mobile", "Online")
TOP_MERCHANTS = 10


def approval_rate() -> Column:
    return safe_divide(F.count_if("is_approved"), F.count("*"))


def decline_rate() -> Column:
    return safe_divide(F.count_if("is_declined"), F.count("*"))


def net_flow() -> Column:
    return F.sum("signed_transaction_amount")


def last_month_growth(monthly_summary: DataFrame) -> DataFrame:
    """Growth of debit value from the last but one to the last month present; 0 without one."""
    months = (
        monthly_summary.where("month_start_date is not null")
        .groupBy("month_start_date")
        .agg(F.sum("debit_transaction_value").cast("double").alias("value"))
    )
    # One row per calendar month reaches this window.
    in_order = Window.orderBy("month_start_date")
    growth = blank_divide(F.col("value") - F.col("previous"), F.col("previous"))
    return (
        months.withColumn("previous", F.lag("value").over(in_order))
        .withColumn("growth", F.coalesce(growth, F.lit(0.0)))
        .agg(F.coalesce(F.max_by("growth", "month_start_date"), F.lit(0.0)).alias("growth"))
    )


def kpi_row(tables: Tables) -> DataFrame:
    """All KPI inputs side by side: one pass over the fact, plus small aggregates."""
    fact, monthly, anomalies = (
        tables[name] for name in ("fact_transaction", "fact_customer_monthly_summary", "fact_anomaly_flag")
    )
    names = [
        "rows",
        "total_transaction_value",
        "approved_count",
        "approved_transaction_value",
        "declined_count",
        "reversed_count",
        "pending_count",
        "debit_transaction_value",
        "credit_transaction_value",
        "net_transaction_flow",
        "international_transaction_count",
        "recurring_transaction_count",
    ]
    sums = fact.agg(
        *[total.alias(name) for name, total in additive(*names).items()],
        F.max("transaction_amount").alias("largest"),
        F.count_if(F.col("transaction_amount") >= HIGH_VALUE_AMOUNT).alias("high_value"),
    )
    amounts = fact.select(cents(F.col("transaction_amount")).alias("cents"))
    median = exact_quantiles(amounts, [], "cents", {"median": 0.5})
    actors = fact.select("customer_key", "account_key").distinct()
    active = actors.agg(
        F.count_distinct("customer_key").alias("customers"), F.count_distinct("account_key").alias("accounts")
    )
    channels = per_attribute(tables, {"dim_channel": ["transaction_channel"]}, ["rows"])
    apps = channels.where(F.col("transaction_channel").isin(*APP_CHANNELS)).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("app_rows")
    )
    flagged = anomalies.agg(
        F.count("*").alias("anomalies"), F.count_distinct("customer_id").alias("flagged_customers")
    )
    spend = monthly.agg(
        F.sum("debit_transaction_value").alias("monthly_debit"), F.count("debit_transaction_value").alias("months")
    )
    return one_row([sums, median, active, apps, flagged, spend, last_month_growth(monthly)])


def calculate_kpis(tables: Tables) -> DataFrame:
    """``metric_name, metric_value`` in report order."""
    col = F.col
    rows = col("rows")
    # The metric names and their order.
    metrics = {
        "Total Transaction Count": rows,
        "Total Transaction Value": col("total_transaction_value"),
        "Approved Transaction Count": col("approved_count"),
        "Approved Transaction Value": col("approved_transaction_value"),
        "Average Transaction Amount": blank_divide(col("total_transaction_value"), rows),
        "Median Transaction Amount": col("median") / 100,
        "Largest Transaction Amount": col("largest"),
        "Active Customer Count": col("customers"),
        "Active Account Count": col("accounts"),
        "Transactions Per Customer": safe_divide(rows, col("customers")),
        "Transactions Per Account": safe_divide(rows, col("accounts")),
        "Approval Rate": safe_divide(col("approved_count"), rows),
        "Decline Rate": safe_divide(col("declined_count"), rows),
        "Reversal Rate": safe_divide(col("reversed_count"), rows),
        "Pending Transaction Rate": safe_divide(col("pending_count"), rows),
        "Debit Transaction Value": col("debit_transaction_value"),
        "Credit Transaction Value": col("credit_transaction_value"),
        "Net Transaction Flow": col("net_transaction_flow"),
        "International Transaction Percentage": safe_divide(col("international_transaction_count"), rows),
        "Recurring Transaction Percentage": safe_divide(col("recurring_transaction_count"), rows),
        "Mobile and Online Adoption Rate": safe_divide(col("app_rows"), rows),
        "High-Value Transaction Count": col("high_value"),
        "Potential Anomaly Count": col("anomalies"),
        "Customers With Anomaly Flags": col("flagged_customers"),
        "Average Customer Monthly Spend": blank_divide(col("monthly_debit"), col("months")),
        "Month-over-Month Transaction Growth": col("growth"),
    }
    return as_rows(kpi_row(tables), metrics, "metric_name", "metric_value")


def _best(frame: DataFrame, label: str, value: Column) -> DataFrame:
    """The row with the highest value; equal values go to the first label."""
    scored = frame.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), value.cast("double").alias("value"))
    return scored.where("value is not null").orderBy(F.desc("value"), "label").limit(1)


def top_category(tables: Tables) -> DataFrame:
    value = "total_transaction_value"
    totals = per_attribute(tables, {"dim_transaction_category": ["transaction_category"]}, [value], "left")
    return _best(totals, "transaction_category", F.col(value))


def fastest_growing_category(tables: Tables) -> DataFrame:
    """Growth between a category's first and last month; a first month of 0 has no growth."""
    value = "total_transaction_value"
    attributes = {"dim_transaction_category": ["transaction_category"], "dim_date": ["month_start_date"]}
    months = per_attribute(tables, attributes, [value], "left").where("month_start_date is not null")
    ends = months.groupBy("transaction_category").agg(
        F.min_by(value, "month_start_date").cast("double").alias("first"),
        F.max_by(value, "month_start_date").cast("double").alias("last"),
    )
    return _best(ends, "transaction_category", blank_divide(F.col("last") - F.col("first"), F.col("first")))


def _channels(tables: Tables) -> DataFrame:
    names = ["transaction_count", "declined_count"]
    return per_attribute(tables, {"dim_channel": ["transaction_channel"]}, names, "left")


def most_used_channel(tables: Tables) -> DataFrame:
    return _best(_channels(tables), "transaction_channel", F.col("transaction_count"))


def highest_decline_channel(tables: Tables) -> DataFrame:
    rate = blank_divide(F.col("declined_count"), F.col("transaction_count"))
    return _best(_channels(tables), "transaction_channel", rate)


def highest_mean_segment(tables: Tables) -> DataFrame:
    names = ["rows", "total_transaction_value"]
    totals = per_attribute(tables, {"dim_customer": ["customer_segment"]}, names, "left")
    return _best(totals, "customer_segment", blank_divide(F.col(names[1]), F.col(names[0])))


def top_merchant_share(tables: Tables) -> DataFrame:
    """Share of the ten merchant names with the highest value; names are ranked in a top-k."""
    value = "total_transaction_value"
    totals = per_attribute(tables, {"dim_merchant": ["merchant_name"]}, [value], "left")
    totals = totals.where("merchant_name is not null")
    top = totals.orderBy(F.desc(value), "merchant_name").limit(TOP_MERCHANTS).agg(F.sum(value).alias("top"))
    both = one_row([top, totals.agg(F.sum(value).alias("all"))])
    share = blank_divide(F.col("top"), F.col("all"))
    return both.select(F.lit("Top 10 merchants").alias("label"), share.alias("value"))


def flag_shares(tables: Tables) -> DataFrame:
    sums = tables["fact_transaction"].agg(
        *[
            total.alias(name)
            for name, total in additive("rows", "international_transaction_count", "recurring_transaction_count").items()
        ]
    )
    shares = {
        "International": blank_divide(F.col("international_transaction_count"), F.col("rows")),
        "Recurring": blank_divide(F.col("recurring_transaction_count"), F.col("rows")),
    }
    return as_rows(sums, shares, "label", "value")


def rule_counts(anomalies: DataFrame) -> DataFrame:
    """``label, value``: how often each review rule fired."""
    rules = list(DEFAULT_WEIGHTS)
    sums = anomalies.agg(*[F.count_if(rule).alias(rule) for rule in rules])
    return as_rows(sums, {rule: F.col(rule) for rule in rules}, "label", "value")


def most_common_review_rule(tables: Tables) -> DataFrame:
    best = _best(rule_counts(tables["fact_anomaly_flag"]), "label", F.col("value"))
    return best.where("value > 0").select(pretty_label(F.col("label")).alias("label"), "value")


def most_common_quality_rule(tables: Tables) -> DataFrame:
    counts = tables["fact_data_quality_issue"].groupBy("rule_name").agg(F.count("*").alias("issues"))
    best = _best(counts, "rule_name", F.col("issues"))
    return best.select(F.replace("label", F.lit("_"), F.lit(" ")).alias("label"), "value")


INSIGHTS: dict[str, Callable[[Tables], DataFrame]] = {
    "highest_spending_category": top_category,
    "fastest_growing_category": fastest_growing_category,
    "most_used_channel": most_used_channel,
    "highest_decline_channel": highest_decline_channel,
    "highest_mean_segment": highest_mean_segment,
    "top_merchant_share": top_merchant_share,
    "flag_shares": flag_shares,
    "most_common_review_rule": most_common_review_rule,
    "most_common_quality_rule": most_common_quality_rule,
}


def business_insights(tables: Tables) -> DataFrame:
    """``insight, label, value`` of all computed findings."""
    result = None
    for name, insight in INSIGHTS.items():
        rows = insight(tables).select(F.lit(name).alias("insight"), "label", "value")
        result = rows if result is None else result.unionAll(rows)
    return result
