"""Views, reports, KPIs, insights, measures, dashboard analyses, sources and sinks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import scalar_queries  # noqa: F401  registers the cleaned tables
from checks.model_queries import RECONCILIATION
from checks.oracle_tables import over_clean, over_everything, over_flags, over_issues, over_model, ratio
from checks.registry import ORACLE, add, add_star, warehouse
from ledgerflow.functions.text import standardize_column_names
from ledgerflow.operators import quality
from ledgerflow.operators.cleaning import clean_accounts, clean_customers, clean_transactions
from ledgerflow.plans import dashboard, kpis, measures, pipeline, reports, views
from ledgerflow.plans.reports import REPORTS
from ledgerflow.plans.views import VIEWS
from ledgerflow.sources import csv
from ledgerflow.sources.staging import Staging


def dbl(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def total(column: str, name: str) -> str:
    return dbl(f"sum({column})", name)


VALUE = total("transaction_amount", "total_transaction_value")
APPROVED = total("approved_amount", "approved_transaction_value")
DEBIT = total("debit_amount", "debit_transaction_value")
CREDIT = total("credit_amount", "credit_transaction_value")
NET = total("signed_transaction_amount", "net_transaction_flow")
COUNT = "count(*) AS transaction_count"
MEAN2 = f"{ratio('sum(transaction_amount)', 'count(*)', 2)} AS average_transaction_amount"
MEAN = "CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS average_transaction_amount"


def rate4(flag: str, name: str) -> str:
    return f"{ratio(f'count(*) FILTER ({flag})', 'count(*)', 4)} AS {name}"


def share(flag: str) -> str:
    return f"CAST(count(*) FILTER ({flag}) AS DOUBLE) / count(*)"


JOIN = {
    "date": "JOIN dim_date dd USING (date_key)",
    "customer": "JOIN dim_customer dc USING (customer_key)",
    "account": "JOIN dim_account da USING (account_key)",
    "merchant": "JOIN dim_merchant dm USING (merchant_key)",
    "category": "JOIN dim_transaction_category dk USING (transaction_category_key)",
    "channel": "JOIN dim_channel dh USING (channel_key)",
    "location": "JOIN dim_location dl USING (location_key)",
    "status": "JOIN dim_transaction_status ds USING (transaction_status_key)",
}


def grouped(groups: str, outputs: str, *joins: str) -> str:
    return over_model(f"SELECT {groups}, {outputs} FROM fact {' '.join(JOIN[name] for name in joins)} GROUP BY ALL")


# --- reporting views ----------------------------------------------------------------------------

add_star(
    "w01_transaction_overview",
    views.transaction_overview,
    over_model(
        "SELECT transaction_id, dd.date AS transaction_date, transaction_timestamp, dc.customer_id, customer_display_name, customer_segment, "
        "age_group, da.account_id, account_type, dm.merchant_id, merchant_name, transaction_category, transaction_status, "
        "transaction_channel, dl.city, dl.state, dl.region, "
        + ", ".join(dbl(name, name) for name in ("transaction_amount", "signed_transaction_amount", "debit_amount", "credit_amount"))
        + ", debit_credit_indicator, is_international, is_recurring, "
        + dbl("balance_after_transaction", "balance_after_transaction")
        + " FROM fact " + " ".join("LEFT " + join for join in JOIN.values())
    ),
)
add_star(
    "w02_daily_transaction_trends",
    views.daily_transaction_trends,
    grouped("date AS transaction_date, day_of_week, is_weekend", f"{COUNT}, {VALUE}, {APPROVED}, {MEAN}", "date"),
)
add_star(
    "w03_monthly_transaction_trends",
    views.monthly_transaction_trends,
    grouped("month_start_date, year, month_number", f"{COUNT}, {VALUE}, {APPROVED}, {NET}, {MEAN2}", "date"),
)
add_star(
    "w04_category_performance",
    views.category_performance,
    grouped("transaction_category", f"{COUNT}, {VALUE}, {APPROVED}, {MEAN2}, {rate4('is_declined', 'decline_rate')}", "category"),
)
add_star(
    "w05_customer_spending_summary",
    views.customer_spending_summary,
    grouped(
        "dc.customer_id, customer_display_name, customer_segment, age_group",
        f"count(transaction_id) AS transaction_count, {DEBIT}, {CREDIT}, {NET}, {MEAN2}",
        "customer",
    ),
)
add_star(
    "w06_merchant_performance",
    views.merchant_performance,
    grouped("dm.merchant_id, merchant_name, merchant_category", f"{COUNT}, {VALUE}, {MEAN2}", "merchant"),
)
add_star(
    "w07_channel_performance",
    views.channel_performance,
    grouped(
        "transaction_channel",
        f"{COUNT}, {VALUE}, {rate4('is_approved', 'approval_rate')}, {rate4('is_declined', 'decline_rate')}",
        "channel",
    ),
)
add_star(
    "w08_transaction_status_summary",
    views.transaction_status_summary,
    grouped(
        "transaction_status",
        f"{COUNT}, {VALUE}, {ratio('count(*)', '(SELECT count(*) FROM fact)', 4)} AS transaction_share",
        "status",
    ),
)
add_star(
    "w09_account_activity",
    views.account_activity,
    grouped(
        "da.account_id, account_type, account_status",
        f"count(transaction_id) AS transaction_count, {VALUE}, {NET}, min(date) AS first_transaction_date, max(date) AS last_transaction_date",
        "account", "date",
    ),
)
add_star(
    "w10_customer_segment_analysis",
    views.customer_segment_analysis,
    grouped(
        "customer_segment",
        "count(DISTINCT dc.customer_id) AS active_customer_count, count(transaction_id) AS transaction_count, "
        f"{DEBIT}, {MEAN2}, {ratio('count(transaction_id)', 'count(DISTINCT dc.customer_id)', 2)} AS transactions_per_customer",
        "customer",
    ),
)
add_star(
    "w11_geographic_transaction_summary",
    views.geographic_transaction_summary,
    grouped("region, state, city", f"{COUNT}, {VALUE}, count(*) FILTER (is_international) AS international_transaction_count", "location"),
)
add_star(
    "w12_anomaly_review",
    views.anomaly_review,
    over_flags(
        "SELECT anomaly_id, transaction_id, dd.date AS transaction_date, dc.customer_id, customer_display_name, dk.transaction_category, "
        "dh.transaction_channel, " + dbl("fact.transaction_amount", "transaction_amount")
        + ", triggered_rules, anomaly_score, review_priority FROM flags f JOIN fact USING (transaction_id) "
        + " ".join("LEFT " + JOIN[name] for name in ("date", "customer", "category", "channel"))
    ),
)
add_star(
    "w13_declined_transaction_analysis",
    views.declined_transaction_analysis,
    grouped(
        "month_start_date, transaction_category, transaction_channel",
        f"{COUNT}, count(*) FILTER (is_declined) AS declined_transaction_count, {rate4('is_declined', 'decline_rate')}",
        "date", "category", "channel",
    ),
)
add_star(
    "w14_data_quality_summary",
    views.data_quality_summary,
    over_issues("SELECT source_file, rule_name, severity, resolution_status, count(*) AS issue_count FROM issues GROUP BY ALL"),
)
EXECUTIVE = over_flags(
    f"SELECT count(*) AS total_transaction_count, {VALUE}, {APPROVED}, {MEAN2}, "
    f"{dbl('max(transaction_amount)', 'largest_transaction_amount')}, count(DISTINCT customer_key) AS active_customer_count, "
    f"count(DISTINCT account_key) AS active_account_count, {rate4('is_approved', 'approval_rate')}, "
    f"{rate4('is_declined', 'decline_rate')}, {rate4('is_reversed', 'reversal_rate')}, "
    f"{rate4('is_pending', 'pending_transaction_rate')}, {DEBIT}, {CREDIT}, {NET}, "
    f"{rate4('is_international', 'international_transaction_percentage')}, "
    f"{rate4('is_recurring', 'recurring_transaction_percentage')}, "
    "(SELECT count(*) FROM flags) AS potential_anomaly_count FROM fact"
)
add_star("w15_executive_kpis", views.executive_kpis, EXECUTIVE)


def _view_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """A reporting view read by its name with SQL."""
    star = warehouse(spark, folder)
    views.register_views(spark, pipeline.prepared(star, (*pipeline.EXPORTED_TABLES, "fact_rollups")))
    return spark.sql(
        "SELECT region, sum(transaction_count) AS transaction_count, sum(total_transaction_value) AS total_transaction_value "
        "FROM vw_geographic_transaction_summary GROUP BY region"
    )


add("w11_view_by_name", _view_by_name, grouped("region", f"{COUNT}, {VALUE}", "location"))

# --- KPIs and insights --------------------------------------------------------------------------

# KPI names.
_KPIS = [
    ("Total Transaction Count", "count(*)"),
    ("Total Transaction Value", "sum(transaction_amount)"),
    ("Approved Transaction Count", "count(*) FILTER (is_approved)"),
    ("Approved Transaction Value", "sum(approved_amount)"),
    ("Average Transaction Amount", "CAST(sum(transaction_amount) AS DOUBLE) / count(*)"),
    ("Median Transaction Amount", "quantile_cont(CAST(transaction_amount * 100 AS BIGINT), 0.5) / 100"),
    ("Largest Transaction Amount", "max(transaction_amount)"),
    ("Active Customer Count", "count(DISTINCT customer_key)"),
    ("Active Account Count", "count(DISTINCT account_key)"),
    ("Transactions Per Customer", "CAST(count(*) AS DOUBLE) / count(DISTINCT customer_key)"),
    ("Transactions Per Account", "CAST(count(*) AS DOUBLE) / count(DISTINCT account_key)"),
    ("Approval Rate", share("is_approved")),
    ("Decline Rate", share("is_declined")),
    ("Reversal Rate", share("is_reversed")),
    ("Pending Transaction Rate", share("is_pending")),
    ("Debit Transaction Value", "sum(debit_amount)"),
    ("Credit Transaction Value", "sum(credit_amount)"),
    ("Net Transaction Flow", "sum(signed_transaction_amount)"),
    ("International Transaction Percentage", share("is_international")),
    ("Recurring Transaction Percentage", share("is_recurring")),
    ("Mobile and Online Adoption Rate", share("transaction_channel IN ('Mobile', 'Online')")),
    ("High-Value Transaction Count", "count(*) FILTER (transaction_amount >= 5000)"),
    ("Potential Anomaly Count", "(SELECT count(*) FROM flags)"),
    ("Customers With Anomaly Flags", "(SELECT count(DISTINCT customer_id) FROM flags)"),
    (
        "Average Customer Monthly Spend",
        "(SELECT CAST(sum(CAST(debit_transaction_value AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM monthly)",
    ),
    (
        "Month-over-Month Transaction Growth",
        "(SELECT (v - p) / p FROM (SELECT month_start_date, v, lag(v) OVER (ORDER BY month_start_date) AS p FROM "
        "(SELECT month_start_date, CAST(sum(CAST(debit_transaction_value AS DECIMAL(18,2))) AS DOUBLE) AS v FROM monthly GROUP BY 1)) "
        "ORDER BY month_start_date DESC LIMIT 1)",
    ),
]


def _kpi_sql(names: list[tuple[str, str]]) -> str:
    return over_flags(
        " UNION ALL ".join(
            f"SELECT '{name}' AS metric_name, {dbl(value, 'metric_value')}"
            + ("" if value.startswith("(SELECT") else f" FROM fact {JOIN['channel']}")
            for name, value in names
        )
    )


add_star("k01_k26_kpi_summary", kpis.calculate_kpis, _kpi_sql(_KPIS))
add_star(
    "k12_k13_k18_rates_and_flow",
    lambda tables: tables["fact_transaction"].agg(
        kpis.approval_rate().alias("approval_rate"), kpis.decline_rate().alias("decline_rate"), kpis.net_flow().alias("net_flow")
    ),
    over_model(
        f"SELECT {share('is_approved')} AS approval_rate, {share('is_declined')} AS decline_rate, "
        f"{total('signed_transaction_amount', 'net_flow')} FROM fact"
    ),
)


def _top(label: str, value: str, *joins: str) -> str:
    source = f"fact {' '.join('LEFT ' + JOIN[name] for name in joins)}"
    return (
        f"SELECT label, value FROM (SELECT {label} AS label, CAST({value} AS DOUBLE) AS value FROM {source} GROUP BY 1) "
        "WHERE label IS NOT NULL ORDER BY value DESC, label LIMIT 1"
    )


_GROWTH = (
    "SELECT label, (last - first) / first AS value FROM (SELECT label, CAST(arg_min(v, m) AS DOUBLE) AS first, CAST(arg_max(v, m) AS DOUBLE) AS last "
    "FROM (SELECT transaction_category AS label, month_start_date AS m, sum(transaction_amount) AS v FROM fact "
    f"{JOIN['category']} {JOIN['date']} GROUP BY ALL) GROUP BY label) WHERE first <> 0 ORDER BY value DESC, label LIMIT 1"
)
_RULE_NAMES = [
    "high_value_transaction",
    "spending_deviation",
    "rapid_repeat_transaction",
    "geographic_inconsistency",
    "unusual_international_activity",
    "unusual_transaction_time",
    "repeated_declines",
    "balance_issue",
]
_RULE_COUNTS = " UNION ALL ".join(
    f"SELECT '{rule}' AS label, CAST(count(*) FILTER ({rule}) AS DOUBLE) AS value FROM flags" for rule in _RULE_NAMES
)
_INSIGHTS = {
    "n1_top_category": (kpis.top_category, _top("transaction_category", "sum(transaction_amount)", "category"), over_model),
    "n2_fastest_growing_category": (kpis.fastest_growing_category, _GROWTH, over_model),
    "n3_most_used_channel": (kpis.most_used_channel, _top("transaction_channel", "count(transaction_id)", "channel"), over_model),
    "n3_highest_decline_channel": (
        kpis.highest_decline_channel,
        _top("transaction_channel", "CAST(count(*) FILTER (is_declined) AS DOUBLE) / count(*)", "channel"),
        over_model,
    ),
    "n4_highest_mean_segment": (
        kpis.highest_mean_segment,
        _top("customer_segment", "CAST(sum(transaction_amount) AS DOUBLE) / count(*)", "customer"),
        over_model,
    ),
    "n5_top_merchant_share": (
        kpis.top_merchant_share,
        "SELECT 'Top 10 merchants' AS label, CAST(sum(v) FILTER (place <= 10) AS DOUBLE) / CAST(sum(v) AS DOUBLE) AS value FROM "
        "(SELECT v, row_number() OVER (ORDER BY v DESC, merchant_name) AS place FROM "
        f"(SELECT merchant_name, sum(transaction_amount) AS v FROM fact {JOIN['merchant']} GROUP BY 1))",
        over_model,
    ),
    "n6_flag_shares": (
        kpis.flag_shares,
        f"SELECT 'International' AS label, {share('is_international')} AS value FROM fact UNION ALL "
        f"SELECT 'Recurring', {share('is_recurring')} FROM fact",
        over_model,
    ),
    "n7_most_common_review_rule": (
        kpis.most_common_review_rule,
        "SELECT array_to_string(list_transform(string_split(label, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS label, value FROM "
        f"({_RULE_COUNTS}) ORDER BY value DESC, label LIMIT 1",
        over_flags,
    ),
    "n8_most_common_quality_rule": (
        kpis.most_common_quality_rule,
        "SELECT replace(rule_name, '_', ' ') AS label, CAST(count(*) AS DOUBLE) AS value FROM issues GROUP BY rule_name "
        "ORDER BY value DESC, rule_name LIMIT 1",
        over_issues,
    ),
}
for _name, (_insight, _sql, _over) in _INSIGHTS.items():
    add_star(_name, _insight, _over(_sql))
add_star(
    "n1_n8_business_insights",
    kpis.business_insights,
    over_everything(
        " UNION ALL ".join(
            f"(SELECT '{insight}' AS insight, label, value FROM ({sql}))"
            for insight, (_, sql, _) in zip(kpis.INSIGHTS, _INSIGHTS.values())
        )
    ),
)

# --- report tables ------------------------------------------------------------------------------

add_star(
    "x1_monthly_trends",
    reports.monthly_trends,
    grouped("month_start_date", f"count(transaction_id) AS transaction_count, {VALUE}, {APPROVED}, {DEBIT}, {CREDIT}, {NET}, {MEAN}", "date"),
)
add_star(
    "x2_category_analysis",
    reports.category_analysis,
    grouped(
        "transaction_category",
        f"{COUNT}, {VALUE}, {APPROVED}, {MEAN}, count(*) FILTER (is_declined) AS declined_transaction_count, "
        f"{share('is_declined')} AS decline_rate",
        "category",
    ),
)
add_star(
    "x3_segment_analysis",
    reports.segment_analysis,
    grouped(
        "customer_segment",
        f"count(DISTINCT customer_key) AS active_customers, {COUNT}, {VALUE}, {DEBIT}, {CREDIT}, {MEAN}, "
        "CAST(count(*) AS DOUBLE) / count(DISTINCT customer_key) AS transactions_per_customer",
        "customer",
    ),
)
add_star(
    "x4_channel_analysis",
    reports.channel_analysis,
    grouped(
        "transaction_channel",
        f"{COUNT}, {VALUE}, count(*) FILTER (is_approved) AS approved_count, count(*) FILTER (is_declined) AS declined_count, "
        f"{share('is_approved')} AS approval_rate, {share('is_declined')} AS decline_rate",
        "channel",
    ),
)
add_star(
    "x5_merchant_analysis",
    reports.merchant_analysis,
    grouped("dm.merchant_id, merchant_name, merchant_category", f"{COUNT}, {VALUE}, {MEAN}", "merchant")
    + " ORDER BY sum(transaction_amount) DESC, dm.merchant_id LIMIT 100",
)
add_star(
    "x6_status_analysis",
    reports.status_analysis,
    grouped(
        "transaction_status", f"{COUNT}, {VALUE}, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fact) AS transaction_share", "status"
    ),
)
add_star(
    "x7_anomaly_review_top",
    lambda tables: reports.anomaly_top(tables).drop("transaction_key"),
    over_flags(
        "SELECT * REPLACE (CAST(transaction_amount AS DOUBLE) AS transaction_amount) FROM flags "
        "ORDER BY anomaly_score DESC, anomaly_id LIMIT 1000"
    ),
)
add_star(
    "x8_quality_summary",
    reports.quality_summary,
    over_issues("SELECT source_file, rule_name, severity, count(*) AS issue_count FROM issues GROUP BY ALL"),
)
add_star("x9_executive_summary", lambda tables: reports.REPORTS["Executive Summary"](tables), _kpi_sql(_KPIS))
add_star("x9_reconciliation", reports.reconciliation, over_everything(RECONCILIATION))

# --- measures -----------------------------------------------------------------------------------

CATEGORY = {"dim_transaction_category": ["transaction_category"]}
MEDIAN = "quantile_cont(CAST(transaction_amount * 100 AS BIGINT), 0.5) / 100 AS median_transaction_amount"


def _measure(name: str, attributes: dict, wanted: list[str], groups: str, outputs: str, *joins: str) -> None:
    add_star(name, lambda tables: measures.measures_by(tables, attributes, wanted), grouped(groups, outputs, *joins))


_measure(
    "m1_value_measures", CATEGORY,
    ["total_transactions", "total_transaction_value", "approved_transaction_value", "average_transaction_amount", "median_transaction_amount"],
    "transaction_category", f"count(*) AS total_transactions, {VALUE}, {APPROVED}, {MEAN}, {MEDIAN}", "category",
)
_measure(
    "m2_active_customers_and_accounts", CATEGORY, ["active_customers", "active_accounts"],
    "transaction_category", "count(DISTINCT customer_key) AS active_customers, count(DISTINCT account_key) AS active_accounts", "category",
)
_measure(
    "m3_status_rates", {"dim_location": ["region"], "dim_transaction_category": ["transaction_category"]},
    ["approval_rate", "decline_rate", "reversal_rate"],
    "region, transaction_category",
    f"{share('is_approved')} AS approval_rate, {share('is_declined')} AS decline_rate, {share('is_reversed')} AS reversal_rate",
    "location", "category",
)
_measure(
    "m4_flow_measures", {"dim_customer": ["customer_segment"]}, ["debit_value", "credit_value", "net_transaction_flow"],
    "customer_segment", f"{total('debit_amount', 'debit_value')}, {total('credit_amount', 'credit_value')}, {NET}", "customer",
)
_measure(
    "m5_adoption_and_international", CATEGORY, ["mobile_adoption_rate", "international_transaction_rate"],
    "transaction_category",
    f"""{share("transaction_channel IN ('Mobile', 'Online')")} AS mobile_adoption_rate, {share('is_international')} AS international_transaction_rate""",
    "category", "channel",
)
add_star(
    "m6_review_counts",
    measures.anomaly_counts,
    over_flags(
        "SELECT count(*) AS potential_anomaly_count, count(*) FILTER (review_priority = 'High') AS high_priority_review_count FROM flags"
    ),
)
add_star(
    "m7_m8_monthly_growth",
    measures.monthly_growth,
    over_model(
        "SELECT month_start_date, total_transaction_value, previous_month_transaction_value, "
        "(total_transaction_value - previous_month_transaction_value) / previous_month_transaction_value "
        "AS month_over_month_transaction_growth FROM (SELECT month_start_date, total_transaction_value, "
        "lag(total_transaction_value) OVER (ORDER BY month_start_date) AS previous_month_transaction_value FROM "
        f"(SELECT month_start_date, {VALUE} FROM dim_date LEFT JOIN fact USING (date_key) GROUP BY 1))"
    ),
)
add_star(
    "m9_average_monthly_spend",
    measures.average_monthly_spend,
    over_model(
        "SELECT CAST(sum(CAST(debit_transaction_value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average_monthly_spend_per_customer FROM monthly"
    ),
)

_BY_SEGMENT = {"dim_customer": ["customer_segment"]}
add_star(
    "m6_m9_reviews_and_spend_by_segment",
    lambda tables: measures.measures_by(
        tables, _BY_SEGMENT, ["potential_anomaly_count", "high_priority_review_count", "average_monthly_spend_per_customer"]
    ),
    over_everything(
        "SELECT customer_segment, potential_anomaly_count, high_priority_review_count, average_monthly_spend_per_customer FROM "
        "(SELECT customer_segment, CAST(sum(CAST(debit_transaction_value AS DECIMAL(18,2))) AS DOUBLE) / count(*) "
        f"AS average_monthly_spend_per_customer FROM monthly {JOIN['customer']} GROUP BY 1) LEFT JOIN "
        "(SELECT customer_segment, count(*) AS potential_anomaly_count, count(*) FILTER (review_priority = 'High') AS high_priority_review_count "
        "FROM (SELECT transaction_id, review_priority FROM flags) JOIN (SELECT transaction_id, customer_key FROM fact) USING (transaction_id) "
        f"{JOIN['customer']} GROUP BY 1) USING (customer_segment)"
    ),
)
add_star(
    "m6_review_counts_by_channel_and_region",
    lambda tables: measures.measures_by(
        tables,
        {"dim_channel": ["transaction_channel"], "dim_location": ["region"]},
        ["potential_anomaly_count", "high_priority_review_count"],
    ),
    over_everything(
        "SELECT transaction_channel, region, count(*) AS potential_anomaly_count, count(*) FILTER (review_priority = 'High') "
        "AS high_priority_review_count FROM (SELECT transaction_id, review_priority FROM flags) "
        f"JOIN (SELECT transaction_id, channel_key, location_key FROM fact) USING (transaction_id) {JOIN['channel']} {JOIN['location']} GROUP BY 1, 2"
    ),
)
_PER_MONTH = (
    "(SELECT transaction_category, month_start_date, CAST(sum(transaction_amount) AS DOUBLE) AS value "
    f"FROM fact {JOIN['category']} {JOIN['date']} GROUP BY 1, 2)"
)
_MONTH_AFTER = f"(SELECT transaction_category, CAST(month_start_date + INTERVAL 1 MONTH AS DATE) AS month_start_date, value FROM {_PER_MONTH})"
add_star(
    "m7_m8_monthly_growth_by_category",
    lambda tables: measures.monthly_growth(tables, {"dim_transaction_category": ["transaction_category"]}),
    over_model(
        "SELECT transaction_category, month_start_date, now.value AS total_transaction_value, past.value AS previous_month_transaction_value, "
        "(coalesce(now.value, 0) - past.value) / nullif(past.value, 0) AS month_over_month_transaction_growth FROM "
        f"(SELECT transaction_category, month_start_date FROM {_PER_MONTH} UNION SELECT transaction_category, month_start_date FROM {_MONTH_AFTER} "
        "WHERE month_start_date IN (SELECT month_start_date FROM dim_date)) "
        f"LEFT JOIN {_PER_MONTH} AS now USING (transaction_category, month_start_date) "
        f"LEFT JOIN {_MONTH_AFTER} AS past USING (transaction_category, month_start_date)"
    ),
)

# --- dashboard analyses -------------------------------------------------------------------------

# The customer segments, as the matrix lists them.
SEGMENTS = ["Students", "Young Professionals", "Families", "Affluent", "Retirees", "Small Business", "Unknown"]
_LISTED = ", ".join(f"'{name}'" for name in SEGMENTS)
PAIR = f"{COUNT}, {VALUE}"
add_star(
    "b01_top_segments",
    dashboard.top_segments,
    grouped("customer_segment", PAIR, "customer") + " ORDER BY sum(transaction_amount) DESC, customer_segment LIMIT 5",
)
add_star("b02_debit_credit_by_month", dashboard.debit_credit_by_month, grouped("month_start_date", f"{DEBIT}, {CREDIT}", "date"))
add_star(
    "b03_category_by_segment",
    dashboard.category_by_segment,
    grouped("transaction_category, customer_segment", PAIR, "category", "customer"),
)
add_star(
    "b03_category_segment_matrix",
    dashboard.category_segment_matrix,
    grouped(
        "transaction_category",
        ", ".join(f"""CAST(sum(transaction_amount) FILTER (customer_segment = '{name}') AS DOUBLE) AS "{name}" """ for name in SEGMENTS)
        + f""", CAST(sum(transaction_amount) FILTER (customer_segment NOT IN ({_LISTED})) AS DOUBLE) AS "Other" """,
        "category", "customer",
    ),
)
add_star("b04_weekend_activity", dashboard.weekend_activity, grouped("is_weekend", PAIR, "date"))
add_star("b05_recurring_activity", dashboard.recurring_activity, grouped("is_recurring", PAIR))
_SPEND = "(SELECT customer_key, sum(debit_amount) AS spend FROM fact GROUP BY 1)"
add_star(
    "b06_spend_quartiles",
    dashboard.spend_quartiles,
    over_model(
        "SELECT "
        + ", ".join(f"quantile_cont(CAST(spend * 100 AS BIGINT), {point}) / 100 AS {name}" for name, point in dashboard.QUARTILES.items())
        + f" FROM {_SPEND}"
    ),
)
add_star(
    "b06_spend_histogram",
    lambda tables: dashboard.spend_histogram(tables, 0, 2000000, 20),
    over_model(
        "SELECT CASE WHEN spend >= 2000000 THEN 21 ELSE CAST(floor(CAST(spend AS DOUBLE) / 100000) AS BIGINT) + 1 END AS spend_band, "
        f"count(*) AS customers, {total('spend', 'debit_transaction_value')} FROM {_SPEND} GROUP BY 1"
    ),
)
add_star(
    "b07_spend_per_customer",
    dashboard.spend_per_customer,
    over_model(f"SELECT count(*) AS active_customers, CAST(sum(spend) AS DOUBLE) / count(*) AS average_customer_spend FROM {_SPEND}"),
)
add_star(
    "b07_category_share",
    dashboard.category_share,
    grouped(
        "transaction_category",
        f"{VALUE}, CAST(sum(transaction_amount) AS DOUBLE) / (SELECT CAST(sum(transaction_amount) AS DOUBLE) FROM fact) AS value_share",
        "category",
    ),
)
_ACTIVE = f"count(DISTINCT customer_key) AS active_customers, {PAIR}"
add_star("b08_age_group_activity", dashboard.age_group_activity, grouped("age_group", _ACTIVE, "customer"))
add_star(
    "b09_tenure_activity",
    dashboard.tenure_activity,
    grouped(
        "CASE WHEN account_tenure_months < 12 THEN 'Under 1 year' WHEN account_tenure_months < 36 THEN '1-3 years' "
        "WHEN account_tenure_months < 60 THEN '3-5 years' WHEN account_tenure_months < 120 THEN '5-10 years' "
        "WHEN account_tenure_months >= 120 THEN '10+ years' ELSE 'Unknown' END AS tenure_band",
        _ACTIVE, "customer",
    ),
)
add_star("b10_preferred_channel_activity", dashboard.preferred_channel_activity, grouped("preferred_channel", _ACTIVE, "customer"))
add_star(
    "b11_busiest_customers",
    dashboard.busiest_customers,
    grouped("dc.customer_id, customer_display_name, customer_segment", PAIR, "customer")
    + " ORDER BY transaction_count DESC, dc.customer_id LIMIT 20",
)
add_star(
    "b11_customer_drill_through",
    lambda tables: dashboard.customer_transactions(views.transaction_overview(tables), "CUST7").select(
        "transaction_id", "transaction_date", "transaction_category", "transaction_status", "transaction_amount"
    ),
    over_model(
        "SELECT transaction_id, date AS transaction_date, transaction_category, transaction_status, "
        + dbl("transaction_amount", "transaction_amount")
        + f" FROM fact {JOIN['date']} {JOIN['customer']} {JOIN['category']} {JOIN['status']} WHERE dc.customer_id = 'CUST7'"
    ),
)
add_star(
    "b12_merchant_category_performance",
    dashboard.merchant_category_performance,
    grouped("merchant_category", PAIR, "merchant"),
)
add_star(
    "b12_channel_by_segment",
    dashboard.channel_by_segment,
    grouped("transaction_channel, customer_segment", PAIR, "channel", "customer"),
)
add_star("b13_status_by_month", dashboard.status_by_month, grouped("month_start_date, transaction_status", PAIR, "date", "status"))
add_star(
    "b14_flag_overview",
    dashboard.flag_overview,
    over_flags(
        f"SELECT count(*) AS flagged_transactions, {total('transaction_amount', 'flagged_value')}, "
        "count(DISTINCT customer_id) AS customers_with_flags, count(*) FILTER (review_priority = 'High') AS high_priority_reviews FROM flags"
    ),
)
add_star(
    "b15_flags_by_rule",
    dashboard.flags_by_rule,
    over_flags(f"SELECT label AS rule_name, CAST(value AS BIGINT) AS flags FROM ({_RULE_COUNTS})"),
)
for _column in ("customer_id", "transaction_category", "transaction_channel", "review_priority"):
    add_star(
        f"b15_flags_by_{_column}",
        lambda tables, column=_column: dashboard.flags_by(tables, column),
        over_flags(f"SELECT {_column}, count(*) AS flags, {total('transaction_amount', 'flagged_value')} FROM flags GROUP BY 1"),
    )
add_star(
    "b15_flags_by_month",
    dashboard.flags_by_month,
    over_flags("SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month_start_date, count(*) AS flags FROM flags GROUP BY 1"),
)
_RELATIONS = ", ".join(f"'{name}'" for name in dashboard.RELATIONSHIP_RULES)
add_star(
    "b16_issue_overview",
    dashboard.issue_overview,
    over_issues(
        "SELECT count(*) AS issues, count(*) FILTER (severity = 'Critical') AS critical_issues, count(*) FILTER (severity = 'Error') AS errors, "
        "count(*) FILTER (severity = 'Warning') AS warnings, count(*) FILTER (rule_name = 'transaction_id_unique') AS duplicate_transactions, "
        f"count(*) FILTER (rule_name IN ({_RELATIONS})) AS missing_relationships, count(*) FILTER (resolution_status = 'Open') AS unresolved, "
        "count(*) FILTER (resolution_status <> 'Open') AS resolved FROM issues"
    ),
)
for _columns in (("severity",), ("source_file",), ("rule_name",), ("resolution_status",)):
    add_star(
        f"b16_issues_by_{_columns[0]}",
        lambda tables, columns=_columns: dashboard.issues_by(tables, *columns),
        over_issues(f"SELECT {', '.join(_columns)}, count(*) AS issues FROM issues GROUP BY ALL"),
    )
add_star(
    "b16_reconciliation_status",
    dashboard.reconciliation_status,
    over_everything(f"SELECT status, count(*) AS checks FROM ({RECONCILIATION}) GROUP BY 1"),
)

# --- sources and sinks --------------------------------------------------------------------------


def _csv_round_trip(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Raw tables written as CSV under loose headings, then ingested again."""
    staging = Staging(spark)
    raw = warehouse(spark, folder).raw
    for name, file in csv.RAW_FILES.items():
        frame = raw[name].drop("source_row_number")
        loose = frame.toDF(*[f" {column.replace('_', ' ').title()} ($)" for column in frame.columns])
        csv.save_csv(loose, staging.path(file))
    return csv.ingest_source_files(spark, staging.folder)


def _ingested(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, columns and highest row number of every ingested table."""
    result = None
    for name, frame in _csv_round_trip(spark, folder).items():
        row = frame.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("rows"),
            F.count_distinct("source_row_number").alias("row_numbers"),
            F.max("source_row_number").alias("last_row_number"),
            F.lit(len(frame.drop(csv.MALFORMED).columns)).alias("columns"),
        )
        result = row if result is None else result.unionAll(row)
    return result


_RAW_SIZES = [
    ("customers", "customers", 12),
    ("accounts", "accounts", 12),
    ("transactions", "t", 23),
    ("merchants", "merchants", 8),
    ("transaction_categories", "categories", 4),
    ("branches", "branches", 7),
    ("devices", "devices", 6),
]
add(
    "io01_ingest_source_files",
    _ingested,
    over_clean(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows, count(*) AS row_numbers, count(*) AS last_row_number, {columns} AS columns FROM {table}"
            for name, table, columns in _RAW_SIZES
        )
        + " UNION ALL SELECT 'customer_segments', count(DISTINCT c_mktsegment), count(DISTINCT c_mktsegment), count(DISTINCT c_mktsegment), 5 "
        "FROM customer"
    ),
)


for _table, _clean, _same in (
    ("customers", clean_customers, "cl1_clean_customers"),
    ("accounts", clean_accounts, "cl2_clean_accounts"),
    ("transactions", clean_transactions, "cl3_clean_transactions"),
):
    add(
        f"io01_ingested_{_table}",
        lambda spark, folder, table=_table, clean=_clean: clean(_csv_round_trip(spark, folder)[table].drop(csv.MALFORMED)).drop(
            "source_row_number"
        ),
        f"SELECT * EXCLUDE (source_row_number) FROM ({ORACLE[_same]})",
    )


def _malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Part lines written as text, some with a field too many or too few, and their issues."""
    path = Staging(spark).path("customers.csv")
    lines = spark.read.parquet(f"{folder}/part.parquet").selectExpr(
        "concat_ws(',', p_partkey, p_name, p_size, CASE WHEN p_size % 10 = 3 THEN 'EXTRA' END) AS line",
        "CASE WHEN p_size % 10 = 4 THEN concat(p_partkey, ',', p_name) END AS short",
    )
    # Many files of whole lines, each with the header: one unquoted column that is named like it.
    whole = lines.selectExpr("coalesce(short, line) AS `Part Key,Name,Size`").repartition(4)
    whole.write.option("header", True).option("sep", "\x01").option("quote", "\0").csv(path)
    found = Staging(spark).save(csv.read_numbered_csv(spark, path), "numbered")
    issues = quality.malformed_line_issues({"customers": found})[0]
    return issues.select("record_identifier", "rule_name", "severity", F.col("original_value").alias("line"))


add(
    "io01_malformed_lines",
    _malformed,
    "SELECT CAST(p_partkey AS VARCHAR) AS record_identifier, 'source_line_fields' AS rule_name, 'Error' AS severity, CASE WHEN p_size % 10 = 3 THEN p_partkey || ',' || p_name || ',' || p_size || ',EXTRA' "
    "ELSE p_partkey || ',' || p_name END AS line FROM part WHERE p_size % 10 IN (3, 4)",
)


def _broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Part names with line breaks and quotes, written and read with the parameter for them."""
    path = Staging(spark).path("broken.csv")
    parts = spark.read.parquet(f"{folder}/part.parquet")
    csv.save_csv(parts.selectExpr("p_partkey", "concat(p_name, '\n\"', p_brand, '\"') AS note"), path)
    return csv.read_numbered_csv(spark, path, multi_line=True).drop("source_row_number")


add(
    "io01_quoted_line_breaks",
    _broken_lines,
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || chr(10) || '\"' || p_brand || '\"' AS note, NULL AS malformed_line FROM part",
)


def _read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns of lines written to CSV and read back."""
    path = Staging(spark).path("lines.csv")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.expr("CASE WHEN l_tax = 0 THEN '' ELSE concat('a, \"', l_linestatus, '\"') END").alias("note")
    )
    csv.save_csv(lines, path)
    return csv.read_csv(spark, path)


add(
    "io02_io04_csv_round_trip",
    _read_back,
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, "
    "CASE WHEN l_tax <> 0 THEN 'a, \"' || l_linestatus || '\"' END AS note FROM lineitem",
)
add(
    "io03_standardize_column_names",
    lambda spark, folder: standardize_column_names(
        spark.read.parquet(f"{folder}/orders.parquet").select(
            F.col("o_orderkey").alias(" Transaction ID "), F.col("o_totalprice").alias("Amount ($)"), F.col("o_orderstatus").alias("Order--Status")
        )
    ),
    "SELECT o_orderkey AS transaction_id, o_totalprice AS amount, o_orderstatus AS order_status FROM orders",
)


def _saved_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Star tables replaced in a fresh catalog database and read back by name."""
    star = warehouse(spark, folder)
    staging = Staging(spark)
    database = f"ledgerflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{staging.path('catalog')}'")
    names = ("dim_account", "dim_branch")
    csv.save_tables({name: star[name] for name in names}, database)
    return {name: spark.table(f"{database}.{name}") for name in names}


add(
    "io05_table_sink",
    lambda spark, folder: _saved_tables(spark, folder)["dim_account"],
    over_model(
        "SELECT * REPLACE (CAST(current_balance AS DOUBLE) AS current_balance, CAST(credit_limit AS DOUBLE) AS credit_limit) FROM dim_account"
    ),
)
add("io05_table_sink_branches", lambda spark, folder: _saved_tables(spark, folder)["dim_branch"], over_model("SELECT * FROM dim_branch"))
add_star(
    "io06_export_cast",
    lambda tables: csv.export_cast(
        tables["fact_transaction"].select("transaction_key", "transaction_timestamp", "is_approved", "is_recurring")
    ),
    over_model(
        "SELECT transaction_key, CAST(transaction_timestamp AS VARCHAR) AS transaction_timestamp, CAST(is_approved AS INTEGER) AS is_approved, "
        "CAST(is_recurring AS INTEGER) AS is_recurring FROM fact"
    ),
)


def _exported(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all 32 exported tables, counted in the written files."""
    star = warehouse(spark, folder)
    star.prepare()
    paths = pipeline.export_reporting_tables(star, Staging(spark).path("reporting"))
    return csv.table_row_counts({path.rsplit("/", 1)[1]: csv.read_csv(spark, path) for path in paths})


_COUNTED = {
    "dim_customer": "dim_customer",
    "dim_account": "dim_account",
    "dim_merchant": "dim_merchant",
    "dim_transaction_category": "dim_transaction_category",
    "dim_date": "dim_date",
    "dim_channel": "dim_channel",
    "dim_location": "dim_location",
    "dim_device": "dim_device",
    "dim_branch": "dim_branch",
    "dim_transaction_status": "dim_transaction_status",
    "fact_transaction": "fact",
    "fact_account_daily_balance": "daily_balance",
    "fact_customer_monthly_summary": "monthly",
    "fact_anomaly_flag": "flags",
    "fact_data_quality_issue": "issues",
}


def _counts(names: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}" for name, table in names.items())


_VIEW_SIZES = {
    "reconciliation_report": f"({RECONCILIATION})",
    "kpi_snapshot": "(SELECT 1)",
    "vw_transaction_overview": "fact",
    "vw_daily_transaction_trends": f"(SELECT DISTINCT date FROM fact {JOIN['date']})",
    "vw_monthly_transaction_trends": f"(SELECT DISTINCT month_start_date FROM fact {JOIN['date']})",
    "vw_category_performance": "(SELECT DISTINCT transaction_category_key FROM fact)",
    "vw_customer_spending_summary": "(SELECT DISTINCT customer_key FROM fact)",
    "vw_merchant_performance": "(SELECT DISTINCT merchant_key FROM fact)",
    "vw_channel_performance": "(SELECT DISTINCT channel_key FROM fact)",
    "vw_transaction_status_summary": "(SELECT DISTINCT transaction_status_key FROM fact)",
    "vw_account_activity": "(SELECT DISTINCT account_key FROM fact)",
    "vw_customer_segment_analysis": f"(SELECT DISTINCT customer_segment FROM fact {JOIN['customer']})",
    "vw_geographic_transaction_summary": "(SELECT DISTINCT location_key FROM fact)",
    "vw_anomaly_review": "flags",
    "vw_declined_transaction_analysis": f"(SELECT DISTINCT month_start_date, transaction_category_key, channel_key FROM fact {JOIN['date']})",
    "vw_data_quality_summary": "(SELECT DISTINCT source_file, rule_name, severity FROM issues)",
    "vw_executive_kpis": "(SELECT 1)",
}
add("io07_export_reporting_tables", _exported, over_everything(_counts({**_COUNTED, **_VIEW_SIZES})))


def _written(spark: SparkSession, folder: str, name: str, frame: DataFrame) -> DataFrame:
    """A table exported as CSV, read back and cast to its own types: every cell is compared."""
    (path,) = csv.export_tables({name: frame}, Staging(spark).path("cells"))
    found = csv.read_csv(spark, path)
    return found.select(*[F.col(f"`{part.name}`").cast(part.dataType).alias(part.name) for part in frame.schema])


for _view, _same in sorted((name, key) for name in VIEWS for key in ORACLE if re.fullmatch(rf"w\d\d_{name.removeprefix('vw_')}", key)):
    add(
        f"io07_cells_of_{_view}",
        lambda spark, folder, view=_view: _written(spark, folder, view, VIEWS[view](warehouse(spark, folder))),
        ORACLE[_same],
    )


def _stored_cells(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The cells of a stored table; the time of detection is that of the run, and blank fields are read as null."""
    found = _written(spark, folder, table, warehouse(spark, folder)[table].drop("detected_timestamp"))
    return found.fillna("", ["original_value"]) if "original_value" in found.columns else found


# The stored tables that have a query with all their columns.
_TABLE_CELLS = {
    **{name: next(key for key in ORACLE if re.fullmatch(rf"d\d\d_{name}", key)) for name in pipeline.DIMENSIONS},
    "fact_account_daily_balance": "f5_account_daily_balance",
    "fact_customer_monthly_summary": "f4_customer_monthly_summary",
    "fact_anomaly_flag": "f7_fact_anomaly_flag",
    "fact_data_quality_issue": "f6_fact_data_quality_issue",
    "reconciliation_report": "x9_reconciliation",
}
for _table, _same in _TABLE_CELLS.items():
    add(
        f"io07_cells_of_{_table}",
        lambda spark, folder, table=_table: _stored_cells(spark, folder, table),
        over_model("SELECT * FROM dim_date") if _table == "dim_date" else ORACLE[_same],
    )

_REPORT_CELLS = {
    "Executive Summary": "x9_executive_summary",
    "Monthly Trends": "x1_monthly_trends",
    "Category Analysis": "x2_category_analysis",
    "Customer Segments": "x3_segment_analysis",
    "Channel Analysis": "x4_channel_analysis",
    "Merchant Analysis": "x5_merchant_analysis",
    "Transaction Status": "x6_status_analysis",
    "Anomaly Review": "x7_anomaly_review_top",
    "Data Quality": "x8_quality_summary",
    "Reconciliation": "x9_reconciliation",
}
for _title, _same in _REPORT_CELLS.items():
    _name = _title.lower().replace(" ", "_")
    add(
        f"io09_cells_of_{_name}",
        lambda spark, folder, title=_title, name=_name: _written(spark, folder, name, REPORTS[title](warehouse(spark, folder)).drop("transaction_key")),
        ORACLE[_same],
    )


def _amount_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Exported amounts as the text in the file; the large ones keep all their digits."""
    large = warehouse(spark, folder)["fact_transaction"].select(
        "transaction_key", "transaction_amount", (F.col("transaction_amount") + F.lit("9007199254740993.00").cast("decimal(28,2)")).alias("large")
    )
    (path,) = csv.export_tables({"amounts": large}, Staging(spark).path("amounts"))
    return csv.read_csv(spark, path)


add(
    "io07_decimal_text",
    _amount_texts,
    over_model(
        "SELECT CAST(transaction_key AS VARCHAR) AS transaction_key, CAST(CAST(transaction_amount AS DECIMAL(28,2)) AS VARCHAR) AS transaction_amount, "
        "CAST(CAST(transaction_amount AS DECIMAL(28,2)) + CAST('9007199254740993.00' AS DECIMAL(28,2)) AS VARCHAR) AS large FROM fact"
    ),
)
add_star(
    "io08_table_and_view_counts",
    lambda tables: csv.table_row_counts(pipeline.reporting_tables(tables)),
    over_everything(_counts({**_COUNTED, **_VIEW_SIZES})),
)


def _report_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the ten report tables, counted in the written files."""
    paths = pipeline.export_reports(warehouse(spark, folder), Staging(spark).path("reports"))
    return csv.table_row_counts({path.rsplit("/", 1)[1]: csv.read_csv(spark, path) for path in paths})


add(
    "io09_report_tables",
    _report_sink,
    over_everything(
        _counts(
            {
                "executive_summary": "range(26)",
                "monthly_trends": _VIEW_SIZES["vw_monthly_transaction_trends"],
                "category_analysis": _VIEW_SIZES["vw_category_performance"],
                "customer_segments": _VIEW_SIZES["vw_customer_segment_analysis"],
                "channel_analysis": _VIEW_SIZES["vw_channel_performance"],
                "merchant_analysis": "(SELECT DISTINCT merchant_key FROM fact LIMIT 100)",
                "transaction_status": _VIEW_SIZES["vw_transaction_status_summary"],
                "anomaly_review": "(SELECT * FROM flags LIMIT 1000)",
                "data_quality": _VIEW_SIZES["vw_data_quality_summary"],
                "reconciliation": f"({RECONCILIATION})",
            }
        )
    ),
)
add_star(
    "io10_dimension_row_counts",
    pipeline.dimension_row_counts,
    over_model(_counts({name: table for name, table in _COUNTED.items() if name.startswith("dim_")})),
)
add_star(
    "io10_fact_row_counts",
    pipeline.fact_row_counts,
    over_everything(_counts({name: table for name, table in _COUNTED.items() if name.startswith("fact_")})),
)
add_star("io11_kpi_snapshot", lambda tables: tables["kpi_snapshot"], EXECUTIVE)
add_star(
    "io11_validation_summary",
    pipeline.validation_summary,
    over_everything(
        "SELECT 'data_quality_issues' AS validation_area, severity AS validation_status, count(*) AS record_count FROM issues GROUP BY ALL "
        f"UNION ALL SELECT 'reconciliation', status, count(*) FROM ({RECONCILIATION}) GROUP BY ALL"
    ),
)
_SUMMARY = {
    "raw_transaction_rows": "(SELECT count(*) FROM t)",
    "valid_analyzed_transactions": "(SELECT count(*) FROM valid)",
    "rejected_transaction_rows": "(SELECT count(*) FROM marked WHERE has_blocking_quality_issue)",
    "synthetic_customers": "(SELECT count(*) FROM customers)",
    "synthetic_accounts": "(SELECT count(*) FROM accounts)",
    "transaction_categories": "(SELECT count(DISTINCT transaction_category) FROM categories)",
    "potential_anomaly_flags": "(SELECT count(*) FROM flags)",
    "data_quality_issues": "(SELECT count(*) FROM issues)",
    "powerbi_export_files": "32",
    "excel_workbook": "'reports'",
    "database_path": "'tables'",
    "database_table_count_checks": "17",
    "database_view_count_checks": "15",
}
def _summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary after an export; the two folders, which differ from run to run, under fixed names."""
    star, staging = warehouse(spark, folder), Staging(spark)
    star.prepare()
    exported = pipeline.export_reporting_tables(star, staging.path("reporting"))
    found = pipeline.run_summary(star, exported, staging.path("reports"))
    name = F.when(F.col("value") == staging.path("reports"), "reports").when(F.col("value") == star.staging.folder, "tables")
    return found.select("metric", F.coalesce(name, F.col("value")).alias("value"))


add(
    "io12_run_summary",
    _summary,
    over_everything(
        " UNION ALL ".join(f"SELECT '{name}' AS metric, CAST({value} AS VARCHAR) AS value" for name, value in _SUMMARY.items())
    ),
)
