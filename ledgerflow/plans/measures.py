"""Named measures for any grouping by dimension attributes. Empty denominators give null."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import blank_divide, cents
from ledgerflow.operators.quantiles import exact_quantiles
from ledgerflow.plans.kpis import APP_CHANNELS
from ledgerflow.plans.rollup import (
    DIMENSION_KEYS,
    Tables,
    distinct_per_attribute,
    one_row,
    per_attribute,
    with_attributes,
)


def _rate(part: str) -> Callable[[], Column]:
    return lambda: blank_divide(F.col(part), F.col("rows"))


def _plain(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


# Measure -> (additive inputs, value)
ADDITIVE_MEASURES: dict[str, tuple[Sequence[str], Callable[[], Column]]] = {
    "total_transactions": (["rows"], _plain("rows")),
    "total_transaction_value": (["total_transaction_value"], _plain("total_transaction_value")),
    "approved_transaction_value": (["approved_transaction_value"], _plain("approved_transaction_value")),
    "average_transaction_amount": (["total_transaction_value", "rows"], _rate("total_transaction_value")),
    "approval_rate": (["approved_count", "rows"], _rate("approved_count")),
    "decline_rate": (["declined_count", "rows"], _rate("declined_count")),
    "reversal_rate": (["reversed_count", "rows"], _rate("reversed_count")),
    "debit_value": (["debit_transaction_value"], _plain("debit_transaction_value")),
    "credit_value": (["credit_transaction_value"], _plain("credit_transaction_value")),
    "net_transaction_flow": (["net_transaction_flow"], _plain("net_transaction_flow")),
    "international_transaction_rate": (
        ["international_transaction_count", "rows"],
        _rate("international_transaction_count"),
    ),
}

Attributes = Mapping[str, Sequence[str]]

DISTINCT_MEASURES = {"active_customers": "customer_key", "active_accounts": "account_key"}

def _groups(attributes: Attributes) -> list[str]:
    return [name for columns in attributes.values() for name in columns]


def additive_measures(tables: Tables, attributes: Attributes, names: Sequence[str]) -> DataFrame:
    inputs = list(dict.fromkeys(name for measure in names for name in ADDITIVE_MEASURES[measure][0]))
    totals = per_attribute(tables, attributes, inputs)
    return totals.select(*_groups(attributes), *[ADDITIVE_MEASURES[name][1]().alias(name) for name in names])


def median_amount(tables: Tables, attributes: Attributes) -> DataFrame:
    keys = [DIMENSION_KEYS[dimension] for dimension in attributes]
    amounts = tables["fact_transaction"].groupBy(*keys, cents(F.col("transaction_amount")).alias("cents"))
    described = with_attributes(amounts.agg(F.count("*").alias("times")), tables, attributes)
    medians = exact_quantiles(described, _groups(attributes), "cents", {"median_cents": 0.5}, "times")
    return medians.select(*_groups(attributes), (F.col("median_cents") / 100).alias("median_transaction_amount"))


def mobile_adoption(tables: Tables, attributes: Attributes) -> DataFrame:
    with_channel = {**attributes, "dim_channel": ["transaction_channel"]}
    totals = per_attribute(tables, with_channel, ["rows"])
    in_app = F.sum(F.when(F.col("transaction_channel").isin(*APP_CHANNELS), F.col("rows")).otherwise(0))
    rate = blank_divide(in_app, F.sum("rows")).alias("mobile_adoption_rate")
    return totals.groupBy(*_groups(attributes)).agg(rate)


REVIEW_COUNTS = ("potential_anomaly_count", "high_priority_review_count")


def anomaly_counts(tables: Tables, attributes: Attributes | None = None) -> DataFrame:
    """Flags by dimension attributes of their transactions. Flags are counted per surrogate key before the dimensions
    are joined."""
    counts = [F.count("*").alias(REVIEW_COUNTS[0]), F.count_if(F.col("review_priority") == "High").alias(REVIEW_COUNTS[1])]
    flags = tables["fact_anomaly_flag"]
    if not attributes:
        return flags.agg(*counts)
    keys = [DIMENSION_KEYS[dimension] for dimension in attributes]
    placed = flags.select("transaction_key", "review_priority").join(
        tables["fact_transaction"].select("transaction_key", *keys), "transaction_key"
    )
    described = with_attributes(placed.groupBy(*keys).agg(*counts), tables, attributes)
    return described.groupBy(*_groups(attributes)).agg(*[F.sum(name).alias(name) for name in REVIEW_COUNTS])


def measures_by(tables: Tables, attributes: Attributes, names: Sequence[str]) -> DataFrame:
    """The named measures per group. Parts are joined on the groups, whose number is small next to
    the fact; null groups match each other."""
    groups = _groups(attributes)
    parts = []
    additive_names = [name for name in names if name in ADDITIVE_MEASURES]
    if additive_names:
        parts.append(additive_measures(tables, attributes, additive_names))
    for name in names:
        if name in DISTINCT_MEASURES:
            parts.append(distinct_per_attribute(tables, attributes, DISTINCT_MEASURES[name], name))
        elif name == "median_transaction_amount":
            parts.append(median_amount(tables, attributes))
        elif name == "mobile_adoption_rate":
            parts.append(mobile_adoption(tables, attributes))
        elif name in REVIEW_COUNTS:
            parts.append(anomaly_counts(tables, attributes).select(*groups, name))
        elif name == "average_monthly_spend_per_customer":
            parts.append(average_monthly_spend(tables, attributes))
        elif name not in ADDITIVE_MEASURES:
            raise KeyError(f"no measure named {name}")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(*groups).agg(*[F.max(name).alias(name) for name in names])


def monthly_growth(tables: Tables, attributes: Attributes | None = None) -> DataFrame:
    """Value per calendar month with the month before it; months without rows stay blank.

    The calendar has a row per day, so its months fit one small window. By attributes, a group has a row for each month
    with transactions and for the one after."""
    month = "month_start_date"
    if attributes:
        return _growth_by(tables, attributes, month)
    spine = tables["dim_date"].select(month).distinct()
    totals = per_attribute(tables, {"dim_date": [month]}, ["total_transaction_value"])
    in_order = Window.orderBy(month)
    value = F.coalesce(F.col("total_transaction_value").cast("double"), F.lit(0.0))
    previous = F.col("previous_month_transaction_value").cast("double")
    return (
        spine.join(totals, month, "left")
        .withColumn("previous_month_transaction_value", F.lag("total_transaction_value").over(in_order))
        .withColumn("month_over_month_transaction_growth", blank_divide(value - previous, previous))
    )


def _growth_by(tables: Tables, attributes: Attributes, month: str) -> DataFrame:
    name, groups = "total_transaction_value", _groups(attributes)
    calendar = {**attributes, "dim_date": [*attributes.get("dim_date", []), month]}
    totals = per_attribute(tables, calendar, [name])
    moved = totals.select(*groups, F.add_months(month, 1).alias(month), F.lit(None).alias(name), F.col(name).alias("before"))
    spine = tables["dim_date"].select(month).distinct()
    both = totals.withColumn("before", F.lit(None)).unionByName(moved.join(spine, month, "left_semi"))
    rows = both.groupBy(*groups, month).agg(F.max(name).alias(name), F.max("before").alias("previous_month_transaction_value"))
    value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    previous = F.col("previous_month_transaction_value").cast("double")
    return rows.withColumn("month_over_month_transaction_growth", blank_divide(value - previous, previous))


def average_monthly_spend(tables: Tables, attributes: Attributes | None = None) -> DataFrame:
    """Mean of the customers' monthly spend, over all or by attributes of the customer."""
    spend, monthly = F.col("debit_transaction_value"), tables["fact_customer_monthly_summary"]
    if set(attributes or ()) - {"dim_customer"}:
        raise KeyError("monthly spend is known by customer attributes only")
    sums = monthly.groupBy("customer_key").agg(F.sum(spend).alias("spend"), F.count(spend).alias("months"))
    described = with_attributes(sums, tables, attributes or {})
    mean = blank_divide(F.sum("spend"), F.sum("months")).alias("average_monthly_spend_per_customer")
    return described.groupBy(*_groups(attributes or {})).agg(mean)


def headline_measures(tables: Tables) -> DataFrame:
    """Measures of the flag and summary facts side by side."""
    return one_row([anomaly_counts(tables), average_monthly_spend(tables)])
