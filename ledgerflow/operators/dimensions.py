"""Dimension tables of the star model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.functions import numbers, text
from ledgerflow.operators.numbering import first_wins, number_by_position, with_unknown_member
from ledgerflow.settings import Settings

# Columns of the dimensions that copy a cleaned table.
CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_display_name",
    "age_group",
    "city",
    "state",
    "customer_segment",
    "account_tenure_months",
    "join_date",
    "preferred_channel",
    "risk_tier",
    "income_band",
)
ACCOUNT_COLUMNS = (
    "account_id",
    "customer_id",
    "account_type",
    "open_date",
    "account_status",
    "close_date",
    "current_balance",
    "credit_limit",
    "branch_id",
    "currency",
    "product_tier",
)
MERCHANT_COLUMNS = ("merchant_id", "merchant_name", "merchant_category", "city", "state", "region", "is_online_only")
CATEGORY_COLUMNS = ("category_id", "transaction_category", "category_group")
DEVICE_COLUMNS = ("device_id", "customer_id", "device_type", "operating_system", "trusted_device")
BRANCH_COLUMNS = ("branch_id", "branch_name", "city", "state", "region", "branch_type")


def build_dim_date(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day; no Unknown member."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    day = F.col("date")
    return days.select(
        numbers.date_key(day).alias("date_key"),
        "date",
        F.year(day).alias("year"),
        numbers.quarter_label(day).alias("quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        numbers.month_start(day).alias("month_start_date"),
        F.weekofyear(day).alias("week_number"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        numbers.is_weekend(day).alias("is_weekend"),
    )


def entity_dimension(table: DataFrame, key: str, business_key: str, columns: Sequence[str]) -> DataFrame:
    """First row per business key, numbered in source order, with the Unknown member."""
    rows = first_wins(table, business_key).select("source_row_number", *columns)
    numbered = number_by_position(rows, key, "source_row_number").select(key, *columns)
    return with_unknown_member(numbered, key)


def name_dimension(transactions: DataFrame, key: str, column: str) -> DataFrame:
    """Sorted distinct names of a controlled vocabulary: validation bounds them to a few rows."""
    names = transactions.select(column).where(F.col(column).isNotNull()).distinct()
    number = F.row_number().over(Window.orderBy(column)).cast("bigint")
    return with_unknown_member(names.select(number.alias(key), column), key)


def places_of(sources: Sequence[DataFrame]) -> DataFrame:
    """Distinct (city, state) with the first source and row that has them.

    Places are merged per source before their first rows are compared, so only distinct places are numbered."""
    places = None
    for order, source in enumerate(sources):
        found = source.groupBy("city", "state").agg(F.min("source_row_number").alias("first_row"))
        found = found.withColumn("source", F.lit(order))
        places = found if places is None else places.unionByName(found)
    seen = places.groupBy("city", "state").agg(F.min(F.struct("source", "first_row")).alias("seen"))
    return seen.select("city", "state", "seen.source", "seen.first_row")


def location_dimension(seen: DataFrame) -> DataFrame:
    """Places in order of first appearance, with their regions; numbering reads its input twice."""
    numbered = number_by_position(seen, "location_key", "first_row", stage="source")
    described = numbered.select(
        "location_key",
        "city",
        "state",
        text.region_of_state(F.col("state")).alias("region"),
        text.location_business_key(F.col("city"), F.col("state")).alias("location_business_key"),
    )
    return with_unknown_member(described, "location_key")


def dim_customer(tables: Mapping[str, DataFrame]) -> DataFrame:
    return entity_dimension(tables["customers"], "customer_key", "customer_id", CUSTOMER_COLUMNS)


def dim_account(tables: Mapping[str, DataFrame]) -> DataFrame:
    return entity_dimension(tables["accounts"], "account_key", "account_id", ACCOUNT_COLUMNS)


def dim_merchant(tables: Mapping[str, DataFrame]) -> DataFrame:
    return entity_dimension(tables["merchants"], "merchant_key", "merchant_id", MERCHANT_COLUMNS)


def dim_transaction_category(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per category name, not per id."""
    source = tables["transaction_categories"]
    return entity_dimension(source, "transaction_category_key", "transaction_category", CATEGORY_COLUMNS)


def dim_channel(tables: Mapping[str, DataFrame]) -> DataFrame:
    return name_dimension(tables["valid_transactions"], "channel_key", "transaction_channel")


def dim_transaction_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    return name_dimension(tables["valid_transactions"], "transaction_status_key", "transaction_status")


def dim_device(tables: Mapping[str, DataFrame]) -> DataFrame:
    return entity_dimension(tables["devices"], "device_key", "device_id", DEVICE_COLUMNS)


def dim_branch(tables: Mapping[str, DataFrame]) -> DataFrame:
    return entity_dimension(tables["branches"], "branch_key", "branch_id", BRANCH_COLUMNS)


def places(tables: Mapping[str, DataFrame]) -> DataFrame:
    return places_of(
        [
            tables["valid_transactions"],
            first_wins(tables["customers"], "customer_id"),
            first_wins(tables["merchants"], "merchant_id"),
            first_wins(tables["branches"], "branch_id"),
        ]
    )


def dim_location(tables: Mapping[str, DataFrame]) -> DataFrame:
    return location_dimension(places(tables))


def dim_date(tables: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    spark = tables["valid_transactions"].sparkSession
    return build_dim_date(spark, settings.start_date, settings.end_date)


BUILDERS = {
    "dim_customer": dim_customer,
    "dim_account": dim_account,
    "dim_merchant": dim_merchant,
    "dim_transaction_category": dim_transaction_category,
    "dim_channel": dim_channel,
    "dim_location": dim_location,
    "dim_device": dim_device,
    "dim_branch": dim_branch,
    "dim_transaction_status": dim_transaction_status,
}


def build_dimensions(tables: Mapping[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    built = {name: build(tables) for name, build in BUILDERS.items()}
    built["dim_date"] = dim_date(tables, settings)
    return built
