"""Scalar functions and table cleaning."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import numbers, parsing, text
from ledgerflow.operators import cleaning


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"at int, value {kind}")
    return [row[1] for row in rows.select("at", function(F.col("value"))).orderBy("at").collect()]


def test_column_names_become_snake_case(spark):
    frame = spark.createDataFrame([("a", "b", "c")], [" Transaction ID ", "Customer Name", "Amount ($)"])
    assert text.standardize_column_names(frame).columns == ["transaction_id", "customer_name", "amount"]


def test_category_status_and_channel_spellings(spark):
    assert apply(spark, text.normalize_category, [" dinning ", "ATM Withdrawal", "health-care", None, " "]) == [
        "Dining", "Cash Withdrawal", "Healthcare", None, None]
    assert apply(spark, text.normalize_status, [" apprved ", "on-hold"]) == ["Approved", "On-Hold"]
    assert apply(spark, text.normalize_channel, ["POS", "point-of-sale", "auto_payment"]) == [
        "Point of Sale", "Point of Sale", "Automatic Payment"]
    assert apply(spark, text.normalize_transaction_type, ["automatic  payment", "cash-withdrawal"]) == ["Bill Payment", "ATM Withdrawal"]
    assert apply(spark, text.normalize_account_type, ["credit_card"]) == ["Credit Card"]
    assert apply(spark, text.normalize_currency, [" usd ", ""]) == ["USD", None]


@pytest.mark.parametrize("value", ["o'neil", "point-of-sale", "3m shop", "ÉCOLE d'été", "a1b2 c", "  two   words\t"])
def test_title_case_matches_python(spark, value):
    assert apply(spark, text.title_clean, [value]) == [" ".join(value.split()).title()]


def test_clean_text(spark):
    assert apply(spark, text.clean_text, ["  a \n b ", "   ", None, " x y"]) == ["a b", None, None, "x y"]


def test_currency(spark):
    values = ["$1,234.50", "(25.00)", "", None, " 12 USD ", "5 usd", "abc", "inf", "1_000", "1e2", "(-5)", "."]
    expected = ["1234.50", "-25.00", None, None, "12.00", None, None, None, None, "100.00", None, None]
    assert apply(spark, parsing.parse_currency, values) == [None if value is None else Decimal(value) for value in expected]


def test_plain_amount_reads_no_brackets_and_no_currency(spark):
    assert apply(spark, parsing.parse_plain_amount, ["$1,000.00", "(5)", "5 USD"]) == [Decimal("1000.00"), None, None]


def test_mixed_dates(spark):
    values = ["2024-01-05", "02/10/2024", "Mar 15, 2024", "13/02/2024", "2024-1-5 10:11:12", "never", "", None]
    assert apply(spark, parsing.parse_date, values) == [
        date(2024, 1, 5), date(2024, 2, 10), date(2024, 3, 15), date(2024, 2, 13), date(2024, 1, 5), None, None, None]


def test_mixed_timestamps_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        values = ["2024-03-10 02:30:00", "03/10/2024 02:30:00", "Mar 10, 2024 02:30:00", "x"]
        assert apply(spark, parsing.parse_timestamp, values) == [datetime(2024, 3, 10, 2, 30)] * 3 + [None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bool_and_integer(spark):
    assert apply(spark, parsing.parse_bool, ["TRUE", " y ", "1", "on", "", None]) == [True, True, True, False, False, False]
    assert apply(spark, parsing.parse_integer, ["12", " 7 ", "x", "", None]) == [12, 7, None, None, None]


def test_numbers_beyond_the_places_of_an_amount(spark):
    values = ["1e-10", "0.000000001", "-1e-30", "(0.0000000001)", "$0.00", "0e5", "-0", "1e40", "-1e40", "0.000000015", "1e-8", "+2e-9"]
    step, limit = Decimal("0.00000001"), Decimal("9" * 30)
    assert apply(spark, parsing.parse_currency, values) == [step, step, -step, -step, 0, 0, 0, limit, limit.copy_negate(), 2 * step, step, step]
    assert apply(spark, parsing.parse_integer, ["1e-10", "0.000000001", "12.000000001", "12.0", "1e2", "-7.00", "9007199254740993", "9007199254740993.5", "1e30"]) == [
        None, None, None, 12, 100, -7, 9007199254740993, None, None]


def test_dates_with_names_of_days_and_without_days(spark):
    values = ["Friday, March 15, 2024", "Fri, 15 Mar 2024", "fri 2024-03-15", "Thurs. 03/14/2024", "March 2024", "Sept. 2024", "Mar-2024", "Mon, Tue", "Smarch 2024", "Friday"]
    expected = [date(2024, 3, 15)] * 3 + [date(2024, 3, 14), date(2024, 3, 1), date(2024, 9, 1), date(2024, 3, 1), None, None, None]
    assert apply(spark, parsing.parse_date, values) == expected
    moments = ["Friday, March 15, 2024 1:30 PM", "Sat, 16 Mar 2024 08:00:01", "March 2024"]
    assert apply(spark, parsing.parse_timestamp, moments) == [datetime(2024, 3, 15, 13, 30), datetime(2024, 3, 16, 8, 0, 1), datetime(2024, 3, 1)]


def test_whole_units_round_ties_to_even(spark):
    values = [Decimal("24.50"), Decimal("25.50"), Decimal("0.50"), Decimal("25.40")]
    assert [int(value) for value in apply(spark, numbers.whole_units, values, "decimal(18,2)")] == [24, 26, 0, 25]


def test_divisions(spark):
    row = spark.range(1).select(
        numbers.safe_divide(F.lit(1), F.lit(0)).alias("safe"), numbers.blank_divide(F.lit(1), F.lit(0)).alias("blank"),
        numbers.rounded_ratio(F.lit(Decimal("2.01")), F.lit(2), 2).alias("tie"),
    ).first()
    assert (row.safe, row.blank, row.tie) == (0.0, None, 1.01)


def test_labels(spark):
    assert apply(spark, text.pretty_label, ["balance_issue"]) == ["Balance Issue"]
    assert apply(spark, text.currency_label, [1234.5, -1234.0, 2.5], "double") == ["$1,234", "$-1,234", "$2"]
    assert apply(spark, text.percent_label, [0.074, 10.523], "double") == ["7.4%", "1052.3%"]


def test_region_and_location_key(spark):
    assert apply(spark, text.region_of_state, ["TX", "INT", "ZZ", None]) == ["South", "International", "Unknown", "Unknown"]
    rows = spark.createDataFrame([("Dallas", None)], "city string, state string")
    assert rows.select(text.location_business_key(F.col("city"), F.col("state"))).first()[0] == "Dallas|None"


def test_reference_table_rules_go_by_column_name(spark):
    frame = spark.createDataFrame(
        [(1, " mer1 ", "joe's shop", "dinning", "new york", "ny", "YES", " keep ")],
        "source_row_number bigint, merchant_id string, merchant_name string, merchant_category string, city string, "
        "state string, is_online_only string, update_date string",
    )
    assert tuple(cleaning.clean_reference_table(frame).first()) == (
        1, "MER1", "Joe'S Shop", "Dining", "New York", "NY", True, " keep ")


def test_missing_column_is_an_error(spark):
    with pytest.raises(KeyError, match="customer_segment"):
        cleaning.clean_customers(spark.createDataFrame([("C1",)], ["customer_id"]))


def test_single_spaces_are_left_alone_and_all_others_are_found(spark):
    """Every white-space character, alone, at an end or in a run, gives one space or none."""
    values = [f"{lead}ab{gap}c{tail}" for gap in (" ", *text.WHITESPACE, "  ", " \t") for lead, tail in (("", ""), (" ", "\t"), ("\u3000", " "))]
    assert apply(spark, text.clean_text, values) == ["ab c"] * len(values)
    assert apply(spark, text.strip, values) == [value.strip() for value in values]


def test_short_date_spellings_are_read_by_place(spark):
    """The two frequent spellings do not go through the patterns, and other texts of their shape stay what they were."""
    values = ["02/10/2024", "31/12/2024", "13/13/2024", "Sep 05, 2024", "sep 31, 2024", "xyz 05, 2024", "Mon 05, 2024", "Mar 05, 2024\u2028"]
    expected = [date(2024, 2, 10), date(2024, 12, 31), None, date(2024, 9, 5), None, None, None, date(2024, 3, 5)]
    assert apply(spark, parsing.parse_date, values) == expected
    short = spark.createDataFrame([(value,) for value in values], "value string").select(parsing._short_spelling(F.col("value"), "date"))
    assert [row[0] for row in short.collect()] == [*expected[:7], None]
