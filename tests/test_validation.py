"""Data-quality rules, split and issue log."""

from datetime import date, datetime
from decimal import Decimal

from fixtures import ROWS, table, tables

from ledgerflow.operators import quality
from ledgerflow.settings import Settings

SETTINGS = Settings(end_date=date(2024, 12, 31), detected_timestamp="2025-01-01T00:00:00+00:00")
VALID = ROWS["transactions"]


def validate(spark, *transactions, **others):
    return quality.validate_datasets(tables(spark, transactions=transactions or ({},), **others), SETTINGS)


def rules_of(validated):
    return [row.rule_name for row in validated["data_quality_issues"].orderBy("issue_id").collect()]


def test_repeated_ids_flag_every_copy(spark):
    frame = spark.createDataFrame([("TXN1",), ("TXN1",), ("TXN2",), (None,), (None,)], "transaction_id string")
    marked = quality.mark_repeated(frame, "transaction_id", "repeated").collect()
    assert sorted((row.transaction_id or "", row.repeated) for row in marked) == [
        ("", False), ("", False), ("TXN1", True), ("TXN1", True), ("TXN2", False)]


def test_valid_row_has_no_issue(spark):
    validated = validate(spark)
    assert validated["data_quality_issues"].count() == 0
    assert validated["valid_transactions"].count() == 1
    assert validated["rejected_transactions"].count() == 0


BLOCKING = [
    (dict(transaction_amount=Decimal("0.00")), "transaction_amount_not_zero"),
    (dict(transaction_amount=Decimal("-1.00")), "purchase_amount_positive"),
    (dict(transaction_amount=None), "transaction_amount_numeric"),
    (dict(transaction_id=None), "transaction_id_present"),
    (dict(merchant_id="MER9"), "merchant_id_exists"),
    (dict(merchant_id=None), "merchant_id_exists"),
    (dict(account_id="ACC9"), "account_id_exists"),
    (dict(account_id=None), "account_id_exists"),
    (dict(transaction_date=None), "transaction_date_valid"),
    (dict(transaction_timestamp=None), "transaction_timestamp_valid"),
    (dict(transaction_category="Gambling"), "transaction_category_valid"),
    (dict(transaction_category="Travel"), "transaction_category_valid"),
    (dict(transaction_type="Barter"), "transaction_type_valid"),
    (dict(transaction_status=None), "transaction_status_valid"),
    (dict(transaction_channel="Fax", device_id=None), "transaction_channel_valid"),
    (dict(currency="EUR"), "currency_supported"),
    (dict(branch_id="BR999"), "branch_id_exists"),
    (dict(balance_after_transaction=None), "balance_numeric"),
    (dict(transaction_date=date(2023, 12, 31)), "transaction_date_in_reporting_range"),
]


def by_record(validated):
    found = {}
    for row in validated["data_quality_issues"].orderBy("issue_id").collect():
        found.setdefault(row.record_identifier, []).append(row.rule_name)
    return found


def test_blocking_rules(spark):
    """One row per case: the rules of a row do not depend on the other rows."""
    changes = [{"transaction_id": f"T{at}", **change} for at, (change, _) in enumerate(BLOCKING, 1)]
    validated = validate(spark, *changes)
    found = by_record(validated)
    for at, (change, rule) in enumerate(BLOCKING, 1):
        record = f"T{at}" if change.get("transaction_id", "T") else f"row_{at}"
        before_opening = ["transaction_after_account_open"] if change.get("transaction_date") == date(2023, 12, 31) else []
        assert found[record] == [*before_opening, rule], change
    assert validated["valid_transactions"].count() == 0
    assert validated["rejected_transactions"].where("has_blocking_quality_issue").count() == len(BLOCKING)


WARNINGS = [
    (dict(device_id=None), ["device_expected_for_digital_transaction"]),
    (dict(device_id="DEV9"), ["device_id_exists"]),
    (dict(transaction_channel="ATM"), ["branch_required_for_channel"]),
    (dict(transaction_channel="ATM", branch_id="BR001", device_id=None), []),
]


def test_warnings_do_not_block(spark):
    validated = validate(spark, *[{"transaction_id": f"T{at}", **change} for at, (change, _) in enumerate(WARNINGS)])
    assert by_record(validated) == {f"T{at}": rules for at, (_, rules) in enumerate(WARNINGS) if rules}
    assert validated["valid_transactions"].count() == len(WARNINGS)


def test_unknown_customer_hides_no_other_rule(spark):
    validated = validate(spark, dict(customer_id=None))
    assert rules_of(validated) == ["customer_id_exists", "account_belongs_to_customer"]


def test_range_ends_and_account_days_are_inclusive(spark):
    closed = dict(account_status="Closed", close_date=date(2024, 3, 1))
    days = [date(2024, 1, 1), date(2024, 3, 1), date(2024, 3, 2)]
    changes = [dict(transaction_id=f"T{at}", transaction_date=day) for at, day in enumerate(days)]
    validated = validate(spark, *changes, accounts=(closed,))
    assert rules_of(validated) == ["transaction_before_account_close"]
    assert validated["valid_transactions"].count() == 2


def test_first_of_repeated_accounts_decides(spark):
    validated = validate(spark, {}, accounts=({}, dict(customer_id="CUST2", source_row_number=2)))
    assert rules_of(validated) == ["account_customer_exists"]
    assert validated["valid_transactions"].count() == 1


def test_log_is_numbered_in_order_of_detection(spark):
    validated = validate(
        spark,
        dict(transaction_id="T9", transaction_amount=None, currency="EUR"),
        dict(transaction_id=None, transaction_timestamp=datetime(2024, 2, 1)),
        customers=({}, dict(customer_segment=None, source_row_number=2)),
        accounts=(dict(branch_id=None, account_type="Loan"),),
    )
    log = validated["data_quality_issues"].orderBy("issue_id").collect()
    assert [(row.issue_id, row.rule_name, row.record_identifier) for row in log] == [
        ("DQI0000001", "duplicate_customer_id", "CUST000001"),
        ("DQI0000002", "duplicate_customer_id", "CUST000001"),
        ("DQI0000003", "valid_customer_segment", "CUST000001"),
        ("DQI0000004", "valid_account_type", "ACC000001"),
        ("DQI0000005", "account_branch_exists", "ACC000001"),
        ("DQI0000006", "transaction_amount_numeric", "T9"),
        ("DQI0000007", "currency_supported", "T9"),
        ("DQI0000008", "transaction_id_present", "row_2"),
    ]
    assert {row.original_value for row in log if row.rule_name == "transaction_amount_numeric"} == {""}
    assert {row.resolution_status for row in log} == {"Open"}
    assert {row.detected_timestamp for row in log} == {"2025-01-01T00:00:00+00:00"}


def test_missing_columns_are_found_in_the_schema(spark):
    raw = {name: table(spark, name) for name in ("transactions", "customers", "accounts")}
    raw["accounts"] = raw["accounts"].drop("branch_id")
    assert quality.required_column_issues(raw) == [("accounts", "branch_id")]


def test_belongs_to_customer(spark):
    rows = spark.createDataFrame([("CUST1", "CUST2"), ("CUST1", "CUST1")], "owner string, customer string")
    same = quality.belongs_to_customer(rows.owner, rows.customer)
    assert [row[0] for row in rows.select(same).collect()] == [False, True]


def test_empty_transactions(spark):
    cleaned = tables(spark)
    cleaned["transactions"] = cleaned["transactions"].limit(0)
    validated = quality.validate_datasets(cleaned, SETTINGS)
    assert validated["valid_transactions"].count() == 0
    assert validated["data_quality_issues"].count() == 0
