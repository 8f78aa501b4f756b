"""Raw text tables to typed tables, one select per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import parsing as parse
from ledgerflow.functions import text

Rules = Mapping[str, Callable[[Column], Column]]

CUSTOMER_RULES: Rules = {
    "customer_id": text.upper_clean,
    "customer_display_name": text.title_clean,
    "age_group": text.clean_text,
    "city": text.title_clean,
    "state": text.upper_clean,
    "customer_segment": text.title_clean,
    "account_tenure_months": parse.parse_integer,
    "join_date": parse.parse_date,
    "preferred_channel": text.normalize_channel,
    "risk_tier": text.title_clean,
    "income_band": text.clean_text,
}

ACCOUNT_RULES: Rules = {
    "account_id": text.upper_clean,
    "customer_id": text.upper_clean,
    "account_type": text.normalize_account_type,
    "open_date": parse.parse_date,
    "account_status": text.title_clean,
    "close_date": parse.parse_date,
    "current_balance": parse.parse_currency,
    "credit_limit": parse.parse_currency,
    "branch_id": text.upper_clean,
    "currency": text.normalize_currency,
    "product_tier": text.title_clean,
}

TRANSACTION_RULES: Rules = {
    "transaction_id": text.upper_clean,
    "account_id": text.upper_clean,
    "customer_id": text.upper_clean,
    "merchant_id": text.upper_clean,
    "transaction_date": parse.parse_date,
    "transaction_timestamp": parse.parse_timestamp,
    "transaction_amount": parse.parse_currency,
    "transaction_category": text.normalize_category,
    "transaction_type": text.normalize_transaction_type,
    "transaction_status": text.normalize_status,
    "transaction_channel": text.normalize_channel,
    "device_id": text.upper_clean,
    "branch_id": text.upper_clean,
    "city": text.title_clean,
    "state": text.upper_clean,
    "currency": text.normalize_currency,
    "debit_credit_indicator": text.title_clean,
    "description": text.clean_text,
    "is_international": parse.parse_bool,
    "is_recurring": parse.parse_bool,
    "balance_after_transaction": parse.parse_currency,
    "synthetic_anomaly_flag": parse.parse_bool,
}

REFERENCE_RULES: Rules = {
    "city": text.title_clean,
    "region": text.title_clean,
    "branch_name": text.title_clean,
    "merchant_name": text.title_clean,
    "category_group": text.title_clean,
    "segment_name": text.title_clean,
    "transaction_category": text.normalize_category,
    "merchant_category": text.normalize_category,
    "state": text.upper_clean,
    "is_online_only": parse.parse_bool,
    "trusted_device": parse.parse_bool,
}


def _keep(value: Column) -> Column:
    return value


def _apply(frame: DataFrame, rule_of: Callable[[str], Callable[[Column], Column]]) -> DataFrame:
    return frame.select(*[rule_of(name)(F.col(name)).alias(name) for name in frame.columns])


def _clean_fixed(frame: DataFrame, rules: Rules) -> DataFrame:
    missing = [name for name in rules if name not in frame.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return _apply(frame, lambda name: rules.get(name, _keep))


def clean_customers(customers: DataFrame) -> DataFrame:
    return _clean_fixed(customers, CUSTOMER_RULES)


def clean_accounts(accounts: DataFrame) -> DataFrame:
    return _clean_fixed(accounts, ACCOUNT_RULES)


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Needs ``source_row_number``, which the scan assigns."""
    return _clean_fixed(transactions, TRANSACTION_RULES)


def clean_reference_table(frame: DataFrame) -> DataFrame:
    """Rules by column name, for tables of any shape."""

    def rule_of(name: str) -> Callable[[Column], Column]:
        if name == "source_row_number":
            return _keep
        if name.endswith("_id"):
            return text.upper_clean
        return REFERENCE_RULES.get(name, _keep if "date" in name else text.clean_text)

    return _apply(frame, rule_of)


def clean_datasets(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    own = {"customers": clean_customers, "accounts": clean_accounts, "transactions": clean_transactions}
    return {name: own.get(name, clean_reference_table)(frame) for name, frame in raw.items()}
