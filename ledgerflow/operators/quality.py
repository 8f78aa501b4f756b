"""Data-quality rules, the issue log and the valid / rejected split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import vocabulary as words
from ledgerflow.functions.parsing import amount_text
from ledgerflow.functions.text import numbered_id
from ledgerflow.operators.numbering import first_wins, merged, merged_if_large, number_by_position, sent_if_small
from ledgerflow.settings import Settings
from ledgerflow.sources.csv import MALFORMED

# Columns each source must have.
REQUIRED_COLUMNS = {
    "transactions": (
        "transaction_id",
        "account_id",
        "customer_id",
        "merchant_id",
        "transaction_date",
        "transaction_timestamp",
        "transaction_amount",
        "transaction_category",
        "transaction_type",
        "transaction_status",
        "transaction_channel",
        "currency",
        "debit_credit_indicator",
        "balance_after_transaction",
    ),
    "customers": ("customer_id", "customer_segment", "join_date"),
    "accounts": ("account_id", "customer_id", "account_type", "open_date", "account_status", "branch_id"),
}

# Rule names in order of detection, with the description that goes into the log.
DESCRIPTIONS = {
    "duplicate_customer_id": "Duplicate customer record found",
    "valid_customer_segment": "Customer segment is not in the configured segment list",
    "account_customer_exists": "Account references a customer that does not exist",
    "valid_account_type": "Account type is not valid",
    "account_branch_exists": "Account references a branch that does not exist",
    "transaction_id_present": "Transaction ID is missing",
    "transaction_id_unique": "Transaction ID is duplicated",
    "customer_id_exists": "Customer ID does not exist",
    "account_id_exists": "Account ID does not exist",
    "account_belongs_to_customer": "Account does not belong to the listed customer",
    "transaction_after_account_open": "Transaction date is before account open date",
    "transaction_before_account_close": "Transaction occurs after the account close date",
    "merchant_id_exists": "Merchant ID does not exist",
    "transaction_amount_numeric": "Transaction amount is not numeric",
    "transaction_amount_not_zero": "Transaction amount is zero",
    "purchase_amount_positive": "Transaction amount should be positive with debit or credit direction stored separately",
    "transaction_date_valid": "Transaction date is not valid",
    "transaction_date_in_reporting_range": "Transaction date is outside the configured reporting range",
    "transaction_timestamp_valid": "Transaction timestamp is not valid",
    "transaction_category_valid": "Transaction category is not valid",
    "transaction_type_valid": "Transaction type is not valid",
    "transaction_status_valid": "Transaction status is not valid",
    "transaction_channel_valid": "Transaction channel is not valid",
    "currency_supported": "Currency is not supported",
    "branch_id_exists": "Branch ID does not exist",
    "branch_required_for_channel": "Branch or ATM transactions should include a branch ID",
    "device_id_exists": "Device ID does not exist",
    "device_expected_for_digital_transaction": "Digital transactions usually include a device ID",
    "balance_numeric": "Balance after transaction is not numeric",
}

AMOUNT_COLUMNS = ("transaction_amount", "balance_after_transaction")

ISSUE_SCHEMA = (
    "stage int, source_row_number bigint, rule_order int, source_file string, record_identifier string, "
    "column_name string, rule_name string, severity string, description string, original_value string"
)
LOG_COLUMNS = (
    "source_file",
    "record_identifier",
    "column_name",
    "rule_name",
    "severity",
    "description",
    "original_value",
)
# (flag, column of the transaction, cleaned table, its business key, dimension, surrogate key, columns the rules need)
LOOKUPS = (
    ("account_known", "account_id", "accounts", "account_id", "dim_account", "account_key",
     ("customer_id", "open_date", "close_date", "account_status")),
    ("customer_known", "customer_id", "customers", "customer_id", "dim_customer", "customer_key", ()),
    ("merchant_known", "merchant_id", "merchants", "merchant_id", "dim_merchant", "merchant_key", ()),
    ("branch_known", "branch_id", "branches", "branch_id", "dim_branch", "branch_key", ()),
    ("device_known", "device_id", "devices", "device_id", "dim_device", "device_key", ()),
    ("category_known", "transaction_category", "transaction_categories", "transaction_category",
     "dim_transaction_category", "transaction_category_key", ()),
)
KEY_COLUMNS = tuple(key for *_, key, _ in LOOKUPS)

# The ids of a transaction whose lookup tables grow with the customers: many transactions share them, so each combination is
# looked up once.
PARTY_COLUMNS = ("account_id", "customer_id", "device_id")

# Those of them that decide whether a transaction is valid.
OWNER_COLUMNS = ("account_id", "customer_id")

# The rules on them.
OWNER_RULES = (
    "customer_id_exists",
    "account_id_exists",
    "account_belongs_to_customer",
    "transaction_after_account_open",
    "transaction_before_account_close",
)

# Rules that need another lookup table or the other rows. The rest are settled by the row itself.
LOOKED_UP_RULES = (
    "transaction_id_unique",
    "merchant_id_exists",
    "transaction_category_valid",
    "branch_id_exists",
    "device_id_exists",
)

# What the model and the review rules read of a valid transaction.
MODEL_COLUMNS = (
    "transaction_id",
    "account_id",
    "customer_id",
    "merchant_id",
    "transaction_date",
    "transaction_timestamp",
    "transaction_amount",
    "transaction_category",
    "transaction_status",
    "transaction_channel",
    "device_id",
    "branch_id",
    "city",
    "state",
    "debit_credit_indicator",
    "is_international",
    "is_recurring",
    "balance_after_transaction",
    "synthetic_anomaly_flag",
)

# Issues per row are few, so ranges of this many rows stay small after the explode.
ISSUE_RANGE_BITS = 15


@dataclass(frozen=True)
class Rule:
    """One check: ``fails`` is true on a bad row, null counts as passed."""

    name: str
    column: str
    fails: Column
    severity: str = "Error"
    blocking: bool = False

    @property
    def description(self) -> str:
        return DESCRIPTIONS[self.name]


def failed_rules(rules: Sequence[Rule]) -> Column:
    """The failed rules of a row as bits of one number, the first rule in the lowest bit.

    The number is stored with the row; texts are only made for rows that go into the issue log."""
    bits = [F.when(rule.fails, F.lit(1 << at)).otherwise(F.lit(0)) for at, rule in enumerate(rules)]
    return reduce(Column.bitwiseOR, bits).cast("bigint")


def _bits(rules: Sequence[Rule], blocking: bool) -> int:
    return sum(1 << at for at, rule in enumerate(rules) if rule.blocking == blocking)


def _shown(column: str) -> Column:
    return amount_text(F.col(column)) if column in AMOUNT_COLUMNS else F.col(column).cast("string")


def failures(rules: Sequence[Rule]) -> Column:
    """The failed rules of a checked row as an array of structs, in rule order."""
    cells = [
        F.when(
            F.col("failed_rules").bitwiseAND(F.lit(1 << at)) != 0,
            F.struct(
                F.lit(at).alias("rule_order"),
                F.lit(rule.column).alias("column_name"),
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.description).alias("description"),
                F.coalesce(_shown(rule.column), F.lit("")).alias("original_value"),
            ),
        )
        for at, rule in enumerate(rules)
    ]
    return F.array_compact(F.array(*cells))


def is_member(value: Column, names: Iterable[str]) -> Column:
    """Membership in a short fixed list; null is no member."""
    return F.coalesce(value.isin(*names), F.lit(False))


def mark_known(frame: DataFrame, column: str, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Adds a flag: the column's value occurs among the keys. A null value never does."""
    known = keys.select(F.col(key).alias("known_key")).where("known_key is not null").distinct()
    marked = frame.join(known, F.col(column) == F.col("known_key"), "left")
    return marked.withColumn(flag, F.col("known_key").isNotNull()).drop("known_key")


def repeated_values(frame: DataFrame, column: str) -> DataFrame:
    """The values that occur more than once. Counting combines copies before the shuffle; a window
    over the value would gather all copies of a heavy one in a task."""
    return (
        frame.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("repeated_value"))
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
        .select("repeated_value")
    )


def mark_repeated(frame: DataFrame, column: str, flag: str, repeated: DataFrame | None = None) -> DataFrame:
    """Adds a flag on every copy of a value that occurs more than once.

    ``repeated`` may hold the ``repeated_values`` as a stored table: its size then tells Spark
    whether the rows have to be shuffled to find them."""
    values = repeated_values(frame, column) if repeated is None else repeated
    marked = frame.join(values, F.col(column) == F.col("repeated_value"), "left")
    return marked.withColumn(flag, F.col("repeated_value").isNotNull()).drop("repeated_value")


def required_column_issues(tables: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """``(table, column)`` for every required column that is absent; reads schemas only."""
    return [
        (table, column)
        for table, columns in REQUIRED_COLUMNS.items()
        for column in columns
        if column not in tables[table].columns
    ]


def malformed_line_issues(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """One issue for each source line with more or fewer fields than its header, for the tables that were read from
    such files, under the line's first field. The row itself stays, with the fields it has."""
    found = []
    for at, table in enumerate(tables):
        frame = tables[table]
        if MALFORMED in frame.columns:
            number = F.col("source_row_number")
            first = F.col(next(name for name in frame.columns if name not in ("source_row_number", MALFORMED)))
            found.append(
                frame.where(F.col(MALFORMED).isNotNull()).select(
                    F.lit(0).alias("stage"),
                    number.cast("bigint").alias("source_row_number"),
                    F.lit(1 + at).alias("rule_order"),
                    F.lit(f"{table}.csv").alias("source_file"),
                    F.coalesce(first, F.concat(F.lit("row_"), number.cast("string"))).alias("record_identifier"),
                    F.lit("LINE").alias("column_name"),
                    F.lit("source_line_fields").alias("rule_name"),
                    F.lit("Error").alias("severity"),
                    F.lit("Line has more or fewer fields than the header").alias("description"),
                    F.col(MALFORMED).alias("original_value"),
                )
            )
    return found


def customer_rules() -> list[Rule]:
    segment_known = is_member(F.col("customer_segment"), words.CUSTOMER_SEGMENTS)
    return [
        Rule("duplicate_customer_id", "customer_id", F.col("id_repeated"), "Warning"),
        Rule("valid_customer_segment", "customer_segment", ~segment_known),
    ]


def account_rules() -> list[Rule]:
    type_known = is_member(F.col("account_type"), words.names_of(words.ACCOUNT_TYPE_SPELLINGS))
    return [
        Rule("account_customer_exists", "customer_id", ~F.col("customer_known")),
        Rule("valid_account_type", "account_type", ~type_known),
        Rule("account_branch_exists", "branch_id", ~F.col("branch_known")),
    ]


def belongs_to_customer(owner: Column, customer: Column) -> Column:
    return owner.eqNullSafe(customer)


def transaction_rules(settings: Settings) -> list[Rule]:
    """Rules over a transaction with its lookup flags; else-if chains are spelled out."""
    col = F.col
    has_account = col("account_known")
    owned = has_account & belongs_to_customer(col("held_customer_id"), col("customer_id"))
    day, amount = col("transaction_date"), col("transaction_amount")
    channel, branch, device = col("transaction_channel"), col("branch_id"), col("device_id")
    in_range = day.between(F.lit(settings.start_date), F.lit(settings.end_date))

    def blocking(name: str, column: str, fails: Column, severity: str = "Error") -> Rule:
        return Rule(name, column, fails, severity, True)

    def warning(name: str, column: str, fails: Column) -> Rule:
        return Rule(name, column, fails, "Warning")

    def outside(column: str, spellings: dict[str, str]) -> Column:
        return ~is_member(col(column), words.names_of(spellings))

    unknown_category = ~col("category_known") | outside("transaction_category", words.CATEGORY_SPELLINGS)
    closed_before = (col("held_account_status") == "Closed") & (day > col("held_close_date"))
    return [
        blocking("transaction_id_present", "transaction_id", col("transaction_id").isNull(), "Critical"),
        blocking("transaction_id_unique", "transaction_id", col("id_repeated")),
        blocking("customer_id_exists", "customer_id", ~col("customer_known")),
        blocking("account_id_exists", "account_id", ~has_account),
        blocking("account_belongs_to_customer", "account_id", has_account & ~owned),
        blocking("transaction_after_account_open", "transaction_date", owned & (day < col("held_open_date"))),
        blocking("transaction_before_account_close", "transaction_date", owned & closed_before),
        blocking("merchant_id_exists", "merchant_id", ~col("merchant_known")),
        blocking("transaction_amount_numeric", "transaction_amount", amount.isNull()),
        blocking("transaction_amount_not_zero", "transaction_amount", amount == 0),
        blocking("purchase_amount_positive", "transaction_amount", amount < 0),
        blocking("transaction_date_valid", "transaction_date", day.isNull()),
        blocking("transaction_date_in_reporting_range", "transaction_date", ~in_range),
        blocking("transaction_timestamp_valid", "transaction_timestamp", col("transaction_timestamp").isNull()),
        blocking("transaction_category_valid", "transaction_category", unknown_category),
        blocking("transaction_type_valid", "transaction_type", outside("transaction_type", words.TRANSACTION_TYPE_SPELLINGS)),
        blocking("transaction_status_valid", "transaction_status", outside("transaction_status", words.STATUS_SPELLINGS)),
        blocking("transaction_channel_valid", "transaction_channel", outside("transaction_channel", words.CHANNEL_SPELLINGS)),
        blocking("currency_supported", "currency", ~is_member(col("currency"), settings.supported_currency)),
        blocking("branch_id_exists", "branch_id", branch.isNotNull() & ~col("branch_known")),
        warning("branch_required_for_channel", "branch_id", is_member(channel, words.BRANCH_CHANNELS) & branch.isNull()),
        warning("device_id_exists", "device_id", device.isNotNull() & ~col("device_known")),
        warning("device_expected_for_digital_transaction", "device_id", is_member(channel, words.DIGITAL_CHANNELS) & device.isNull()),
        blocking("balance_numeric", "balance_after_transaction", col("balance_after_transaction").isNull()),
    ]


def check_customers(customers: DataFrame) -> DataFrame:
    """Customers with their failed rules as bits of ``failed_rules``."""
    marked = mark_repeated(customers, "customer_id", "id_repeated")
    return marked.select(*customers.columns, failed_rules(customer_rules()).alias("failed_rules"))


def check_accounts(accounts: DataFrame, customers: DataFrame, branches: DataFrame) -> DataFrame:
    marked = mark_known(accounts, "customer_id", merged(customers), "customer_id", "customer_known")
    marked = mark_known(marked, "branch_id", branches, "branch_id", "branch_known")
    return marked.select(*accounts.columns, failed_rules(account_rules()).alias("failed_rules"))


def _with_lookups(
    transactions: DataFrame,
    cleaned: Mapping[str, DataFrame],
    dimensions: Mapping[str, DataFrame] | None,
    lookups: Sequence[tuple] = LOOKUPS,
) -> DataFrame:
    """One join per lookup table: whether it knows the value, its surrogate key, and what the rules need of it.

    With ``dimensions`` the keys come from there; their Unknown members are no entries. Without them there are no keys.
    Stored dimensions that do not grow with the customers are broadcast up to ``BROADCAST_ROWS``: no row is shuffled to them.
    Beyond, no stored dimension is broadcast, whatever the size of its files."""
    for flag, column, table, business_key, dimension, key, more in lookups:
        if dimensions is None:
            entries, keys = first_wins(cleaned[table], business_key), []
        else:
            entries, keys = dimensions[dimension].where(F.col(key) != 0), [F.col(key)]
        named = [F.col(name).alias(f"held_{name}") for name in more]
        entries = entries.where(F.col(business_key).isNotNull()).select(F.col(business_key).alias("looked_up"), *keys, *named)
        if dimensions is not None:
            by_rows = merged_if_large if column in PARTY_COLUMNS else sent_if_small
            entries = by_rows(entries, dimensions[dimension])
        transactions = transactions.join(entries, F.col(column) == F.col("looked_up"), "left")
        transactions = transactions.withColumn(flag, F.col("looked_up").isNotNull()).drop("looked_up")
    return transactions


def known_parties(
    cleaned: Mapping[str, DataFrame], dimensions: Mapping[str, DataFrame] | None = None, ids: Sequence[str] = PARTY_COLUMNS
) -> DataFrame:
    """The distinct combinations of account, customer and device in the transactions, with what their lookup tables know of
    them. Only these ids are shuffled to the large lookup tables, and the transactions themselves once, to this table."""
    found = cleaned["transactions"].select(*ids).distinct()
    return _with_lookups(found, cleaned, dimensions, [row for row in LOOKUPS if row[1] in ids])


def known_owners(cleaned: Mapping[str, DataFrame]) -> DataFrame:
    """The columns of the ``known_parties`` by ``OWNER_COLUMNS``, for accounts of a known customer with that customer. The
    transactions are not read: with any other account and customer they are not valid."""
    accounts = cleaned["accounts"].select("source_row_number", "account_id", "customer_id", "open_date", "close_date", "account_status")
    customers = cleaned["customers"].select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    first = first_wins(accounts, "account_id").where(F.col("account_id").isNotNull())
    held = [F.col(name).alias(f"held_{name}") for name in ("customer_id", "open_date", "close_date", "account_status")]
    owned = first.join(merged(customers), "customer_id", "left_semi")
    return owned.select(*OWNER_COLUMNS, F.lit(True).alias("account_known"), *held, F.lit(True).alias("customer_known"))


def _with_parties(transactions: DataFrame, parties: DataFrame, ids: Sequence[str] = PARTY_COLUMNS, how: str = "left") -> DataFrame:
    """Adds the columns of the ``known_parties``. Every combination of ids is there, nulls included, so no row is lost;
    the join is a left one because that is the one whose heavy keys Spark splits. An inner one keeps the rows of the
    combinations that are there."""
    named = parties.select(*[F.col(name).alias(f"party_{name}") if name in ids else F.col(name) for name in parties.columns])
    same = [F.col(name).eqNullSafe(F.col(f"party_{name}")) for name in ids]
    joined = transactions.join(named, reduce(Column.__and__, same), how)
    return joined.drop(*[f"party_{name}" for name in ids])


def with_keys(
    transactions: DataFrame, cleaned: Mapping[str, DataFrame], dimensions: Mapping[str, DataFrame], parties: DataFrame
) -> DataFrame:
    """Adds the surrogate keys of the looked-up tables, from the ``known_parties`` and the dimensions."""
    others = [row for row in LOOKUPS if row[1] not in PARTY_COLUMNS]
    keyed = _with_lookups(_with_parties(transactions, parties), cleaned, dimensions, others)
    return keyed.select(*transactions.columns, *KEY_COLUMNS)


def valid_row_numbers(
    cleaned: Mapping[str, DataFrame],
    settings: Settings,
    owners: DataFrame,
    repeated_ids: DataFrame | None = None,
    dimensions: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The row numbers of the valid transactions, found without moving whole rows.

    Rules that the row itself settles come first, then those of the small lookup tables; only the owners' ids and the date of
    rows that pass them go to the owners. ``owners`` are the ``known_owners``, or the ``known_parties`` by ``OWNER_COLUMNS``,
    stored."""

    def passes(rules: Sequence[Rule]) -> Column:
        return ~reduce(Column.__or__, [F.coalesce(rule.fails, F.lit(False)) for rule in rules])

    blocking = [rule for rule in transaction_rules(settings) if rule.blocking]
    owned = [rule for rule in blocking if rule.name in OWNER_RULES]
    looked_up = [rule for rule in blocking if rule.name in LOOKED_UP_RULES]
    passed = cleaned["transactions"].where(passes([rule for rule in blocking if rule not in (*owned, *looked_up)]))
    ids = ("transaction_id", *OWNER_COLUMNS, "merchant_id", "branch_id", "transaction_category")
    rows = passed.select("source_row_number", "transaction_date", *ids)
    marked = mark_repeated(rows, "transaction_id", "id_repeated", repeated_ids).drop("transaction_id")
    marked = _with_lookups(marked, cleaned, dimensions, [row for row in LOOKUPS if row[1] not in PARTY_COLUMNS])
    marked = marked.where(passes(looked_up)).select("source_row_number", "transaction_date", *OWNER_COLUMNS)
    return _with_parties(marked, owners, OWNER_COLUMNS, "inner").where(passes(owned)).select("source_row_number")


def check_transactions(
    cleaned: Mapping[str, DataFrame],
    settings: Settings,
    repeated_ids: DataFrame | None = None,
    dimensions: Mapping[str, DataFrame] | None = None,
    parties: DataFrame | None = None,
) -> DataFrame:
    """Transactions with ``failed_rules`` and ``has_blocking_quality_issue``: all row rules in one pass.

    ``parties`` may hold the ``known_parties`` as a stored table, made with the same dimensions: one join with it takes the
    place of three.

    With ``dimensions`` the rows also get the surrogate keys of the looked-up tables (null where unknown), so the fact
    need not join these tables again. No hint forces a broadcast: lookup tables may grow with the data, so Spark picks the
    join by their size, and its skew join splits a heavy id."""
    transactions = cleaned["transactions"]
    marked = mark_repeated(transactions, "transaction_id", "id_repeated", repeated_ids)
    if parties is None:
        marked = _with_lookups(marked, cleaned, dimensions)
    else:
        # The large join comes first, before the rows get wider.
        marked = _with_parties(marked, parties)
        marked = _with_lookups(marked, cleaned, dimensions, [row for row in LOOKUPS if row[1] not in PARTY_COLUMNS])
    rules = transaction_rules(settings)
    blocked = F.col("failed_rules").bitwiseAND(F.lit(_bits(rules, True))) != 0
    keys = [] if dimensions is None else KEY_COLUMNS
    checked = marked.select(*transactions.columns, *keys, failed_rules(rules).alias("failed_rules"))
    return checked.withColumn("has_blocking_quality_issue", blocked)


def keyed_transactions(checked: DataFrame) -> DataFrame:
    """The valid transactions with the surrogate keys that their check found."""
    return checked.where(~F.col("has_blocking_quality_issue")).drop("failed_rules")


def valid_transactions(checked: DataFrame) -> DataFrame:
    return keyed_transactions(checked).drop(*KEY_COLUMNS)


def rejected_transactions(checked: DataFrame) -> DataFrame:
    return checked.where("has_blocking_quality_issue").drop("failed_rules", *KEY_COLUMNS)


def _rows(checked: DataFrame, source: str, stage: Column, record: Column, rules: Sequence[Rule]) -> DataFrame:
    failing = checked.where("failed_rules <> 0")
    exploded = failing.select(
        "source_row_number", record.alias("record_identifier"), F.explode(failures(rules)).alias("issue")
    )
    return exploded.select(
        stage.cast("int").alias("stage"),
        "source_row_number",
        F.col("issue.rule_order").alias("rule_order"),
        F.lit(f"{source}.csv").alias("source_file"),
        "record_identifier",
        *[F.col(f"issue.{name}") for name in ("column_name", "rule_name", "severity", "description", "original_value")],
    )


def issue_rows(
    customers: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    settings: Settings,
    missing: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """All issues of the checked tables, with the columns that put them in log order."""
    customer_stage = F.lit(1) + F.col("issue.rule_order")
    transaction_id = F.coalesce("transaction_id", F.concat(F.lit("row_"), F.col("source_row_number").cast("string")))
    absent = [
        (0, at, 0, f"{table}.csv", "DATASET", column, "required_source_column", "Critical",
         f"Missing required column {column}", "")
        for at, (table, column) in enumerate(missing)
    ]
    parts = [
        _rows(customers, "customers", customer_stage, F.col("customer_id"), customer_rules()),
        _rows(accounts, "accounts", F.lit(3), F.col("account_id"), account_rules()),
        _rows(transactions, "transactions", F.lit(4), transaction_id, transaction_rules(settings)),
    ]
    log = transactions.sparkSession.createDataFrame(absent, ISSUE_SCHEMA)
    for part in parts:
        log = log.unionByName(part)
    return log


def issue_log(rows: DataFrame, settings: Settings) -> DataFrame:
    """The log with ids in order of detection: datasets, customers, accounts, transactions."""
    numbered = number_by_position(
        rows, "issue_number", "source_row_number", stage="stage", tie_break=["rule_order"], bits=ISSUE_RANGE_BITS
    )
    detected = F.lit(settings.detected_timestamp) if settings.detected_timestamp else F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    )
    return numbered.select(
        numbered_id("DQI", F.col("issue_number")).alias("issue_id"),
        *LOG_COLUMNS,
        detected.alias("detected_timestamp"),
        F.lit("Open").alias("resolution_status"),
    )


def validate_datasets(cleaned: Mapping[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    """Adds valid_transactions, rejected_transactions and data_quality_issues to the cleaned tables."""
    missing = required_column_issues(cleaned)
    checked = check_transactions(cleaned, settings)
    rows = issue_rows(
        check_customers(cleaned["customers"]),
        check_accounts(cleaned["accounts"], cleaned["customers"], cleaned["branches"]),
        checked,
        settings,
        missing,
    )
    return {
        **cleaned,
        "valid_transactions": valid_transactions(checked),
        "rejected_transactions": rejected_transactions(checked),
        "data_quality_issues": issue_log(rows, settings),
    }
