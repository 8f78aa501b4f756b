"""The full run: raw tables to star model, flags, reports and exports."""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import anomaly, cleaning, dimensions, facts, quality
from ledgerflow.operators.numbering import counted_words, number_kept_rows, position_words
from ledgerflow.operators.reconciliation import build_reconciliation_report
from ledgerflow.plans.kpis import calculate_kpis
from ledgerflow.plans.reports import REPORTS, build_reports
from ledgerflow.plans.rollup import ROLLUPS, Tables, fact_rollup, fact_rollups, one_row, valid_keys, valid_totals
from ledgerflow.plans.views import VIEWS, executive_kpis
from ledgerflow.session import apply_settings
from ledgerflow.settings import Settings
from ledgerflow.sources.csv import MALFORMED, export_tables, ingest_source_files, read_csv, table_row_counts
from ledgerflow.sources.staging import Staging

# The tables of the model.
DIMENSIONS = (
    "dim_customer",
    "dim_account",
    "dim_merchant",
    "dim_transaction_category",
    "dim_date",
    "dim_channel",
    "dim_location",
    "dim_device",
    "dim_branch",
    "dim_transaction_status",
)
FACTS = (
    "fact_transaction",
    "fact_account_daily_balance",
    "fact_customer_monthly_summary",
    "fact_anomaly_flag",
    "fact_data_quality_issue",
)
#: Compression of the tables that a run stores: text columns make most of them.
STORED_AS = "zstd"

EXPORTED_TABLES = (*DIMENSIONS, *FACTS, "reconciliation_report", "kpi_snapshot")

#: What the ten report tables are made from.
REPORT_SOURCES = (*DIMENSIONS, "fact_transaction", "fact_anomaly_flag", "fact_data_quality_issue", "reconciliation_report")

#: Tables that cannot be made without checking every transaction.
FROM_CHECKED = {
    "checked_transactions",
    "rejected_transactions",
    "issue_rows",
    "fact_data_quality_issue",
    "data_quality_issues",
    "reconciliation_report",
    "validation_summary",
}


class Warehouse(Mapping[str, DataFrame]):
    """The tables of one run by name. A table is computed and stored when it is first asked for.

    Tables that several others read (cleaned tables, checked transactions, dimensions, facts) are
    written once to the shared folder. Cheap selections of them stay lazy, and so do the cleaned
    transactions: all their columns are stored again once they are checked.

    A full run checks all transactions and reads the valid ones from there. Before they are checked, and by a query alone,
    the valid ones are found by their ids (``quality.valid_row_numbers``) and stored with the columns that the model reads:
    no whole row is shuffled, unless the fact itself is asked for. Totals and keys by dimensions that are made without the
    valid transactions read only their columns of them, straight from the cleaned ones."""

    LAZY = {
        "transactions",
        "kept_transactions",
        "valid_transactions",
        "numbered_transactions",
        "rejected_transactions",
        "data_quality_issues",
        "kpi_snapshot",
        "validation_summary",
    }

    def __init__(self, raw: Mapping[str, DataFrame], settings: Settings, staging: Staging):
        self.raw, self.settings, self.staging = raw, settings, staging
        self._ready: dict[str, DataFrame] = {}
        self._locks: dict[str, RLock] = defaultdict(RLock)
        self._all_rollups = self._all_checked = False
        #: Seconds each stored table took, with the tables it needed first.
        self.seconds: dict[str, float] = {}

    def __iter__(self):
        return iter(EXPORTED_TABLES)

    def __len__(self) -> int:
        return len(EXPORTED_TABLES)

    def __contains__(self, name: object) -> bool:
        return name in EXPORTED_TABLES

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._ready:
                began = time.perf_counter()
                frame = self._build(name)
                self._ready[name] = frame if name in self.LAZY else self.staging.save(frame, name)
                self.seconds[name] = round(time.perf_counter() - began, 3)
        return self._ready[name]

    def rollups(self) -> DataFrame:
        """The stored totals that views, reports and measures are added up from."""
        return self["fact_rollups"]

    def rollup(self, keys: Sequence[str]) -> DataFrame:
        """The stored totals that have one key set: those of all sets in a full run, which reads the fact once for them, else
        the totals of this set only."""
        return self.rollups() if self._all_rollups else self[f"fact_rollup_{ROLLUPS.index(tuple(keys))}"]

    def key_totals(self, keys: Sequence[str]) -> DataFrame | None:
        """Totals by just these keys, from the valid transactions; none where the fact is there or will be."""
        if self._checks_all() or "fact_transaction" in self._ready:
            return None
        return self["-".join(["valid_totals", *sorted(keys)])]

    def key_sets(self, keys: Sequence[str]) -> DataFrame | None:
        """The combinations of these keys, from the valid transactions; none where the fact is there or will be."""
        if self._checks_all() or "fact_transaction" in self._ready:
            return None
        return valid_keys(self._rows_with(keys), self, keys)

    def _rows_with(self, keys: Sequence[str]) -> DataFrame:
        """The valid transactions for totals by these keys: stored where they are there or the dimensions need them."""
        stored = "valid_rows" in self._ready or set(keys) & {"channel_key", "location_key", "transaction_status_key"}
        return self["valid_rows" if stored else "kept_transactions"]

    def _checks_all(self) -> bool:
        return self._all_rollups or self._all_checked or "checked_transactions" in self._ready

    def _valid(self) -> str:
        """The table of valid transactions that is there or costs less to make."""
        return "valid_transactions" if self._checks_all() and "valid_rows" not in self._ready else "valid_rows"

    def _numbered(self) -> str:
        return "numbered_transactions" if self._valid() == "valid_transactions" else "valid_rows"

    def prepare(self, names: Iterable[str] = (*EXPORTED_TABLES, "fact_rollups"), at_once: int = 4) -> None:
        """Builds tables that do not need each other at the same time; shared inputs are built by whoever is first. Where one of
        them needs the check, the others read the valid transactions from there."""
        order = [*(name for name in self.raw if name != "transactions"), *names]
        self._all_rollups = self._all_rollups or "fact_rollups" in order
        self._all_checked = self._all_checked or not FROM_CHECKED.isdisjoint(order)
        with ThreadPoolExecutor(at_once) as threads:
            list(threads.map(self.__getitem__, order))

    def _build(self, name: str) -> DataFrame:
        if name in self.raw:
            clean = cleaning.clean_datasets({name: self.raw[name].drop(MALFORMED)})
            return clean[name]
        if name.startswith("fact_rollup_"):
            return fact_rollup(self["fact_transaction"], ROLLUPS[int(name.removeprefix("fact_rollup_"))])
        if name.startswith("valid_totals"):
            keys = name.split("-")[1:]
            return valid_totals(self._rows_with(keys), self, keys)
        build = getattr(self, f"_{name}", None)
        if build is not None:
            return build()
        return dimensions.BUILDERS[name](_Cleaned(self, self._valid()))

    def _checked_transactions(self) -> DataFrame:
        return quality.check_transactions(_Cleaned(self), self.settings, self["repeated_ids"], self, self["known_parties"])

    def _known_parties(self) -> DataFrame:
        return quality.known_parties(_Cleaned(self), self)

    def _repeated_ids(self) -> DataFrame:
        return quality.repeated_values(self["transactions"], "transaction_id")

    def _valid_transactions(self) -> DataFrame:
        return quality.valid_transactions(self["checked_transactions"])

    def _known_owners(self) -> DataFrame:
        return quality.known_owners(_Cleaned(self))

    def _valid_bits(self) -> DataFrame:
        if self._checks_all():
            valid = self["valid_transactions"]
        else:
            valid = quality.valid_row_numbers(_Cleaned(self), self.settings, self["known_owners"], self["repeated_ids"], self)
        return position_words(valid, "source_row_number")

    def _valid_words(self) -> DataFrame:
        return counted_words(self["valid_bits"])

    def _valid_rows(self) -> DataFrame:
        return self["kept_transactions"]

    def _kept_transactions(self) -> DataFrame:
        """The valid transactions with their own key and the columns that the model reads."""
        rows = self["transactions"].select("source_row_number", *quality.MODEL_COLUMNS)
        return number_kept_rows(rows, "transaction_key", "source_row_number", self["valid_words"])

    def _valid_parties(self) -> DataFrame:
        return quality.known_parties({"transactions": self["valid_rows"]}, self)

    def _numbered_transactions(self) -> DataFrame:
        """The valid transactions with their own key and those that the check has found."""
        keyed = quality.keyed_transactions(self["checked_transactions"])
        return number_kept_rows(keyed, "transaction_key", "source_row_number", self["valid_words"])

    def _rejected_transactions(self) -> DataFrame:
        return quality.rejected_transactions(self["checked_transactions"])

    def _issue_rows(self) -> DataFrame:
        customers = quality.check_customers(self["customers"])
        accounts = quality.check_accounts(self["accounts"], self["customers"], self["branches"])
        missing = quality.required_column_issues(self.raw)
        rows = quality.issue_rows(customers, accounts, self["checked_transactions"], self.settings, missing)
        for lines in quality.malformed_line_issues(self.raw):
            rows = rows.unionByName(lines)
        return rows

    def _data_quality_issues(self) -> DataFrame:
        return self["fact_data_quality_issue"].drop("data_quality_issue_key")

    def _dim_date(self) -> DataFrame:
        return dimensions.build_dim_date(self.staging.spark, self.settings.start_date, self.settings.end_date)

    def _fact_transaction(self) -> DataFrame:
        numbered = self[self._numbered()]
        if "customer_key" not in numbered.columns:
            numbered = quality.with_keys(numbered, _Cleaned(self), self, self["valid_parties"])
        return facts.build_fact_transaction(numbered, self)

    def _fact_account_daily_balance(self) -> DataFrame:
        return facts.build_account_daily_balance(self["fact_transaction"], self["daily_balances"])

    def _fact_rollups(self) -> DataFrame:
        return fact_rollups(self["fact_transaction"])

    def _daily_balances(self) -> DataFrame:
        return facts.daily_balances(self["fact_transaction"])

    def _monthly_totals(self) -> DataFrame:
        return facts.monthly_totals(self["fact_transaction"], self["dim_date"])

    def _places(self) -> DataFrame:
        return dimensions.places(_Cleaned(self, self._valid()))

    def _dim_location(self) -> DataFrame:
        return dimensions.location_dimension(self["places"])

    def _fact_customer_monthly_summary(self) -> DataFrame:
        return facts.calculate_customer_monthly_summary(self["fact_transaction"], self["dim_date"], self["monthly_totals"])

    def _fact_data_quality_issue(self) -> DataFrame:
        return facts.build_fact_data_quality_issue(quality.issue_log(self["issue_rows"], self.settings))

    def _flagged_rows(self) -> DataFrame:
        known = [self[name] for name in (self._numbered(), "customer_history", "busy_decline_days", "crowded_slots")]
        numbered, history, busy_days, crowded = known
        return anomaly.flagged_rows(numbered, self.settings, history, busy_days, crowded, self.staging)

    def _amount_counts(self) -> DataFrame:
        return anomaly.amount_counts(self[self._valid()])

    def _customer_history(self) -> DataFrame:
        return anomaly.customer_history(self[self._valid()], self["amount_counts"])

    def _crowded_slots(self) -> DataFrame:
        return anomaly.crowded_slots_of(self[self._valid()], self.settings, self["customer_history"])

    def _busy_decline_days(self) -> DataFrame:
        return anomaly.busy_decline_days(self[self._valid()])

    def _fact_anomaly_flag(self) -> DataFrame:
        return anomaly.number_flags(self["flagged_rows"])

    def _reconciliation_report(self) -> DataFrame:
        # The report is fourteen rows; one file keeps their order.
        return build_reconciliation_report(self.raw, _Cleaned(self), self, self.settings).coalesce(1)

    def _kpi_snapshot(self) -> DataFrame:
        return executive_kpis(self)

    def _validation_summary(self) -> DataFrame:
        return validation_summary(self)


class _Cleaned(Mapping[str, DataFrame]):
    """The cleaned and validated tables of a warehouse, under their own names. ``valid`` names the table that is read for the
    valid transactions."""

    def __init__(self, warehouse: Warehouse, valid: str = "valid_transactions"):
        self.warehouse, self.valid = warehouse, valid

    def __getitem__(self, name: str) -> DataFrame:
        return self.warehouse[self.valid if name == "valid_transactions" else name]

    def __iter__(self):
        return iter([*self.warehouse.raw, "valid_transactions", "rejected_transactions", "data_quality_issues"])

    def __len__(self) -> int:
        return len(self.warehouse.raw) + 3


def validation_summary(tables: Tables) -> DataFrame:
    """Issues by severity and reconciliation checks by status."""

    def counted(name: str, area: str, column: str) -> DataFrame:
        counts = tables[name].groupBy(column).agg(F.count("*").alias("record_count"))
        return counts.select(
            F.lit(area).alias("validation_area"), F.col(column).alias("validation_status"), "record_count"
        )

    issues = counted("fact_data_quality_issue", "data_quality_issues", "severity")
    return issues.unionAll(counted("reconciliation_report", "reconciliation", "status"))


def dimension_row_counts(tables: Tables) -> DataFrame:
    return table_row_counts({name: tables[name] for name in DIMENSIONS})


def fact_row_counts(tables: Tables) -> DataFrame:
    return table_row_counts({name: tables[name] for name in FACTS})


def prepared(tables: Tables, names: Iterable[str]) -> Tables:
    """The tables, with the named ones built at the same time where they are a warehouse's."""
    if isinstance(tables, Warehouse):
        tables.prepare(names)
    return tables


def reporting_tables(tables: Tables) -> dict[str, DataFrame]:
    """Everything the BI export writes: 17 tables and 15 views."""
    tables = prepared(tables, (*EXPORTED_TABLES, "fact_rollups"))
    return {
        **{name: tables[name] for name in EXPORTED_TABLES},
        **{name: view(tables) for name, view in VIEWS.items()},
    }


def export_reporting_tables(tables: Tables, folder: str) -> list[str]:
    return export_tables(reporting_tables(tables), folder)


def export_reports(tables: Tables, folder: str) -> list[str]:
    names = {title: title.lower().replace(" ", "_") for title in REPORTS}
    tables = prepared(tables, (*REPORT_SOURCES, "fact_rollups"))
    return export_tables({names[title]: frame for title, frame in build_reports(tables).items()}, folder)


def run_summary(warehouse: Warehouse, exported: Sequence[str], report_folder: str) -> DataFrame:
    """``metric, value`` (text) of the run: its counts, the files it wrote and the folders that hold its reports and
    its stored tables (in place of a workbook and a database file)."""
    counted = table_row_counts(reporting_tables(warehouse)).select("table_name")
    is_view = F.col("table_name").isin(*VIEWS)
    # The metric names and their order.
    raw = warehouse.raw
    checked = warehouse["checked_transactions"]
    category = F.col("transaction_category")
    counts = [
        checked.agg(
            F.count("*").alias("raw_transaction_rows"),
            F.count_if(~F.col("has_blocking_quality_issue")).alias("valid_analyzed_transactions"),
            F.count_if("has_blocking_quality_issue").alias("rejected_transaction_rows"),
        ),
        raw["customers"].agg(F.count_distinct("customer_id").alias("synthetic_customers")),
        raw["accounts"].agg(F.count_distinct("account_id").alias("synthetic_accounts")),
        warehouse["dim_transaction_category"]
        .where(category != "Unknown")
        .agg(F.count_distinct(category).alias("transaction_categories")),
        warehouse["fact_anomaly_flag"].agg(F.count("*").alias("potential_anomaly_flags")),
        warehouse["fact_data_quality_issue"].agg(F.count("*").alias("data_quality_issues")),
    ]
    checked_tables = counted.agg(
        F.count_if(~is_view).alias("database_table_count_checks"), F.count_if(is_view).alias("database_view_count_checks")
    )
    written = {
        "powerbi_export_files": F.lit(len(exported)),
        "excel_workbook": F.lit(report_folder),
        "database_path": F.lit(warehouse.staging.folder),
    }
    row = one_row([*counts, checked_tables])
    names = [*row.columns[:8], *written, *row.columns[8:]]
    cells = {name: written.get(name, F.col(name)) for name in names}
    entries = [F.struct(F.lit(name).alias("metric"), cell.cast("string").alias("value")) for name, cell in cells.items()]
    return row.select(F.inline(F.array(*entries)))


def open_warehouse(spark: SparkSession, raw_folder: str, settings: Settings) -> Warehouse:
    """A warehouse over raw CSV files. The raw rows are numbered at the scan.

    Raw tables are read several times (cleaning, repeated ids, raw totals, malformed lines), so their text is parsed
    once, with all columns, and stored."""
    apply_settings(spark)
    staging = Staging(spark, STORED_AS)
    raw = ingest_source_files(spark, raw_folder, settings.multi_line_csv)
    return Warehouse({name: staging.save(frame, f"raw_{name}") for name, frame in raw.items()}, settings, staging)


def run_pipeline(spark: SparkSession, raw_folder: str, output_folder: str, settings: Settings) -> DataFrame:
    """Whole batch from raw CSV files to exports; returns the run summary. The stored tables are deleted at the end."""
    warehouse = open_warehouse(spark, raw_folder, settings)
    try:
        warehouse.prepare()
        path = _export_run(warehouse, output_folder)
    finally:
        warehouse.staging.remove()
    return read_csv(spark, path)


def _export_run(warehouse: Warehouse, output_folder: str) -> str:
    """Writes all results; returns where the run summary is."""
    exported = export_reporting_tables(warehouse, f"{output_folder}/reporting")
    export_reports(warehouse, f"{output_folder}/reports")
    export_tables({"kpi_summary": calculate_kpis(warehouse)}, output_folder)
    summary = run_summary(warehouse, exported, f"{output_folder}/reports")
    return export_tables({"pipeline_execution_summary": summary}, output_folder)[0]
