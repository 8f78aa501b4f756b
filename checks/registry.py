"""Registered queries: a name, the Spark query and, where SQL can say it, the DuckDB query."""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.plans.pipeline import STORED_AS, Warehouse
from ledgerflow.plans.rollup import plain_numbers
from ledgerflow.session import apply_settings
from ledgerflow.sources.csv import RAW_FILES
from checks.market import SETTINGS, RawMarket
from ledgerflow.sources.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_warehouses: dict[tuple, Warehouse] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, folder: plain_numbers(query(spark, folder))
    if sql is not None:
        ORACLE[name] = sql


class _RawTables(dict):
    """Raw tables, derived when first read; the transactions, which are read often, are stored."""

    def __init__(self, market: RawMarket):
        super().__init__({name: None for name in RAW_FILES})
        self.market, self.lock = market, RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self.lock:
            if super().__getitem__(name) is None:
                frame = self.market.build(name)
                self[name] = self.market.staging.save(frame, "raw_transactions") if name == "transactions" else frame
            return super().__getitem__(name)


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names and times of change of the tables in a folder of any file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((entry.getPath().getName(), entry.getModificationTime()) for entry in found))


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over the given tables; its tables are shared by the queries of a session while the files stay."""
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if key not in _warehouses:
        apply_settings(spark)
        staging = Staging(spark, STORED_AS)
        _warehouses[key] = Warehouse(_RawTables(RawMarket(spark, folder, staging)), SETTINGS, staging)
    return _warehouses[key]


def add_star(name: str, query: Callable[[Warehouse], DataFrame], sql: str | None = None) -> None:
    """A query over the star tables."""
    add(name, lambda spark, folder: query(warehouse(spark, folder)), sql)


def add_given(name: str, table: str, query: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    """A query over one given table."""
    add(name, lambda spark, folder: query(spark.read.parquet(f"{folder}/{table}.parquet")), sql)
