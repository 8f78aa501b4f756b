"""Raw CSV tables in, result tables out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.text import standardize_column_names
from ledgerflow.operators.numbering import number_lines_of_files
from ledgerflow.sources.records import read_records

# The raw tables and their files.
RAW_FILES = {
    "customers": "customers.csv",
    "accounts": "accounts.csv",
    "transactions": "transactions.csv",
    "merchants": "merchants.csv",
    "transaction_categories": "transaction_categories.csv",
    "branches": "branches.csv",
    "devices": "devices.csv",
    "customer_segments": "customer_segments.csv",
}


#: The text of a line whose number of fields differs from the header's, null on the others.
MALFORMED = "malformed_line"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}` string"


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every column as text; blank fields arrive as null, which cleaning makes of them anyway.

    ``multi_line`` reads quoted line breaks inside fields by Spark's own reader, for which a file is one task;
    ``read_numbered_csv`` has another way."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return reader.csv(path)


def read_checked_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``read_csv`` with a last column that holds lines with more or fewer fields than the header. Such a line keeps
    the fields it has under the header's names.

    The scan finds such lines only while it reads all columns: store the frame before taking some of them."""
    names = read_csv(spark, path, multi_line).columns
    schema = ", ".join(_quoted(name) for name in [*names, MALFORMED])
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return reader.option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)


def read_numbered_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``read_checked_csv`` with standard column names and the row's place in the source in front.

    ``multi_line`` reads quoted line breaks inside fields, see ``records``: a file is as many tasks as it has splits."""
    if multi_line:
        names = read_csv(spark, path).columns
        standard = standardize_column_names(spark.createDataFrame([], ", ".join(_quoted(name) for name in [*names, MALFORMED]))).columns
        return read_records(spark, path, names, MALFORMED).toDF("source_row_number", *standard)
    lines = read_checked_csv(spark, path)
    scanned = lines.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_start"),
        F.monotonically_increasing_id().alias("scan_id"),
    )
    place = ["file_path", "file_start", "scan_id"]
    named = standardize_column_names(lines).columns
    return number_lines_of_files(scanned.toDF(*named, *place))


def ingest_source_files(spark: SparkSession, folder: str, multi_line: bool = False) -> dict[str, DataFrame]:
    """All raw tables by name; a missing file fails here and the error names its path."""
    return {name: read_numbered_csv(spark, f"{folder}/{file}", multi_line) for name, file in RAW_FILES.items()}


def export_cast(frame: DataFrame) -> DataFrame:
    """Columns as exports show them: booleans as 0/1, dates, timestamps and decimals as plain text."""
    shown = {"boolean": "int", "date": "string", "timestamp": "string", "timestamp_ntz": "string", "decimal": "string"}
    return frame.select(
        *[
            F.col(field.name).cast(shown.get(field.dataType.typeName(), field.dataType)).alias(field.name)
            for field in frame.schema
        ]
    )


def save_csv(frame: DataFrame, path: str) -> None:
    """Writes ``.csv.gz`` files: exports of the fact and its views are several times the size of the raw tables as plain
    text. ``read_csv`` reads them like plain ones."""
    writer = frame.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("zlib.compress.level", "BEST_SPEED").csv(path, compression="gzip")


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Writes every table under its own name and returns the paths."""
    paths = []
    for name, frame in tables.items():
        paths.append(f"{folder}/{name}")
        save_csv(export_cast(frame), paths[-1])
    return paths


def save_tables(tables: Mapping[str, DataFrame], database: str | None = None) -> list[str]:
    """Replaces catalog tables of the same names."""
    names = [f"{database}.{name}" if database else name for name in tables]
    for name, frame in zip(names, tables.values()):
        frame.write.mode("overwrite").saveAsTable(name)
    return names


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for all tables in one job."""
    counts = [
        frame.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, frame in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionAll(count)
    return result
