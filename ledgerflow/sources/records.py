"""CSV files with quoted line breaks, read in as many tasks as they have splits.

A line with an odd number of quotes opens or closes a quoted field that goes on over the line's end. Files are scanned as
lines, whatever split they lie in; lines are numbered from the sizes of the splits, and only the odd lines, without their
text, are counted through: in each file the first opens, the second closes, and so on. From these follow the ranges of
lines that are one record. Lines outside of any range are records as they stand; the others are put together.

A quote inside a field is written twice and the field in quotes, as CSV writers do. An opening line that is never closed is a
record by itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.numbering import BROADCAST_ROWS, kept_words, number_by_position, number_kept_rows, number_lines_of_files, sent
from ledgerflow.sources.staging import Staging

# Lines of a range that are listed together.
_LISTED_BITS = 12


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_number, line_file, line) of all lines in the order of files; carriage returns stay."""
    scanned = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("line_file"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_start"),
        F.monotonically_increasing_id().alias("scan_id"),
    )
    return number_lines_of_files(scanned, "line_number")


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def open_ranges(lines: DataFrame) -> DataFrame:
    """(first_line, last_line) of the records with line breaks."""
    odd = lines.where(_quotes(F.col("line")) % 2 == 1).select("line_number", "line_file")
    counted = number_by_position(odd, "odd_number", "line_number")
    firsts = counted.groupBy("line_file").agg(F.min("odd_number").alias("first_odd"))
    pair = F.floor((F.col("odd_number") - F.col("first_odd")) / 2).alias("pair")
    ends = counted.join(sent(firsts), "line_file").groupBy("line_file", pair)
    return ends.agg(F.min("line_number").alias("first_line"), F.max("line_number").alias("last_line")).select("first_line", "last_line")


def records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """(line_number, line_file, record) with the line a record begins at; ``ranges`` are stored ``open_ranges``."""
    several = ranges.where("last_line > first_line")
    block = F.explode(F.sequence(F.shiftright("first_line", _LISTED_BITS), F.shiftright("last_line", _LISTED_BITS)))
    low, high = F.shiftleft("block", _LISTED_BITS), F.shiftleft(F.col("block") + 1, _LISTED_BITS) - 1
    listed = several.select("first_line", "last_line", block.alias("block")).select(
        "first_line", F.explode(F.sequence(F.greatest("first_line", low), F.least("last_line", high))).alias("line_number")
    )
    # Spark takes the list for as small as the ranges it is made from, so its rows are counted.
    count = several.agg(F.sum(F.col("last_line") - F.col("first_line") + 1)).first()[0] or 0
    placed = lines.join(sent(listed) if count <= BROADCAST_ROWS else listed.hint("merge"), "line_number", "left")
    alone = placed.where("first_line is null").select("line_number", "line_file", F.col("line").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("line_number", "line")))
    joined = placed.where("first_line is not null").groupBy("first_line", "line_file").agg(
        F.array_join(F.transform(parts, lambda part: part["line"]), "\n").alias("record")
    )
    return alone.unionByName(joined.withColumnRenamed("first_line", "line_number"))


def read_records(spark: SparkSession, path: str, names: Sequence[str], surplus: str, staging: Staging | None = None) -> DataFrame:
    """The fields of all records as text under ``names``, with the record's number in front (``source_row_number``) and a
    last column ``surplus`` that holds records with more or fewer fields. Each file begins with a header record; blank
    records do not count."""
    staging = Staging(spark) if staging is None else staging
    lines = numbered_lines(spark, path)
    ranges = staging.save(open_ranges(lines), "line_ranges")
    headers = staging.save(lines.groupBy("line_file").agg(F.min("line_number").alias("line_number")), "header_lines")
    found = records(lines, ranges).join(sent(headers), "line_number", "left_anti")
    found = found.where(~F.col("record").rlike(r"^\s*$")).select("line_number", F.rtrim(F.col("record"), F.lit("\r")).alias("record"))
    # Records are read twice: once for their places alone, once with their text.
    words = staging.save(kept_words(found.select("line_number"), "line_number"), "record_places")
    numbered = number_kept_rows(found, "source_row_number", "line_number", words)
    quoted = [f"`{name.replace('`', '``')}` string" for name in [*names, surplus]]
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": surplus}
    parsed = numbered.select("source_row_number", F.from_csv("record", ", ".join(quoted), options).alias("fields"))
    return parsed.select("source_row_number", "fields.*")
