"""The row before each row of its group, also for groups that no task could sort alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.numbering import LOCAL_INDEX_MASK
from ledgerflow.sources.staging import Staging


@dataclass(frozen=True)
class Before:
    """What is wanted of the row before: ``values`` by name, among the rows with equal ``within`` columns (besides the
    columns that all rows of one search share)."""

    within: Sequence[str]
    values: Mapping[str, str]

    def cells(self) -> Column:
        return F.struct(*[F.col(column).alias(name) for name, column in self.values.items()])


def _unfolded(frame: DataFrame, found: Mapping[str, Column], wanted: Mapping[str, Before]) -> DataFrame:
    whole = frame.withColumns({f"before_{key}": row for key, row in found.items()})
    cells = {alias: F.col(f"before_{key}")[alias] for key, before in wanted.items() for alias in before.values}
    return whole.withColumns(cells).drop(*[f"before_{key}" for key in wanted])


def previous_in_groups(frame: DataFrame, shared: Sequence[str], order: Sequence[str], wanted: Mapping[str, Before]) -> DataFrame:
    """Adds the values of the row before, null for the first one. One shuffle on the shared columns serves all searches;
    the rows of one group are sorted by one task."""
    found = {key: F.lag(before.cells()).over(Window.partitionBy(*shared, *before.within).orderBy(*order)) for key, before in wanted.items()}
    return _unfolded(frame.repartition(*shared), found, wanted)


def previous_in_ranges(
    frame: DataFrame, shared: Sequence[str], order: Sequence[str], wanted: Mapping[str, Before], staging: Staging, name: str
) -> DataFrame:
    """The same for groups of any size; the shared and order columns together must tell rows apart.

    Rows are range-partitioned over the shared and order columns, so one group is spread over many ranges, and stored with
    their range and place. The row before is looked for inside the range. For the first row of a group in a range it is the
    last row of that group in an earlier range: one row per range and group is handed on, and a group has at most as
    many of these as there are ranges."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL_INDEX_MASK))
    keys = [*shared, *order]
    placed = frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = staging.save(placed.withColumns({"range_number": F.spark_partition_id(), "range_place": place}), name)
    whole = placed.repartition("range_number")
    found = {}
    for key, before in wanted.items():
        group = [*shared, *before.within]
        inside = F.lag(before.cells()).over(Window.partitionBy("range_number", *group).orderBy("range_place"))
        whole = whole.withColumn(f"inside_{key}", inside)
    for key, before in wanted.items():
        group = [*shared, *before.within]
        ends = placed.groupBy("range_number", *group).agg(
            F.min("range_place").alias("range_place"), F.max_by(before.cells(), "range_place").alias("last")
        )
        handed = F.lag("last").over(Window.partitionBy(*group).orderBy("range_number"))
        open_rows = ends.select("range_number", "range_place", handed.alias(f"handed_{key}")).where(F.col(f"handed_{key}").isNotNull())
        whole = whole.join(open_rows, ["range_number", "range_place"], "left")
        found[key] = F.coalesce(f"inside_{key}", f"handed_{key}")
    helpers = [f"{part}_{key}" for part in ("inside", "handed") for key in wanted]
    return _unfolded(whole, found, wanted).drop("range_number", "range_place", *helpers)
