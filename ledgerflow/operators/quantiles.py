"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A value is read as three digits of this many bits: a group has at most 2**20 children per digit
# (2**24 for the first), which bounds what one task sorts.
DIGIT_BITS = 20


def _holds_rank(ranks: Column) -> Column:
    return F.exists(ranks, lambda rank: (rank >= F.col("below")) & (rank < F.col("below") + F.col("rows")))


def _narrow(children: DataFrame, inside: Sequence[str], order: str) -> DataFrame:
    """Adds the rank at which each child starts and keeps the children that hold a wanted rank."""
    before = Window.partitionBy(*inside).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("rows").over(before), F.lit(0))
    return children.withColumn("below", start).where(_holds_rank(F.col("ranks")))


def exact_quantiles(
    frame: DataFrame,
    keys: Sequence[str],
    value: str,
    points: Mapping[str, float],
    times: str | None = None,
    counted: bool = False,
) -> DataFrame:
    """One row per group with interpolated quantiles of a whole-number column (cents, counts). A column ``times`` says how
    many rows a row stands for; ``counted`` says that no group and value occurs in two rows, so they are not counted again.

    The same values as ``percentile``, which gathers all distinct values of a group in one task.
    Here counts per value are added up into coarser digits, and only the child that holds the
    wanted rank is opened at the next digit. Groups are null-safe; null values are left out."""
    coarse, middle = F.shiftright("value", 2 * DIGIT_BITS), F.shiftright("value", DIGIT_BITS)
    known = frame.where(F.col(value).isNotNull())
    whole = F.col(value).cast("bigint").alias("value")
    if counted:
        values = known.select(*keys, whole, F.col(times).alias("rows"))
    else:
        values = known.groupBy(*keys, whole).agg((F.sum(times) if times else F.count("*")).alias("rows"))
    middles = values.groupBy(*keys, coarse.alias("coarse"), middle.alias("middle")).agg(F.sum("rows").alias("rows"))
    coarses = middles.groupBy(*keys, "coarse").agg(F.sum("rows").alias("rows"))

    group = Window.partitionBy(*keys)
    position = {name: F.lit(float(point)) * (F.col("group_rows") - 1) for name, point in points.items()}
    wanted = [edge(place).cast("bigint") for place in position.values() for edge in (F.floor, F.ceil)]
    first = (
        coarses.withColumn("group_rows", F.sum("rows").over(group))
        .withColumn("ranks", F.array_distinct(F.array(*wanted)))
        .withColumn("base", F.lit(0).cast("bigint"))
    )
    opened = _narrow(first, keys, "coarse")
    second = _open(middles, opened, [*keys, "coarse"])
    opened = _narrow(second, [*keys, "coarse"], "middle")
    third = _open(values.withColumn("middle", middle), opened, [*keys, "middle"])
    found = _narrow(third, [*keys, "middle"], "value")

    def at(rank: Column) -> Column:
        inside = (rank >= F.col("below")) & (rank < F.col("below") + F.col("rows"))
        return F.max(F.when(inside, F.col("value")))

    results = []
    for name, place in position.items():
        low, high = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        results.append((low + share * (high - low)).alias(name))
    return found.groupBy(*keys).agg(*results)


def _open(children: DataFrame, parents: DataFrame, on: Sequence[str]) -> DataFrame:
    """Children of the kept parents, null-safe on the group columns."""
    renamed = parents.select(
        *[F.col(name).alias(f"parent_{name}") for name in on], F.col("below").alias("base"), "ranks", "group_rows"
    )
    same = F.lit(True)
    for name in on:
        same = same & F.col(name).eqNullSafe(F.col(f"parent_{name}"))
    return children.join(renamed, same).drop(*[f"parent_{name}" for name in on])
