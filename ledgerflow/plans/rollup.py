"""Totals of the transaction fact by dimension attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators import facts

Tables = Mapping[str, DataFrame]

DIMENSION_KEYS = {
    "dim_customer": "customer_key",
    "dim_account": "account_key",
    "dim_merchant": "merchant_key",
    "dim_transaction_category": "transaction_category_key",
    "dim_channel": "channel_key",
    "dim_date": "date_key",
    "dim_location": "location_key",
    "dim_device": "device_key",
    "dim_branch": "branch_key",
    "dim_transaction_status": "transaction_status_key",
}


#: Key sets whose totals are stored; coarser ones are added up from these. The first is bounded by the calendar and the
#: vocabularies, the others by one dimension (and the categories).
ROLLUPS = (
    ("date_key", "transaction_category_key", "channel_key", "transaction_status_key", "is_recurring"),
    ("customer_key", "transaction_category_key"),
    ("merchant_key",),
    ("account_key",),
    ("location_key",),
)
ROLLUP_KEYS = tuple(dict.fromkeys(key for keys in ROLLUPS for key in keys))


def _measures() -> dict[str, Column]:
    return {
        "rows": F.count("*"),
        "transaction_count": F.count("transaction_id"),
        "total_transaction_value": F.sum("transaction_amount"),
        "approved_transaction_value": F.sum("approved_amount"),
        "debit_transaction_value": F.sum("debit_amount"),
        "credit_transaction_value": F.sum("credit_amount"),
        "net_transaction_flow": F.sum("signed_transaction_amount"),
        "approved_count": F.count_if("is_approved"),
        "declined_count": F.count_if("is_declined"),
        "reversed_count": F.count_if("is_reversed"),
        "pending_count": F.count_if("is_pending"),
        "international_transaction_count": F.count_if("is_international"),
        "recurring_transaction_count": F.count_if("is_recurring"),
        "largest_transaction_amount": F.max("transaction_amount"),
    }


def additive(*names: str) -> dict[str, Column]:
    """Aggregates over fact columns, by measure name: totals per key add up to totals per attribute."""
    known = _measures()
    return {name: known[name] for name in names}


def _rollup_id(keys: Sequence[str]) -> int:
    """The grouping id of a key set: one bit per key, set where the key is not in the set."""
    return sum(1 << at for at, key in enumerate(reversed(ROLLUP_KEYS)) if key not in keys)


def fact_rollups(fact: DataFrame) -> DataFrame:
    """All additive measures by each of the ``ROLLUPS``, with the grouping id in ``rollup_set``; the fact is read once."""
    sets = [[F.col(key) for key in keys] for keys in ROLLUPS]
    totals = [total.alias(name) for name, total in _measures().items()]
    return fact.groupingSets(sets, *[F.col(key) for key in ROLLUP_KEYS]).agg(F.grouping_id().alias("rollup_set"), *totals)


def fact_rollup(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``fact_rollups`` for one key set: the large sets send nearly a row per transaction, so they are only made
    where they are read."""
    totals = per_key(fact, keys, list(_measures()))
    cells = [F.col(key) if key in keys else F.lit(None).cast(fact.schema[key].dataType).alias(key) for key in ROLLUP_KEYS]
    return totals.select(*cells, F.lit(_rollup_id(keys)).cast("bigint").alias("rollup_set"), *_measures())


def _with_looked_up(frame: DataFrame, dimensions: Tables, business: Mapping[str, str]) -> DataFrame:
    for key in business:
        frame = facts.lookup_dimension(frame, dimensions, key)
    return frame


def valid_keys(valid: DataFrame, dimensions: Tables, keys: Sequence[str]) -> DataFrame:
    """The combinations of the given keys in the valid transactions, without the fact: business values are made distinct and
    looked up. Two business values may share a key, so combinations may still repeat."""
    business = {key: column for _, key, column, _ in facts.LOOKUPS if key in keys}
    pairs = facts.with_business_keys(valid).select(*[business.get(key, key) for key in keys]).distinct()
    return _with_looked_up(pairs, dimensions, business).select(*keys)


def valid_totals(valid: DataFrame, dimensions: Tables, keys: Sequence[str]) -> DataFrame:
    """All additive measures of the valid transactions by the given keys, without the fact: rows are summed by their business
    columns, and the totals are looked up. Two business values may share a key, so totals of a key are still to be added up."""
    business = {key: column for _, key, column, _ in facts.LOOKUPS if key in keys}
    rows = facts.measured(facts.with_business_keys(facts.in_cents(valid)))
    totals = per_key(rows, [business.get(key, key) for key in keys], list(_measures()))
    return _with_looked_up(totals, dimensions, business).select(*keys, *_measures())


def with_attributes(
    frame: DataFrame, tables: Tables, attributes: Mapping[str, Sequence[str]], how: str = "inner"
) -> DataFrame:
    """Joins the named attributes of each dimension by its surrogate key."""
    for dimension, columns in attributes.items():
        key = DIMENSION_KEYS[dimension]
        own = [name for name in columns if name != key]
        frame = frame.join(tables[dimension].select(key, *own), key, how)
    return frame


def per_key(fact: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(*[total.alias(name) for name, total in additive(*names).items()])


def rolled_up(tables: Tables, keys: Sequence[str]) -> DataFrame | None:
    """The smallest stored rollup that has the keys (``tables.rollup(keys)`` or ``tables.rollups()``, where the tables offer
    one of them), or the totals by just these keys (``tables.key_totals(keys)``, where there is no fact to read)."""
    held = [kept for kept in ROLLUPS if set(keys) <= set(kept)]
    if not held or not (hasattr(tables, "rollup") or hasattr(tables, "rollups")):
        return None
    own = tables.key_totals(keys) if hasattr(tables, "key_totals") else None
    if own is not None:
        return own
    smallest = min(held, key=len)
    stored = tables.rollup(smallest) if hasattr(tables, "rollup") else tables.rollups()
    return stored.where(F.col("rollup_set") == _rollup_id(smallest))


def _added_up(name: str) -> Column:
    if name == "largest_transaction_amount":
        return F.max(name)
    counted = name == "rows" or name.endswith("count")
    return F.coalesce(F.sum(name), F.lit(0)) if counted else F.sum(name)


def totals_by_key(tables: Tables, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Measures by fact columns, added up from a stored rollup that has them, else from the fact."""
    rows = rolled_up(tables, keys)
    if rows is None:
        return per_key(tables["fact_transaction"], keys, names)
    return rows.groupBy(*keys).agg(*[_added_up(name).alias(name) for name in names])


def per_attribute(
    tables: Tables,
    attributes: Mapping[str, Sequence[str]],
    names: Sequence[str],
    how: str = "inner",
    extra: Sequence[str] = (),
    fact: DataFrame | None = None,
) -> DataFrame:
    """Additive measures by dimension attributes (and by ``extra`` columns of the fact itself).

    The fact is summed per surrogate key first. Summing combines rows inside each task, so a heavy
    key costs one row per task, and the joins see totals instead of transactions."""
    keys = [*[DIMENSION_KEYS[dimension] for dimension in attributes], *extra]
    summed = totals_by_key(tables, keys, names) if fact is None else per_key(fact, keys, names)
    totals = with_attributes(summed, tables, attributes, how)
    groups = [*[name for columns in attributes.values() for name in columns], *extra]
    return totals.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in names])


def distinct_per_attribute(
    tables: Tables, attributes: Mapping[str, Sequence[str]], counted: str, name: str
) -> DataFrame:
    """Distinct fact keys by dimension attributes; pairs are made distinct before the joins. They come from the valid
    transactions (``tables.key_sets(keys)``) where there is no fact to read."""
    keys = [DIMENSION_KEYS[dimension] for dimension in attributes]
    columns = [*dict.fromkeys([*keys, counted])]
    rows = tables.key_sets(columns) if hasattr(tables, "key_sets") else None
    if rows is None:
        rows = rolled_up(tables, columns)
    pairs = (tables["fact_transaction"] if rows is None else rows).select(*columns).distinct()
    pairs = pairs.withColumn("counted", F.col(counted))
    groups = [column for columns in attributes.values() for column in columns]
    joined = with_attributes(pairs, tables, attributes)
    return joined.select(*groups, "counted").distinct().groupBy(*groups).agg(F.count("counted").alias(name))


def one_row(frames: Sequence[DataFrame]) -> DataFrame:
    """Several one-row frames side by side, without a cross join."""
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def as_rows(frame: DataFrame, cells: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """A one-row frame as name / value rows, in the given order."""
    entries = F.array(*[F.struct(F.lit(label).alias(name), cell.cast("double").alias(value)) for label, cell in cells.items()])
    return frame.select(F.inline(entries))


def plain_numbers(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, for consumers without a decimal type."""
    return frame.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if field.dataType.typeName() == "decimal"
            else F.col(f"`{field.name}`")
            for field in frame.schema
        ]
    )
