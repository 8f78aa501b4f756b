"""Row numbers, surrogate keys and first-wins deduplication without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerflow.sources.staging import Staging

ROWS_PER_BUCKET_BITS = 16
LOCAL_INDEX_MASK = (1 << 33) - 1


#: Buckets that are added up in one task before their sum goes on: 2**12.
BUCKETS_TOGETHER_BITS = 12


def _before(rows: str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(rows).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _split_offsets(sizes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows before each file split. One row per split comes in, so the single window is small."""
    return sizes.select(*order, _before("bucket_rows", Window.orderBy(*order)).alias("bucket_start"))


def _offsets(sizes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows before each bucket; ``order`` ends with the bucket's number.

    Buckets are added up in groups, and only the groups' sums meet in one task: one row for 2**12 buckets, which is one
    for 2**28 rows where a bucket holds 2**16."""
    *lead, bucket = order
    grouped = sizes.withColumn("bucket_group", F.shiftright(F.col(bucket).cast("bigint"), BUCKETS_TOGETHER_BITS))
    group = [*lead, "bucket_group"]
    inside = grouped.select(
        *order, "bucket_group", _before("bucket_rows", Window.partitionBy(*group).orderBy(bucket)).alias("rows_inside")
    )
    sums = grouped.groupBy(*group).agg(F.sum("bucket_rows").alias("group_rows"))
    starts = sums.select(*group, _before("group_rows", Window.orderBy(*group)).alias("group_start"))
    return inside.join(starts, group).select(*order, (F.col("group_start") + F.col("rows_inside")).alias("bucket_start"))


def number_by_total_order(frame: DataFrame, order: Sequence[str], key: str, staging: Staging, name: str) -> DataFrame:
    """Dense 1..n in the order of the given columns, for keys of any distribution.

    Range partitioning splits a heavy leading value over the later columns, so give columns that
    tell rows apart. The sorted rows are staged once: partition bounds come from a sample, and
    counting and numbering must see the same partitions."""
    local_index = F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL_INDEX_MASK))
    placed = (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"bucket": F.spark_partition_id(), "local_index": local_index})
    )
    placed = staging.save(placed, name)
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("bucket_rows"))
    number = F.col("bucket_start") + F.col("local_index") + 1
    numbered = placed.join(_offsets(sizes, ["bucket"]), "bucket")
    return numbered.select(number.alias(key), *frame.columns)


def number_in_groups(frame: DataFrame, lead: str, order: Sequence[str], key: str) -> DataFrame:
    """Dense 1..n in the order of a whole-number column and, among its rows, of the other columns; rows whose ``lead`` is
    null come first and are only counted, not returned.

    For a lead of few rows per value, such as the order of a line: rows are shuffled once, by the lead, so a later join on it
    moves them no more. What precedes a value comes from counts per value. A value of very many rows is one task's sort; use
    ``number_by_total_order`` for such columns."""
    value = F.col(lead)
    sizes = frame.groupBy(value).agg(F.count("*").alias("bucket_rows"))
    cut = sizes.withColumn("bucket", F.shiftright(value.cast("bigint"), ROWS_PER_BUCKET_BITS))
    buckets = frame.groupBy(F.shiftright(value.cast("bigint"), ROWS_PER_BUCKET_BITS).alias("bucket"))
    offsets = _offsets(buckets.agg(F.count("*").alias("bucket_rows")), ["bucket"])
    inside = cut.where(value.isNotNull()).withColumn("rows_inside", _before("bucket_rows", Window.partitionBy("bucket").orderBy(lead)))
    starts = inside.join(offsets, "bucket")  # the bucket of null leads comes first in the offsets
    starts = starts.select(value.alias("lead_value"), (F.col("bucket_start") + F.col("rows_inside")).alias("lead_start"))
    place = F.row_number().over(Window.partitionBy(lead).orderBy(*order))
    placed = frame.where(value.isNotNull()).withColumn("place", place)
    numbered = placed.join(starts, F.col(lead) == F.col("lead_value"))
    return numbered.select((F.col("lead_start") + F.col("place")).alias(key), *frame.columns)


def number_by_position(
    frame: DataFrame,
    key: str,
    position: str,
    *,
    stage: str | None = None,
    tie_break: Sequence[Column | str] = (),
    bits: int = ROWS_PER_BUCKET_BITS,
) -> DataFrame:
    """Dense 1..n in the order of a whole-number position.

    Positions are cut into ranges of 2**bits, so one task sorts one range only. Counting the
    ranges and adding their starts replaces a sort of the whole frame. ``stage`` is an optional
    whole-number column that comes first in the order, ``tie_break`` orders rows that share a
    position (their number per position must be small)."""
    lead = [stage] if stage else []
    cut = frame.withColumn("bucket", F.shiftright(F.col(position).cast("bigint"), bits))
    buckets = [*lead, "bucket"]
    sizes = cut.groupBy(*buckets).agg(F.count("*").alias("bucket_rows"))
    starts = _offsets(sizes, buckets)
    within = Window.partitionBy(*buckets).orderBy(position, *tie_break)
    number = F.col("bucket_start") + F.row_number().over(within)
    # A left join can only broadcast the starts: Spark may take the rows for small by the size of the files they come from.
    return cut.dropna(subset=buckets).join(starts, buckets, "left").select(number.alias(key), *frame.columns)


WORD_BITS = 6

#: Words that are stored as one row: 2**5, for 2**11 positions. A row by itself costs three times its word in a broadcast.
WORDS_TOGETHER_BITS = 5

#: Rows of stored words that are sent to every executor whatever Spark's limit: about 50 MB of them, for 2**28 positions.
BROADCAST_WORDS = 1 << 17

#: Rows of a stored lookup table, of an id and a few short columns, that are sent likewise: about 50 MB.
BROADCAST_ROWS = 1 << 19


def sent(table: DataFrame) -> DataFrame:
    """The table, to be broadcast, unless the session has turned broadcasts off. For a row per file or file split."""
    limit = table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return table if limit.startswith("-") else F.broadcast(table)


def merged(table: DataFrame) -> DataFrame:
    """The table, never to be broadcast. Spark takes a stored table for as small as its compressed files; as rows of a
    broadcast, which all pass through the driver, ids can take fifty times as much."""
    return table.hint("merge")


def merged_if_large(table: DataFrame, counted: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The table, never to be broadcast where the stored table ``counted`` has many rows; else Spark decides by size."""
    return merged(table) if counted.count() > most else table


def sent_if_small(table: DataFrame, counted: DataFrame | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """The table, to be broadcast where it has few rows, unless the session has turned broadcasts off, and never where it has
    many. ``counted`` is the stored table whose rows are counted in its place."""
    limit = table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return table
    return F.broadcast(table) if (table if counted is None else counted).count() <= most else merged(table)


def _shifted(bits: int, place: Column) -> Column:
    """The bits moved up to the place's bit in its word."""
    return F.call_function("shiftleft", F.lit(bits).cast("bigint"), place.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int"))


def position_words(frame: DataFrame, position: str) -> DataFrame:
    """Which whole-number positions occur, as words of 64 bits: (word, word_bits). One row for 64 positions, combined before
    the shuffle."""
    place = F.col(position).cast("bigint")
    return frame.groupBy(F.shiftright(place, WORD_BITS).alias("word")).agg(F.bit_or(_shifted(1, place)).alias("word_bits"))


def kept_words(frame: DataFrame, position: str) -> DataFrame:
    """The ``position_words`` of a frame as ``counted_words``."""
    return counted_words(position_words(frame, position))


def counted_words(words: DataFrame) -> DataFrame:
    """(block, block_start, words, starts): the bits of 2**WORDS_TOGETHER_BITS words by their place in the block, the positions
    before the block, and those in the block before each word. The words are read twice."""
    words = words.withColumns({"bucket": F.shiftright("word", ROWS_PER_BUCKET_BITS - WORD_BITS), "bucket_rows": F.bit_count("word_bits").cast("bigint")})
    sizes = words.groupBy("bucket").agg(F.sum("bucket_rows").alias("bucket_rows"))
    inside = _before("bucket_rows", Window.partitionBy("bucket").orderBy("word"))
    counted = words.withColumn("rows_inside", inside).join(_offsets(sizes, ["bucket"]), "bucket")
    counted = counted.withColumn("block", F.shiftright("word", WORDS_TOGETHER_BITS))
    # A block lies in one bucket, so its words are together already.
    places = range(1 << WORDS_TOGETHER_BITS)

    def by_place(column: str) -> list[Column]:
        place = F.col("word").bitwiseAND(F.lit(len(places) - 1))
        return [F.max(F.when(place == at, F.col(column))) for at in places]

    before = F.min(F.col("bucket_start") + F.col("rows_inside")).alias("block_start")
    blocks = counted.groupBy("bucket", "block").agg(
        before, F.min("rows_inside").alias("first_inside"), F.array(*by_place("word_bits")).alias("words"), F.array(*by_place("rows_inside")).alias("inside")
    )
    starts = F.transform("inside", lambda rows: (rows - F.col("first_inside")).cast("smallint")).alias("starts")
    return blocks.select("block", "block_start", "words", starts)


def number_kept_rows(frame: DataFrame, key: str, position: str, words: DataFrame) -> DataFrame:
    """Dense 1..n in the order of a whole-number position that no two rows share, from stored ``kept_words``; rows whose
    position is not among them are left out.

    The rows themselves are not sorted. The words (about 400 bytes for 2,048 rows) are broadcast up to ``BROADCAST_WORDS``,
    unless the session has turned broadcasts off, and then the rows are not shuffled either; beyond, they are."""
    place = F.col(position).cast("bigint")
    at = F.shiftright(place, WORD_BITS).bitwiseAND(F.lit((1 << WORDS_TOGETHER_BITS) - 1)).cast("int")
    bits = F.get("words", at)
    below, kept = F.bitwise_not(_shifted(-1, place)), bits.bitwiseAND(_shifted(1, place)) != 0
    number = F.col("block_start") + F.get("starts", at) + F.bit_count(bits.bitwiseAND(below)) + 1
    words = sent_if_small(words, most=BROADCAST_WORDS)
    joined = frame.withColumn("block", F.shiftright(place, WORD_BITS + WORDS_TOGETHER_BITS)).join(words, "block").where(kept)
    return joined.select(number.alias(key), *frame.columns)


def number_lines_of_files(frame: DataFrame, key: str = "source_row_number") -> DataFrame:
    """Dense 1..n over a text-file scan in file order, without sorting or shuffling the rows.

    Needs the scan columns ``file_path``, ``file_start`` and ``scan_id`` (see ``sources.csv``).
    Scan ids grow by one inside a file split, so a row's place is its distance from the split's
    first id; only one row per split is counted and ordered."""
    split = ["file_path", "file_start"]
    sizes = frame.groupBy(*split).agg(F.count("*").alias("bucket_rows"), F.min("scan_id").alias("first_id"))
    starts = _split_offsets(sizes, split).join(sizes.select(*split, "first_id"), split)
    number = F.col("bucket_start") + F.col("scan_id") - F.col("first_id") + 1
    kept = [name for name in frame.columns if name not in (*split, "scan_id")]
    return frame.join(sent(starts), split).select(number.alias(key), *kept)


def first_wins(frame: DataFrame, key: str, order: str = "source_row_number") -> DataFrame:
    """One row per key, the one that comes first; a null key counts as a value.

    ``row_number() = 1`` is limited before the shuffle, so a heavy key sends one row per task."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return frame.withColumn("place", place).where("place = 1").drop("place")


def with_unknown_member(dimension: DataFrame, key: str) -> DataFrame:
    """Adds the member with key 0: ``Unknown`` in text columns, null in typed ones."""
    cells = [
        F.lit(0) if field.name == key else F.lit("Unknown") if field.dataType.typeName() == "string" else F.lit(None)
        for field in dimension.schema
    ]
    row = [cell.cast(field.dataType).alias(field.name) for cell, field in zip(cells, dimension.schema)]
    unknown = dimension.sparkSession.range(1).select(*row)
    return unknown.unionByName(dimension)


def lookup_key(frame: DataFrame, dimension: DataFrame, key: str, on: str, business_key: str) -> DataFrame:
    """Adds the dimension's surrogate key, 0 where the business key is missing or unknown.

    No broadcast is forced: Spark compares the stored dimension's size with its limit, and splits
    heavy keys of a large one."""
    pairs = dimension.select(F.col(key), F.col(business_key).alias("looked_up"))
    joined = frame.join(pairs, F.col(on) == F.col("looked_up"), "left").drop("looked_up")
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(0).cast("bigint")))
