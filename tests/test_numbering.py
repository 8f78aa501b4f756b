"""Row numbers, keys, lookups and exact quantiles against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import numbering
from ledgerflow.operators.quantiles import exact_quantiles
from ledgerflow.sources import csv
from ledgerflow.sources.staging import Staging, shared_folder


def test_total_order_with_one_heavy_leading_value(spark):
    rows = [(0 if at % 3 else at, at * 7919 % 1000, at) for at in range(1000)]
    frame = spark.createDataFrame(rows, "a int, b int, c int").repartition(6)
    numbered = numbering.number_by_total_order(frame, ["a", "b", "c"], "key", Staging(spark), "heavy")
    found = sorted((row.key, (row.a, row.b, row.c)) for row in numbered.collect())
    assert found == list(enumerate(sorted(rows), 1))


def test_position_ranges_stages_and_ties(spark):
    rows = [(stage, position, tie) for stage in (2, 1) for position in (9, 3, 700, 70_000) for tie in (1, 0)]
    frame = spark.createDataFrame(rows, "stage int, position bigint, tie int")
    numbered = numbering.number_by_position(frame, "key", "position", stage="stage", tie_break=["tie"], bits=4)
    assert [tuple(row)[1:] for row in numbered.orderBy("key").collect()] == sorted(rows)
    assert [row.key for row in numbered.orderBy("key").collect()] == list(range(1, len(rows) + 1))


def test_lines_are_numbered_in_file_order(spark, tmp_path):
    for name, start in (("a.csv", 0), ("b.csv", 5000), ("c.csv", 9000)):
        lines = "\n".join(f"{number},x" for number in range(start, start + (5000 if name == "a.csv" else 2000)))
        (tmp_path / name).write_text(f"Number,Other Text\n{lines}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        frame = csv.read_numbered_csv(spark, str(tmp_path))
        assert frame.columns == ["source_row_number", "number", "other_text", csv.MALFORMED]
        found = frame.select("source_row_number", F.col("number").cast("int")).orderBy("source_row_number").collect()
        assert frame.rdd.getNumPartitions() > 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [*range(5000), *range(5000, 7000), *range(9000, 11000)]
    assert [tuple(row) for row in found] == list(enumerate(expected, 1))


def test_missing_source_names_its_path(spark, tmp_path):
    with pytest.raises(Exception, match="customers.csv"):
        csv.ingest_source_files(spark, str(tmp_path))


def test_first_wins_keeps_one_null_key(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (3, None, "p"), (4, None, "q"), (5, "b", "z")]
    frame = spark.createDataFrame(rows, "source_row_number bigint, id string, value string")
    assert sorted(row.value for row in numbering.first_wins(frame, "id").collect()) == ["p", "x", "z"]


def test_first_wins_limits_rows_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("id"), F.col("id").alias("source_row_number"))
    plan = numbering.first_wins(frame, "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_unknown_member_and_lookup(spark):
    dimension = spark.createDataFrame([(1, "A", 2.5)], "key bigint, name string, size double")
    full = numbering.with_unknown_member(dimension, "key")
    assert sorted(tuple(row) for row in full.collect()) == [(0, "Unknown", None), (1, "A", 2.5)]
    frame = spark.createDataFrame([("A",), ("B",), (None,)], "label string")
    keyed = numbering.lookup_key(frame, full, "key", "label", "name")
    assert sorted((row.label or "", row.key) for row in keyed.collect()) == [("", 0), ("A", 1), ("B", 0)]


def test_quantiles_match_numpy(spark):
    random.seed(3)
    points = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.9, "q4": 1.0}
    values = {
        "few": [5],
        "pair": [-(2**41), 2**41 + 1],
        "wide": [random.randrange(-(2**50), 2**50) for _ in range(501)],
        "near": [random.randrange(0, 40) for _ in range(600)],
        "split": [2**20 - 1, 2**20, 2**40, 2**40 - 1],
        None: [1, 2, 2, 10],
    }
    rows = [(key, value) for key, numbers in values.items() for value in [*numbers, None]]
    found = exact_quantiles(spark.createDataFrame(rows, "k string, v bigint"), ["k"], "v", points)
    result = {row.k: tuple(row)[1:] for row in found.collect()}
    assert result.keys() == values.keys()
    for key, numbers in values.items():
        assert result[key] == pytest.approx([np.quantile(numbers, point) for point in points.values()], rel=1e-12)


def test_quantiles_of_everything(spark):
    frame = spark.range(1, 101).select((F.col("id") * 10**9).alias("v"))
    assert exact_quantiles(frame, [], "v", {"median": 0.5}).first().median == 50.5 * 10**9


def test_shared_folder_is_read_from_the_session(spark):
    assert Staging(spark).folder.startswith(shared_folder(spark))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_kept_rows_are_numbered_in_order(spark):
    import random

    pick = random.Random(12)
    places = sorted(pick.sample(range(1, 400_000), 90_000) + [400_001, 10**12, 10**12 + 63, 10**12 + 64])
    frame = spark.createDataFrame([(place, f"row {place}") for place in pick.sample(places, len(places))], "place bigint, text string")
    words = Staging(spark).save(numbering.kept_words(frame, "place"), "words")
    assert words.count() <= 400_001 // 64 + 3
    numbered = numbering.number_kept_rows(frame, "number", "place", words)
    assert numbered.columns == ["number", "place", "text"]
    assert [(row.number, row.place) for row in numbered.orderBy("number").collect()] == list(enumerate(places, 1))
    assert numbering.number_kept_rows(frame.limit(0), "number", "place", words).count() == 0


def test_kept_rows_are_numbered_without_a_shuffle(spark):
    frame = spark.range(1, 100_001).where("id % 7 <> 0").select(F.col("id").alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    frame = Staging(spark).save(frame, "rows")
    words = Staging(spark).save(numbering.kept_words(frame, "place"), "words")
    plan = numbering.number_kept_rows(frame, "number", "place", words)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert "Exchange rangepartitioning" not in plan


def test_rows_of_groups_are_numbered_in_total_order(spark):
    pick = random.Random(3)
    rows = [(pick.choice([None, -70_000, -1, 0, 5, 6, 65_535, 65_536, 10**12]), at % 4, at) for at in range(400)]
    frame = spark.createDataFrame(rows, "lead bigint, second int, third int").repartition(5)
    numbered = numbering.number_in_groups(frame, "lead", ["second", "third"], "key")
    assert numbered.columns == ["key", "lead", "second", "third"]
    ordered = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1:]))
    expected = [(at, *row) for at, row in enumerate(ordered, 1) if row[0] is not None]
    assert [tuple(row) for row in numbered.orderBy("key").collect()] == expected


def test_words_beyond_the_broadcast_limit_of_the_session_do_not_shuffle_the_rows(spark):
    frame = spark.range(1, 100_001).select(F.col("id").alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    frame = Staging(spark).save(frame, "rows")
    words = Staging(spark).save(numbering.kept_words(frame, "place"), "words")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = numbering.number_kept_rows(frame, "number", "place", words)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_only_the_starts_are_broadcast(spark):
    """rows whose files are small are not broadcast to the starts of their ranges; rows without a place are left out."""
    rows = spark.range(100).selectExpr("nullif(id, 50) AS place", "id % 2 AS part")
    numbered = numbering.number_by_position(rows, "number", "place", stage="part", bits=3)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan
    found = numbered.orderBy("number").collect()
    # The null place comes first in its part and is only counted.
    assert [row.place for row in found] == [*[at for at in range(0, 100, 2) if at != 50], *range(1, 100, 2)]
    assert [row.number for row in found] == list(range(2, 101))


def test_words_are_stored_many_to_a_row(spark):
    """F16: one row of the words is sent for 2,048 positions, with gaps inside a block and between blocks."""
    frame = spark.range(1, 100_001).where("id % 3 <> 0 and id % 4096 >= 100").select(F.col("id").alias("place"))
    words = Staging(spark).save(numbering.kept_words(frame, "place"), "words")
    assert words.count() == 100_000 // 2048 + 1
    numbered = numbering.number_kept_rows(spark.range(200_000).select(F.col("id").alias("place")), "number", "place", words)
    expected = [place for place in range(1, 100_001) if place % 3 and place % 4096 >= 100]
    assert [tuple(row) for row in numbered.orderBy("number").collect()] == list(enumerate(expected, 1))
