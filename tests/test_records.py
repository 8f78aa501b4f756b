"""Quoted line breaks read over file splits against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.sources import csv, records
from ledgerflow.sources.staging import Staging


@pytest.fixture
def small_splits(spark):
    changed = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100", "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def content(pick, rows, end):
    """Lines of a file: notes with line breaks, quotes, commas and blank lines inside, long ones too."""
    notes = ["plain", 'say ""hi""', f"two{end}lines", f"{end}{end}", 'quote ""at{}the"" end'.replace("{}", end), "a,b", "x" * 300, "", f"{end}".join("lines" * 3 for _ in range(40))]
    lines = ['"Part Key",Note,Size']
    for at in range(rows):
        note = pick.choice(notes)
        lines.append(f'{at},"{note}",{at % 7}' if note else f"{at},,{at % 7}")
        if pick.random() < 0.05:
            lines.append("")
    return end.join(lines) + end


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_those_of_the_whole_file(small_splits, tmp_path, end):
    pick = random.Random(9)
    folder = tmp_path / "notes.csv"
    folder.mkdir()
    for at, rows in enumerate((200, 1, 0, 150)):
        (folder / f"part-{at}.csv").write_bytes(content(pick, rows, end).encode())
    expected = csv.read_checked_csv(small_splits, str(folder), multi_line=True).toDF("part_key", "note", "size", csv.MALFORMED)
    found = csv.read_numbered_csv(small_splits, str(folder), multi_line=True)
    assert found.columns == ["source_row_number", *expected.columns]
    rows = found.orderBy("source_row_number").collect()
    assert [row.source_row_number for row in rows] == list(range(1, 352))
    assert [row.part_key for row in rows] == [str(at) for at in range(200)] + ["0"] + [str(at) for at in range(150)]
    # Line breaks inside of quotes stay as they are in the file; Spark's reader makes them one character.
    plain = found.drop("source_row_number").withColumn("note", F.replace("note", F.lit("\r\n"), F.lit("\n")))
    assert sorted(map(str, plain.collect())) == sorted(map(str, expected.collect()))
    assert found.where(F.contains("note", F.lit(end))).count() > 50
    lines = records.numbered_lines(small_splits, str(folder))
    ranges = records.open_ranges(lines).where("last_line > first_line")
    assert ranges.count() > 100


def test_one_file_is_many_tasks(small_splits, tmp_path):
    path = tmp_path / "one.csv"
    path.write_bytes(content(random.Random(3), 400, "\n").encode())
    scan = small_splits.read.option("lineSep", "\n").text(str(path)).withColumn("task", F.spark_partition_id())
    sizes = [row["count"] for row in scan.groupBy("task").count().collect()]
    assert len(sizes) > 10
    assert max(sizes) < sum(sizes) / 4
    assert records.numbered_lines(small_splits, str(path)).agg(F.max("line_number"), F.count("*")).first() == (sum(sizes), sum(sizes))


def test_malformed_records_and_an_open_quote(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('a,b\n1,"x\ny",3\n4\n5,"never\n6,z\n')
    rows = csv.read_numbered_csv(spark, str(path), multi_line=True).orderBy("source_row_number").collect()
    assert [(row.source_row_number, row.a, row.malformed_line) for row in rows] == [(1, "1", '1,"x\ny",3'), (2, "4", "4"), (3, "5", None), (4, "6", None)]
    assert (rows[0].b, rows[2].b, rows[3].b) == ("x\ny", "never", "z")


def test_a_file_without_records(spark, tmp_path):
    (tmp_path / "none.csv").write_text("a,b\n")
    found = csv.read_numbered_csv(spark, str(tmp_path / "none.csv"), multi_line=True)
    assert (found.columns, found.count()) == (["source_row_number", "a", "b", csv.MALFORMED], 0)


def test_a_record_of_very_many_lines(spark):
    """A range of more lines than are listed at once, beside single lines."""
    lines = spark.range(1, 10_001).select(F.col("id").alias("line_number"), F.lit("f").alias("line_file"), F.when(F.col("id").isin(5, 9_000), '"').otherwise("x").alias("line"))
    ranges = Staging(spark).save(records.open_ranges(lines), "ranges")
    assert [tuple(row) for row in ranges.collect()] == [(5, 9_000)]
    found = {row.line_number: row.record for row in records.records(lines, ranges).collect()}
    assert len(found) == 10_000 - 8_995
    assert found[5] == "\n".join(['"', *["x"] * 8_994, '"'])


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_many_broken_lines_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Spark estimates the lines, and the list of lines of broken records, by the size of small files."""
    path = tmp_path / "broken.csv"
    path.write_text("a,b\n" + "".join(f'{at},"two\nlines"\n' for at in range(500)))
    lines = records.numbered_lines(spark, str(path))
    sent = "rightHint=(strategy=broadcast)"
    assert sent in plan(lines)
    assert plan(records.open_ranges(lines)).count(sent) > plan(lines).count(sent)
    ranges = Staging(spark).save(records.open_ranges(lines), "ranges")
    assert "strategy=merge" not in plan(records.records(lines, ranges))
    monkeypatch.setattr(records, "BROADCAST_ROWS", 999)
    found = records.records(lines, ranges)
    assert plan(found).count("rightHint=(strategy=merge)") == 2  # of single lines and of broken records
    assert sorted(row.record for row in found.collect()) == sorted(["a,b", *[f'{at},"two\nlines"' for at in range(500)]])
