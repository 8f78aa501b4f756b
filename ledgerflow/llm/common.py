"""What the operators share: reading documents, words, stored tables, spans."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.staging import Staging

#: White space that separates words: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROW = "_row_number_"


#: Bytes of rows that go to a Python worker at once; texts can be long, and a batch is held several times over.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keeps the batches that Python workers get small, whatever the number of rows in them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def words(text: Column) -> Column:
    """The words of a text as an array; a null or blank text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """The whole row as struct ``_row_`` beside working columns, so that no input column clashes with them."""
    return docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row_"), *columns)


def store(frame: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the shared folder and reads it back; a lost executor costs no recomputation."""
    bound_batches(frame.sparkSession)
    return Staging(frame.sparkSession).save(frame, name)


def numbered(frame: DataFrame, name: str) -> DataFrame:
    """The stored frame with a row number that stays, as it is written with the rows."""
    return store(frame.withColumn(ROW, F.monotonically_increasing_id()), name)


def span_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined; spans are structs (start, kind number, end)."""
    names = F.array(*[F.lit(kind) for kind in kinds])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
