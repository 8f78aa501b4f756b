"""Document fingerprints: SimHash over weighted terms, and permuted block tables to search them.

A term is a run of three words in lower case and votes once per occurrence, so its weight is its frequency in the text.
The likeness of two fingerprints is the cosine that their distance d of 64 bits stands for, cos(pi d / 64), at least 0.

Search: 64 bits are cut into six blocks. Fingerprints within three bits agree on three blocks at least, so each
fingerprint stands in twenty tables, one for each choice of three blocks, and a query meets its neighbours under equal
blocks. A pair counts in the first table where it agrees. Equal fingerprints stand in the tables once, with their number.

Edge cases: a null text counts as empty; without words the fingerprint is zero. With fewer than three words the whole
text is one term. Repeated rows (equal doc_id and text) stand once in the order of documents and get one result row each. In that order null comes last and
equal ids are ordered by their text's hash; the document after the last is the first, which may be itself. An empty table
gives an empty result. Other columns are not read."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import store, words
from ledgerflow.llm.simhash import BITS, _signed, as_hex, distance, fingerprints, term_hashes

TERM_WORDS = 3
RADIUS = 3
BLOCKS = 6
QUERY_STEP = 100


def text_fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One fingerprint per distinct ``keys``."""
    found = texts.select(*keys, words(F.lower(text)).alias("_words_"))
    return fingerprints(found.select(*keys, term_hashes(F.col("_words_"), TERM_WORDS).alias("hashes")), keys)


def likeness(left: Column, right: Column) -> Column:
    return F.greatest(F.lit(0.0), F.cos(F.lit(3.141592653589793) * distance(left, right) / BITS))


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """The bits kept by each table: all choices of ``blocks - radius`` blocks."""
    edges = [BITS * at // blocks for at in range(blocks + 1)]
    ones = [(1 << end) - (1 << begin) for begin, end in itertools.pairwise(edges)]
    return [sum(part) for part in itertools.combinations(ones, blocks - radius)]


def _tables(frame: DataFrame, masks: list[int], *columns: str) -> DataFrame:
    table = F.posexplode(F.array(*[F.lit(_signed(mask)) for mask in masks])).alias("table", "mask")
    return frame.select(*columns, table).withColumn("key", F.col(columns[0]).bitwiseAND(F.col("mask"))).drop("mask")


def within_radius(queries: DataFrame, held: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, rows) for distinct queries (column query) and all held (fingerprint, rows) in the radius."""
    masks = block_masks(radius=radius)
    left, right = _tables(queries, masks, "query"), _tables(held, masks, "fingerprint", "rows")
    apart = F.col("query").bitwiseXOR(F.col("fingerprint"))
    earlier = [F.when(apart.bitwiseAND(F.lit(_signed(mask))) == 0, F.lit(at)) for at, mask in enumerate(masks)]
    near = (F.bit_count(apart) <= radius) & (F.col("table") == F.coalesce(*earlier))
    return left.join(right, ["table", "key"]).filter(near).select("query", "fingerprint", "rows")


def follow(keys: DataFrame) -> DataFrame:
    """(key, next_key) in descending order of doc_id without a global sort in one task.

    ``keys`` has doc_id, key and other columns. Rows are cut into ranges; inside a range the next row follows, and the
    last row of a range is followed by the first row of the next range."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    ranged = store(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    inside = ranged.withColumn("after", F.lead("key").over(Window.partitionBy("part").orderBy(*order)))
    rank = F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), "key")
    parts = ranged.groupBy("part").agg(F.min_by("key", rank).alias("first"))
    every = Window.orderBy("part")
    wrap = F.first("first").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.select("part", F.coalesce(F.lead("first").over(every), wrap).alias("beyond"))
    return inside.join(parts, "part").withColumn("next_key", F.coalesce("after", "beyond")).drop("part", "after", "beyond")


def edited_texts(base: DataFrame, order: DataFrame) -> DataFrame:
    """Each text with its last half replaced by as many code points of the next document.

    Both joins read the same columns of ``base``, so the texts are shuffled once and that exchange is used twice."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    after = base.select(F.col("key").alias("next_key"), F.col("doc_id").alias("next_doc_id"), F.col("text").alias("after"))
    parts = order.join(after, "next_key").select("key", "n_chars", "next_key", "next_doc_id", F.left("after", half).alias("after"))
    kept = F.left(F.col("text"), (F.col("n_chars") - half).cast("int"))
    edited = F.concat(kept, F.col("after")).alias("edited")
    return base.join(parts, "key").select("key", "doc_id", "n_chars", "next_key", "next_doc_id", "text", edited)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    key = F.md5(F.concat_ws("|", name, text)).alias("key")
    base = docs.select("doc_id", text.alias("text"), key).dropDuplicates(["key"])
    counts = store(docs.select("doc_id", key, F.char_length(text).cast("long").alias("n_chars")), "fingerprint_rows")
    order = store(follow(counts.distinct()), "following")
    both = edited_texts(base, order)
    pair = F.explode(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("t")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("t"))))
    keys = ["key", "doc_id", "n_chars", "next_key", "next_doc_id", "sha"]
    versions = both.withColumn("sha", F.sha2("edited", 256)).select(*keys, pair.alias("v")).select(*keys, "v.version", "v.t")
    found = text_fingerprints(versions, [*keys, "version"], "t")
    of = lambda version: F.max(F.when(F.col("version") == version, F.col("fingerprint")))
    rows = store(found.groupBy(*keys).agg(of(0).alias("own"), of(1).alias("edited")), "document_fingerprints")
    after = rows.select(F.col("key").alias("next_key"), F.col("own").alias("next"))
    copies = counts.groupBy("key").agg(F.count("*").alias("copies"))
    near = rows.join(after, "next_key").join(neighbours(rows.join(copies, "key")), "own", "left")
    near = near.drop("doc_id", "n_chars").join(counts, "key")  # one result for each row of the input
    asked = (F.col("doc_id") % QUERY_STEP) == 0
    return near.select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        as_hex(F.col("own")).alias("fingerprint"),
        as_hex(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"),
        "next_doc_id",
    )


def neighbours(rows: DataFrame) -> DataFrame:
    """(own, n_near): for the fingerprints of the query rows (doc_id divisible by 100), documents within the radius."""
    held = rows.groupBy(F.col("own").alias("fingerprint")).agg(F.sum("copies").alias("rows"))
    asked = rows.filter(F.col("doc_id") % QUERY_STEP == 0).select(F.col("own").alias("query")).distinct()
    return within_radius(asked, held).groupBy(F.col("query").alias("own")).agg(F.sum("rows").alias("n_near"))
