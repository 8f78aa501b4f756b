"""Lines repeated across documents, found in a sharded minimal perfect hash over the distinct lines.

A line's key is the line without white space at its ends and in lower case (A-Z). Keys of ``min_chars`` code points or more
that ``min_documents`` or more documents hold lose all their lines but those in the largest doc_id holding them.

1. The documents are read in blocks of bounded size. A block stores, for each document, the distinct keys of its lines as
   128-bit hashes; texts are not stored. It sends on each distinct key once, with its ``min_documents`` largest doc_ids, so a
   key that a third of all rows hold costs a few rows a block. From these come the count of documents (which ends at
   ``min_documents``) and the largest doc_id of every distinct key.
2. Distinct keys are dealt to shards by their hash, about ``SHARD_KEYS`` in each. A shard is a minimal perfect hash (levels
   of bits; a key takes the first level where no other key of its shard falls on its bit, and its place is the number of
   set bits before it) over arrays of fingerprints, counts and largest doc_ids.
3. A block probes each shard once with its distinct keys. A shard's arrays and its probes meet in one sorted stream, the arrays
   first, so a task holds one shard and one batch of probes. Probes that may lose lines go back to their block,
   which knows its documents.
4. The lines to drop, by doc_id, meet the texts in one join; lines are not joined.

Tables are stored between the steps, so a lost executor costs a step at most. Two different keys with the same 128 bits
would count as one.

Edge cases: a null or empty text is one empty line. A null doc_id is one document and smaller than any other. Rows with the
same doc_id are one document, and each gets its own result row. A text without lines to drop stays as it is, carriage
returns included; if all lines go, an empty text stays. Texts may be of any length: a text is a block of its own if need be. An empty
table gives an empty result. Other columns are passed on by ``without_repeated_lines``, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import bound_batches, packed, store
from ledgerflow.llm.tokens import bounded

MIN_CHARS = 20
MIN_DOCUMENTS = 3
SHARD_KEYS = 1 << 15
_SPACE = "\t\n\v\f\r "
_KEY = np.dtype([("high", "<u8"), ("low", "<u8")])
#: Bits a level has for each key that is left.
_ROOM = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


# Keys of lines ---------------------------------------------------------------------------------------------------------


def line_keys(texts: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, line number, key) of the lines of ``min_chars`` code points or more."""
    lines = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), "\n")
    coded = lines.flatten().dictionary_encode()
    plain = pc.ascii_lower(pc.ascii_trim(coded.dictionary, _SPACE))
    long_enough = pc.greater_equal(pc.utf8_length(plain), min_chars).to_numpy(zero_copy_only=False)
    keys = np.zeros(len(plain), dtype=_KEY)
    wanted = plain.filter(pa.array(long_enough)).cast(pa.large_binary()).to_pylist()
    keys[long_enough] = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, wanted)), dtype=_KEY)
    place = coded.indices.to_numpy(zero_copy_only=False)
    sizes = np.diff(lines.offsets.to_numpy())
    text = np.repeat(np.arange(len(sizes)), sizes)
    line = np.arange(len(text)) - np.repeat(sizes.cumsum() - sizes, sizes)
    chosen = long_enough[place] if len(place) else np.zeros(0, dtype=bool)
    return text[chosen], line[chosen], keys[place[chosen]]


_BLOCK = "block string, doc_ids array<long>, keys binary, sizes binary, documents binary"


def _blocks(min_chars: int):
    """A row per block: its distinct doc_ids (ascending, null first), its distinct keys (ascending), and for each key the documents
    that hold it, as places in ``doc_ids``."""
    import uuid

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            ids = batch.column("doc_id").to_pylist()
            distinct = sorted(set(ids), key=lambda i: (i is not None, i or 0))
            rank = {doc_id: at for at, doc_id in enumerate(distinct)}
            text, _, found = line_keys(batch.column("text"), min_chars)
            holder = np.array([rank[i] for i in ids], dtype="<u4")[text]
            order = np.lexsort((holder, found["low"], found["high"]))
            found, holder = found[order], holder[order]
            first = np.ones(len(found), dtype=bool)
            first[1:] = (found["high"][1:] != found["high"][:-1]) | (found["low"][1:] != found["low"][:-1])
            once = first.copy()
            once[1:] |= holder[1:] != holder[:-1]
            begins = np.append(np.flatnonzero(first[once]), int(once.sum()))
            keys, holder = found[first], holder[once]
            columns = {
                "block": pa.array([uuid.uuid4().hex], pa.string()),
                "doc_ids": pa.array([distinct], pa.list_(pa.int64())),
                "keys": pa.array([keys.tobytes()], pa.binary()),
                "sizes": pa.array([np.diff(begins).astype("<u4").tobytes()], pa.binary()),
                "documents": pa.array([holder.tobytes()], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, where each one's documents end, and the documents."""
    keys, sizes = np.frombuffer(row["keys"], dtype=_KEY), np.frombuffer(row["sizes"], dtype="<u4")
    return keys, sizes.astype(np.int64).cumsum(), np.frombuffer(row["documents"], dtype="<u4")


def _holders(most: int):
    """(high, low, doc_id) of each distinct key of a block with its ``most`` largest doc_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, ends, documents = _unpack(row)
                before = np.concatenate(([0], ends[:-1]))
                for back in range(1, most + 1):
                    has = np.flatnonzero(ends - before >= back)
                    ids = pa.array(row["doc_ids"], pa.int64()).take(pa.array(documents[ends[has] - back].astype(np.int64)))
                    high, low = (pa.array(np.ascontiguousarray(keys[part][has]).view(np.int64)) for part in ("high", "low"))
                    yield pa.RecordBatch.from_arrays([high, low, ids], names=["high", "low", "doc_id"])

    return run


def line_counts(blocks: DataFrame, most: int) -> DataFrame:
    """(high, low, n, largest) of each distinct key: its documents, counted up to ``most`` at least, and the largest."""
    pairs = blocks.mapInArrow(_holders(most), "high long, low long, doc_id long").distinct()
    return pairs.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc_id").alias("largest"))


# The index -------------------------------------------------------------------------------------------------------------


def _bits(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each key in a level of ``size`` bits."""
    mixed = (keys["high"] ^ (keys["low"] * _ODD) ^ np.uint64(level * 0x1000193 + 1)) * _ODD
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Distinct keys to 0 .. n-1. Levels are arrays of bits, stored packed."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [np.concatenate(([0], np.cumsum(level, dtype=np.int64))) for level in levels]
        self.starts = np.concatenate(([0], np.cumsum([int(b[-1]) for b in self.before], dtype=np.int64))).tolist()

    @classmethod
    def over(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(64, _ROOM * len(keys))
            at = _bits(keys, len(levels), size)
            level = np.bincount(at, minlength=size) == 1
            levels.append(level)
            keys = keys[~level[at]]
        return cls(levels)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some that are not of the set, any number for others."""
        result = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for number, level in enumerate(self.levels):
            at = _bits(keys[left], number, len(level))
            hit = level[at]
            result[left[hit]] = self.starts[number] + self.before[number][at[hit]]
            left = left[~hit]
        return result


class Shard:
    """Fingerprint, count and largest doc_id of each key, by its place in the perfect hash."""

    def __init__(self, hash_: PerfectHash, prints: np.ndarray, counts: np.ndarray, largest: np.ndarray, known: np.ndarray):
        self.hash, self.prints, self.counts, self.largest, self.known = hash_, prints, counts, largest, known

    @classmethod
    def over(cls, keys: np.ndarray, counts: np.ndarray, largest: np.ndarray, known: np.ndarray) -> Shard:
        hash_ = PerfectHash.over(keys)
        order = np.argsort(hash_.place(keys))
        prints = (keys["low"] >> np.uint64(32)).astype("<u4")
        return cls(hash_, prints[order], counts[order].astype("u1"), largest[order].astype("<i8"), known[order])

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, largest doc_id and whether it is known; count 0 for keys that are not of the set."""
        place = self.hash.place(keys)
        found = (place >= 0) & (self.prints[place] == (keys["low"] >> np.uint64(32)).astype("<u4"))
        return np.where(found, self.counts[place], 0), self.largest[place], self.known[place]

    def packed(self) -> bytes:
        sizes = np.array([len(self.hash.levels), *map(len, self.hash.levels), len(self.prints)], dtype="<u4")
        bits = [np.packbits(level).tobytes() for level in self.hash.levels]
        arrays = (self.prints.tobytes(), self.counts.tobytes(), self.largest.tobytes(), np.packbits(self.known).tobytes())
        return b"".join([sizes.tobytes(), *bits, *arrays])

    @classmethod
    def unpacked(cls, data: bytes) -> Shard:
        count = int(np.frombuffer(data, "<u4", 1)[0])
        *sizes, keys = np.frombuffer(data, "<u4", count + 1, 4).tolist()
        at, levels = 4 * (count + 2), []
        for size in sizes:
            levels.append(np.unpackbits(np.frombuffer(data, "u1", -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        prints, counts = np.frombuffer(data, "<u4", keys, at), np.frombuffer(data, "u1", keys, at + 4 * keys)
        largest = np.frombuffer(data, "<i8", keys, at + 5 * keys)
        known = np.unpackbits(np.frombuffer(data, "u1", -(-keys // 8), at + 13 * keys), count=keys).astype(bool)
        return cls(PerfectHash(levels), prints, counts, largest, known)


def _shard_of(high: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the upper 31 bits."""
    return ((high >> np.uint64(33)).astype(np.int64) * shards) >> 31


def _build(rows: pa.Table) -> pa.Table:
    keys = np.empty(rows.num_rows, dtype=_KEY)
    keys["high"], keys["low"] = (rows.column(part).to_numpy().view(np.uint64) for part in ("high", "low"))
    largest = rows.column("largest")
    known = np.array(pc.is_valid(largest))
    shard = Shard.over(keys, rows.column("n").to_numpy(), pc.fill_null(largest, 0).to_numpy(), known)
    return pa.table({"shard": rows.column("shard").slice(0, 1), "arrays": pa.array([shard.packed()], pa.binary())})


def line_index(counts: DataFrame, shards: int, most: int = 255) -> DataFrame:
    """(shard, arrays): the packed shards; counts end at ``most``."""
    upper = F.shiftrightunsigned("high", 33)
    dealt = counts.withColumn("shard", F.shiftright(upper * shards, 31))
    limited = dealt.select("shard", "high", "low", F.least("n", F.lit(most)).alias("n"), "largest")
    return limited.groupBy("shard").applyInArrow(_build, "shard long, arrays binary")


# Probing ---------------------------------------------------------------------------------------------------------------


def _probes(shards: int):
    """(shard, arrays, block, keys, places): the distinct keys of a block by shard, with their places in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["keys"], dtype=_KEY)  # ascending, so shards come in runs
                number, begin = np.unique(_shard_of(keys["high"], shards), return_index=True)
                ends = np.append(begin, len(keys))[1:].tolist()
                runs = list(zip(begin.tolist(), ends, strict=True))
                columns = {
                    "shard": pa.array(number, pa.int64()),
                    "arrays": pa.nulls(len(runs), pa.binary()),
                    "block": pa.array([row["block"]] * len(runs), pa.string()),
                    "keys": pa.array([keys[a:b].tobytes() for a, b in runs], pa.binary()),
                    "first": pa.array(begin, pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


_FIELDS = "shard long, arrays binary, block string, keys binary, first long"


def _answer(min_documents: int):
    """Reads a stream sorted by shard, its arrays first: (block, places, largest, known) of the keys that may lose lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = None, None
        for batch in batches:
            out: dict[str, list] = {"block": [], "places": [], "largest": [], "known": []}
            for row in batch.to_pylist():
                if row["arrays"] is not None:
                    number, shard = row["shard"], Shard.unpacked(row["arrays"])
                    continue
                if row["shard"] != number:
                    raise ValueError(f"no arrays for shard {row['shard']}")
                count, largest, known = shard.probe(np.frombuffer(row["keys"], dtype=_KEY))
                many = np.flatnonzero(count >= min_documents)
                if len(many):
                    out["block"].append(row["block"])
                    out["places"].append((many + row["first"]).astype("<u4").tobytes())
                    out["largest"].append(largest[many].tobytes())
                    out["known"].append(known[many].astype("u1").tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=_ANSWER)

    return run


_ANSWER = pa.schema([("block", pa.string()), ("places", pa.binary()), ("largest", pa.binary()), ("known", pa.binary())])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, dropped): the hashes of the lines that a document of the block loses."""
    for batch in batches:
        for row in batch.to_pylist():
            keys, ends, documents = _unpack(row)
            before = np.concatenate(([0], ends[:-1])).astype(np.int64)
            ids = np.array([i or 0 for i in row["doc_ids"]], dtype=np.int64)
            is_known = np.array([i is not None for i in row["doc_ids"]], dtype=bool)
            place, holder = [], []
            for answer in row["answers"]:
                places = np.frombuffer(answer["places"], "<u4").astype(np.int64)
                largest, known = np.frombuffer(answer["largest"], "<i8"), np.frombuffer(answer["known"], "u1").astype(bool)
                sizes = ends[places] - before[places]
                at = np.repeat(np.arange(len(places)), sizes)
                mine = documents[np.arange(len(at)) - np.repeat(sizes.cumsum() - sizes, sizes) + before[places][at]]
                stays = (is_known[mine] == known[at]) & (ids[mine] == largest[at])
                place.append(places[at][~stays])
                holder.append(mine[~stays])
            place, holder = np.concatenate(place), np.concatenate(holder)
            order = np.argsort(holder, kind="stable")
            place, holder = place[order], holder[order]
            number, begin = np.unique(holder, return_index=True)
            cut = np.append(begin, len(holder)).tolist()
            columns = {
                "doc_id": pa.array([row["doc_ids"][at] for at in number.tolist()], pa.int64()),
                "dropped": pa.array([keys[place[a:b]].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns)


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, dropped): for each document that loses lines, the hashes of their keys; one row per document and block.

    ``min_documents`` is 1 to 255; with 1, every line stays in one document only."""
    spark = docs.sparkSession
    bound_batches(spark)
    blocks = store(docs.select("doc_id", "text").mapInArrow(_blocks(min_chars), _BLOCK), "line_blocks")
    counts = store(line_counts(blocks, min_documents), "line_counts")
    shards = max(1, -(-counts.count() // SHARD_KEYS))
    index = line_index(counts, shards, min_documents)
    arrays = index.select("shard", "arrays", *[F.lit(None).cast(kind).alias(name) for name, kind in (("block", "string"), ("keys", "binary"), ("first", "long"))])
    met = arrays.unionByName(blocks.select("block", "keys").mapInArrow(_probes(shards), _FIELDS))
    met = met.repartition("shard").sortWithinPartitions("shard", F.col("arrays").isNull())
    answers = met.mapInArrow(_answer(min_documents), "block string, places binary, largest binary, known binary")
    # A block has one answer from each shard at most, over its own keys.
    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("places", "largest", "known")).alias("answers"))
    return gathered.join(blocks, "block").mapInArrow(_decide, "doc_id long, dropped binary")


# Texts -----------------------------------------------------------------------------------------------------------------


def _clean(min_chars: int):
    def run(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
        rows = []
        for text, hashes in zip(texts, dropped, strict=True):
            whole = text or ""
            lines = whole.split("\n")
            gone = 0
            if hashes is not None and len(hashes):
                _, line, keys = line_keys(pa.array([whole], pa.large_string()), min_chars)
                bad = set(np.frombuffer(b"".join(hashes), dtype=_KEY).tolist())
                out = {at for at, key in zip(line.tolist(), keys.tolist(), strict=True) if key in bad}
                gone = len(out)
                whole = "\n".join(line for at, line in enumerate(lines) if at not in out) if out else whole
            rows.append((whole if gone else text, len(lines), gone))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    return run


def _cleaned(text: Column, dropped: Column, min_chars: int) -> Column:
    return F.pandas_udf(_clean(min_chars), "text string, n_lines long, n_dropped long")(text, dropped)


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents with struct column ``lines``: text without its repeated lines, n_lines before, n_dropped.

    A column ``lines`` of the input is replaced."""
    gone = repeated_lines(docs, min_chars, min_documents).groupBy("doc_id").agg(F.collect_list("dropped").alias("dropped"))
    gone = store(gone, "dropped_lines")
    whole = packed(docs, F.col("doc_id").alias("_id_")).join(gone, F.col("_id_").eqNullSafe(F.col("doc_id")), "left")
    found = whole.select("_row_", _cleaned(F.col("_row_.text"), F.col("dropped"), min_chars).alias("_lines_"))
    return found.select(*[F.col(f"_row_.`{name}`").alias(name) for name in docs.columns if name != "lines"], F.col("_lines_").alias("lines"))


def line_dedup(docs: DataFrame) -> DataFrame:
    found = without_repeated_lines(docs.select("doc_id", "text"))
    kept = F.sha2(F.coalesce("lines.text", F.lit("")), 256)
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", kept.alias("kept_sha256"))


def line_dedup_sql() -> str:
    space = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH rows_ AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines_ AS MATERIALIZED (SELECT rid, doc_id, i, parts[i] AS line, translate(trim(parts[i], {space}), '{upper}', '{lower}') AS key
          FROM rows_, unnest(range(1, len(parts) + 1)) AS places(i)),
        many AS (SELECT key, max(doc_id) AS largest FROM lines_ WHERE length(key) >= {MIN_CHARS}
          GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= {MIN_DOCUMENTS}),
        marked AS (SELECT lines_.*, many.key IS NOT NULL AND lines_.doc_id IS DISTINCT FROM many.largest AS gone
          FROM lines_ LEFT JOIN many ON lines_.key = many.key)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY rid"""
