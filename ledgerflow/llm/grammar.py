"""Token ids in files compressed by a grammar (Re-Pair), with random access.

Documents in ascending order of doc_id are cut into shards of whole documents. In a shard, the most frequent pairs of
neighbouring ids are replaced by new symbols, again and again, until no pair is frequent or a round shortens the sequence
by less than 1 %. A round takes many pairs at once; where two occurrences overlap, the more frequent pair wins, and of
those that are left over in a row (a run of one pair, say) every second one is taken. No pair reaches over a document's end, so a document is
a slice of the compressed sequence. The shard stores rules, the length each rule expands to and the slices; a reader
finds any token range from the lengths without expanding the rest.

A shard is one row of a Parquet table: part and shard (its place), doc_ids, n_tokens, payload. The payload is little
endian: ``RPG1``, then five 32-bit numbers (documents, rules, symbols, first rule's symbol, bytes a symbol), the rules as
pairs, their expanded lengths, the ends of the documents in the sequence, their token counts, the sequence.

Edge cases: a null or empty text is the end id alone. Null doc_ids come first; equal ids are ordered by their text, and
repeated rows are kept each. A very long text makes a shard of its own size. An empty table gives no shards."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import store
from ledgerflow.llm.tokens import encoded, gather, in_order, public_vocabulary

SHARD_TOKENS = 1 << 20
RULES_PER_ROUND = 2048
MINIMUM_COUNT = 16
#: A round that shortens the sequence by less ends the work.
MINIMUM_GAIN = 0.01
_MAGIC = b"RPG1"
_SLOTS = 15


def _frequent(keys: np.ndarray) -> np.ndarray:
    """The most frequent keys, most frequent first, equal counts by key."""
    if not len(keys):
        return keys
    ordered = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(first, len(ordered)))
    often = np.flatnonzero(counts >= MINIMUM_COUNT)
    best = often[np.lexsort((often, -counts[often]))][:RULES_PER_ROUND]
    return ordered[first[best]]


def _ranks(keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key its place among the chosen ones (or their number), by a table of hashes; of chosen keys that meet
    in a slot the first stays, the others wait for the next round. Returns the ranks and the chosen keys that stay."""
    kind, bits = keys.dtype.type, 8 * keys.dtype.itemsize
    slot = lambda k: (k * kind(0x9E3779B97F4A7C15 >> (64 - bits) | 1)) >> kind(bits - _SLOTS)
    _, first = np.unique(slot(chosen), return_index=True)
    chosen = chosen[np.sort(first)]
    none = np.int16(len(chosen))
    held, rank = np.zeros(1 << _SLOTS, dtype=keys.dtype), np.full(1 << _SLOTS, none)
    held[slot(chosen)], rank[slot(chosen)] = chosen, np.arange(len(chosen), dtype=np.int16)
    at = slot(keys)
    found = rank[at]
    found[held[at] != keys] = none
    return found, chosen


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(rules, sequence, ends of the documents in it, first rule's symbol) of a shard."""
    base = int(ids.max()) + 1
    kind, shift = (np.uint32, 16) if base + RULES_PER_ROUND <= 1 << 16 else (np.uint64, 32)
    sequence, rules = ids.astype(kind), []
    last = np.zeros(len(ids), dtype=bool)
    last[ends - 1] = True
    made = 0
    while len(sequence) > 1:
        if shift == 16 and base + made + RULES_PER_ROUND > 1 << 16:
            kind, shift = np.uint64, 32
            sequence = sequence.astype(kind)
        keys = (sequence[:-1] << kind(shift)) | sequence[1:]
        open_ = ~last[:-1]
        chosen = _frequent(keys[open_])
        if not len(chosen):
            break
        rank, chosen = _ranks(keys, chosen)
        none = rank.dtype.type(len(chosen))
        rank[last[:-1]] = none
        before, after = np.append(none, rank[:-1]), np.append(rank[1:], none)
        wanted = rank < none
        taken = wanted & (rank < before) & (rank <= after)
        near = taken.copy()
        near[1:] |= taken[:-1]
        near[:-1] |= taken[1:]
        if len(free := np.flatnonzero(wanted & ~near)):
            # Occurrences that lost to one that lost itself, such as those in a run of one pair: every second one.
            stretch = np.concatenate(([True], np.diff(free) > 1))
            begin = free[stretch][np.cumsum(stretch) - 1]
            taken[free[(free - begin) % 2 == 0]] = True
        hit = np.flatnonzero(taken)
        size = len(sequence)
        keep = np.ones(size, dtype=bool)
        keep[hit + 1] = False
        sequence[hit] = rank[hit].astype(kind) + kind(base + made)
        last[hit] = last[hit + 1]
        sequence, last = sequence[keep], last[keep]
        rules.append(np.stack((chosen >> kind(shift), chosen & kind((1 << shift) - 1)), axis=1).astype(np.uint32))
        made += len(chosen)
        if size - len(sequence) < MINIMUM_GAIN * size:
            break
    pairs = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.uint32)
    return pairs, sequence.astype(np.uint32), np.flatnonzero(last) + 1, base


def expanded_lengths(pairs: np.ndarray, base: int) -> np.ndarray:
    """Tokens each rule stands for; a rule refers to earlier rules only."""
    lengths: list[int] = []
    for left, right in pairs.tolist():
        lengths.append((1 if left < base else lengths[left - base]) + (1 if right < base else lengths[right - base]))
    return np.array(lengths, dtype=np.uint32)


def pack(ids: np.ndarray, ends: np.ndarray) -> bytes:
    pairs, sequence, slices, base = compress(ids, ends)
    width = 2 if base + len(pairs) <= 1 << 16 else 4
    head = np.array([len(ends), len(pairs), len(sequence), base, width], dtype="<u4")
    counts = np.diff(ends, prepend=0)
    parts = (head, pairs, expanded_lengths(pairs, base), slices, counts)
    return _MAGIC + b"".join(part.astype("<u4").tobytes() for part in parts) + sequence.astype(f"<u{width}").tobytes()


class Shard:
    """A reader of one payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a shard of token ids")
        documents, rules, symbols, self.base, width = np.frombuffer(payload, "<u4", 5, 4).tolist()
        at = 24
        self.pairs = np.frombuffer(payload, "<u4", 2 * rules, at).reshape(rules, 2)
        self.lengths = np.frombuffer(payload, "<u4", rules, at := at + 8 * rules).astype(np.int64)
        self.slices = np.frombuffer(payload, "<u4", documents, at := at + 4 * rules).astype(np.int64)
        self.counts = np.frombuffer(payload, "<u4", documents, at := at + 4 * documents).astype(np.int64)
        self.sequence = np.frombuffer(payload, f"<u{width}", symbols, at + 4 * documents).astype(np.int64)

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        rule = symbols >= self.base
        result = np.ones(len(symbols), dtype=np.int64)
        result[rule] = self.lengths[symbols[rule] - self.base]
        return result

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Replaces rules by their pairs until only ids are left."""
        while len(rule := np.flatnonzero(symbols >= self.base)):
            pairs = self.pairs[symbols[rule] - self.base]
            symbols = symbols.copy()
            symbols[rule] = pairs[:, 0]
            symbols = np.insert(symbols, rule + 1, pairs[:, 1])
        return symbols.astype(np.uint32)

    def all_ids(self) -> np.ndarray:
        """All ids of the shard: each distinct rule is expanded once."""
        used, at = np.unique(self.sequence, return_inverse=True)
        sizes = self.sizes(used)
        return gather(self.expand(used), sizes.cumsum() - sizes, sizes, at)

    def document(self, at: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of one document; symbols outside the range are not expanded."""
        symbols = self.sequence[self.slices[at - 1] if at else 0 : self.slices[at]]
        stop = int(self.counts[at]) if stop is None else min(stop, int(self.counts[at]))
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        ends = self.sizes(symbols).cumsum()
        first, after = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        skip = start - (ends[first - 1] if first else 0)
        return self.expand(symbols[first:after])[skip : skip + stop - start]


SHARDS = "part int, shard int, doc_ids array<long>, n_tokens long, payload binary"


def _shard_rows(vocabulary: str, shard_tokens: int):
    fields = {"part": pa.int32(), "shard": pa.int32(), "doc_ids": pa.list_(pa.int64()), "n_tokens": pa.int64(), "payload": pa.binary()}
    schema = pa.schema(list(fields.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, names, ids, ends, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def row() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            values = [[part], [shard], [names], [len(flat)], [pack(flat, np.concatenate(ends))]]
            return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(values, schema.types, strict=True)], schema=schema)

        for doc_ids, flat, stops in encoded(batches, vocabulary):
            begin = 0
            while begin < len(doc_ids):
                before = int(stops[begin - 1]) if begin else 0
                end = min(len(doc_ids), int(np.searchsorted(stops, before + shard_tokens - held)) + 1)
                names.extend(doc_ids[begin:end])
                ids.append(flat[before : stops[end - 1]])
                ends.append(stops[begin:end] - before + held)
                held += int(stops[end - 1]) - before
                begin = end
                if held >= shard_tokens:
                    yield row()
                    shard, names, ids, ends, held = shard + 1, [], [], [], 0
        if names:
            yield row()

    return run


def write_shards(docs: DataFrame, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encodes the documents, writes the shards and returns the stored table."""
    rows = in_order(docs).mapInArrow(_shard_rows(vocabulary or public_vocabulary(), shard_tokens), SHARDS)
    return store(rows, "token_shards")


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, first) where first counts the ids of all shards before; one row per part is added up in one task."""
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return (
        sizes.withColumn("inside", inside)
        .join(parts.select("part", before.alias("before")), "part")
        .select("part", "shard", (F.col("before") + F.col("inside")).alias("first"))
    )


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row["payload"])
            ids = shard.all_ids().astype("<u4").tobytes()
            stops = shard.counts.cumsum().tolist()
            begins = [0, *stops[:-1]]
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begins, stops, strict=True)]
            size = len(stops)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([row["part"]] * size, pa.int32()),
                    "shard": pa.array([row["shard"]] * size, pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "begin": pa.array(begins, pa.int64()),
                    "n_tokens": pa.array(shard.counts, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document, decoded from the stored shards: where its ids start, how many they are, and their checksum."""
    rows = shards.select("part", "shard", "doc_ids", "payload").mapInArrow(
        _read_rows, "part int, shard int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    )
    return rows.join(shard_starts(shards), ["part", "shard"]).select(
        "doc_id", (F.col("first") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return read_shards(write_shards(docs, vocabulary))
