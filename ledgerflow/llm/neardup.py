"""Near duplicates by SimHash with deletion-variant signatures.

A text's fingerprint comes from its runs of four words. Fingerprints that differ in at most ``RADIUS`` (4) bits are
linked. A fingerprint is cut into three segments: of four differing bits, one segment holds at most one. Each segment is
indexed with one bit blanked in turn, so linked fingerprints meet under an equal key (segment, blanked bit, other bits).
Copies share one fingerprint and are indexed once. Inside a key the distances are verified, and only a spanning forest of
the links goes on: never more edges than fingerprints. Components are then found by star steps.

``blocks`` refines the keys for very many fingerprints: the other segments, which differ in at most four bits, are cut
into five blocks of which one is equal, and that block joins the key.

A key with more than ``DENSE`` fingerprints is not compared pair by pair: two fingerprints are within four bits exactly if
some value is within two bits of both, so such a key is united over those values, in time in proportion to its size.

Edge cases: a null text has no words; without words the fingerprint is zero, linked like any other. With fewer than four
words the whole sequence is one term. Null doc_ids are never the smallest; a component of them has a null id. Repeated
rows get the same result each. An empty table gives an empty result. Other columns are passed on as they are."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import packed, store
from ledgerflow.llm.components import component_of
from ledgerflow.llm.simhash import as_hex

TERM_WORDS = 4
RADIUS = 4
SEED = 42
#: First bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
DENSE = 2048
_POINTS = 1 << 22
#: Fingerprints from which the refined keys are used: there a plain key would hold several by chance.
REFINE_FROM = 1 << 23
_VOTES = 1 << 16


def fingerprint(text: str | None) -> int:
    """Unsigned 64 bits; a bit is one where over half the terms' hashes set it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    runs = zip(*(itertools.islice(words, at, None) for at in range(TERM_WORDS)), strict=False)
    terms = map(b" ".join, runs) if len(words) >= TERM_WORDS else iter([b" ".join(words)])
    votes, total = np.zeros(64, dtype=np.int64), 0
    while len(hashes := np.fromiter((digest(t, SEED) for t in itertools.islice(terms, _VOTES)), dtype="<u8")):
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(text) for text in texts], dtype=np.uint64).view(np.int64))


def with_fingerprint(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, "long")(text)


def _ones(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def _blocks_beside(first: int, width: int, blocks: int) -> list[int]:
    """Masks that cut the bits outside a segment into ``blocks`` parts; no cut for one."""
    if blocks == 1:
        return [0]
    free = [bit for bit in range(64) if not first <= bit < first + width]
    return [sum(1 << bit for bit in free[at::blocks]) for at in range(blocks)]


def variant_masks(blocks: int = 1) -> list[int]:
    """The bits that each key keeps; two fingerprints within four bits agree on all bits of one mask at least."""
    return [
        _ones(first, width) & ~(1 << bit) | beside
        for first, width in SEGMENTS
        for bit in range(first, first + width)
        for beside in _blocks_beside(first, width, blocks)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def variants(distinct: DataFrame, blocks: int = 1) -> DataFrame:
    """(mask, key, fp): one row per distinct fingerprint and mask."""
    masks = F.array(*[F.lit(_signed(mask)) for mask in variant_masks(blocks)])
    return distinct.select("fp", F.posexplode(masks).alias("mask", "bits")).select(
        "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"), "fp"
    )


class Forest:
    """Union-find over positions."""

    def __init__(self, size: int):
        self.parent = list(range(size))
        self.edges: list[tuple[int, int]] = []

    def root(self, at: int) -> int:
        while self.parent[at] != at:
            self.parent[at] = at = self.parent[self.parent[at]]
        return at

    def link(self, left: int, right: int) -> None:
        a, b = self.root(left), self.root(right)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((left, right))


def _near_masks(radius: int) -> np.ndarray:
    bits = [1 << bit for bit in range(64)]
    return np.array([sum(c) for size in range(radius + 1) for c in itertools.combinations(bits, size)], dtype=np.uint64)


def forest_edges(found: np.ndarray, dense: int = DENSE) -> list[tuple[int, int]]:
    """Positions of a spanning forest of the links within ``RADIUS`` among distinct fingerprints (unsigned)."""
    forest = Forest(len(found))
    if len(found) <= dense:
        step = max(1, (1 << 20) // len(found))
        for begin in range(0, len(found), step):
            part = np.bitwise_count(found[begin : begin + step, None] ^ found[None, :]) <= RADIUS
            for left, right in np.argwhere(part).tolist():
                if left + begin < right:
                    forest.link(left + begin, right)
        return forest.edges
    masks = _near_masks(RADIUS // 2)
    passes = -(-len(found) * len(masks) // _POINTS)
    for turn in range(passes):
        points, owners = [], []
        for mask in masks:
            point = found ^ mask
            mine = np.flatnonzero((point * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(passes) == turn)
            points.append(point[mine])
            owners.append(mine)
        point, owner = np.concatenate(points), np.concatenate(owners)
        order = np.argsort(point, kind="stable")
        point, owner = point[order], owner[order]
        same = np.flatnonzero(point[1:] == point[:-1])
        for left, right in zip(owner[same].tolist(), owner[same + 1].tolist(), strict=True):
            forest.link(left, right)
    return forest.edges


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forest edges of each run of equal (mask, key); rows come sorted."""
    kept: list[np.ndarray] = []

    def edges_of(rows: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        sizes = np.diff(np.concatenate(([0], cut, [len(rows)])))
        begins = np.concatenate(([0], cut))
        left, right = [], []
        pairs = begins[sizes == 2]
        if len(pairs):
            a, b = rows[pairs, 2], rows[pairs + 1, 2]
            near = np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS
            left.append(a[near])
            right.append(b[near])
        for begin, size in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            found = np.ascontiguousarray(rows[begin : begin + size, 2])
            edges = np.array(forest_edges(found.view(np.uint64)), dtype=np.int64).reshape(-1, 2)
            if len(edges):
                left.append(found[edges[:, 0]])
                right.append(found[edges[:, 1]])
        empty = [np.zeros(0, dtype=np.int64)]
        return pa.RecordBatch.from_pydict({"u": np.concatenate(left + empty), "v": np.concatenate(right + empty)})

    for batch in batches:
        rows = np.stack([batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("mask", "key", "fp")], axis=1)
        if not len(rows):
            continue
        change = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1))
        if not len(change):  # one key so far: it may go on in the next batch
            if kept and (kept[-1][-1, :2] != rows[0, :2]).any():
                yield edges_of(np.concatenate(kept))
                kept = []
            kept.append(rows)
            continue
        last = int(change[-1]) + 1
        yield edges_of(np.concatenate([*kept, rows[:last]]))
        kept = [rows[last:]]
    if kept:
        yield edges_of(np.concatenate(kept))


def links(distinct: DataFrame, blocks: int = 1) -> DataFrame:
    """Edges (u, v) between distinct fingerprints within the radius that connect what the links connect."""
    keyed = variants(distinct, blocks).repartition("mask", "key").sortWithinPartitions("mask", "key")
    return keyed.mapInArrow(_links, "u long, v long").distinct()


def fingerprint_components(distinct: DataFrame) -> DataFrame:
    """(fp, component) for the linked ones among the stored distinct fingerprints (column fp)."""
    blocks = 5 if distinct.count() >= REFINE_FROM else 1
    edges = store(links(distinct.select("fp"), blocks), "fingerprint_links")
    return component_of(edges).select(F.col("node").alias("fp"), "component")


def _classes(rows: DataFrame) -> DataFrame:
    """The smallest doc_id of each fingerprint's component: (fp, component_id)."""
    distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    found = fingerprint_components(distinct)
    placed = distinct.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return placed.join(least, "component").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint and the smallest doc_id of its component."""
    rows = store(docs.select("doc_id", with_fingerprint(F.col("text")).alias("fp")), "fingerprints")
    joined = rows.join(_classes(rows), "fp")
    return joined.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one of each component of ``near_duplicates``: the one with the smallest doc_id, of equal ids the
    smallest text hash.

    Rows are known by doc_id and text hash. Only components of several rows are looked into. The texts are shuffled once,
    to meet the rows that go or repeat; that set grows with the corpus, so it is never broadcast."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = [name.alias("_id_"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("_text_")]
    rows = store(docs.select("doc_id", *key, with_fingerprint(F.col("text")).alias("fp")), "fingerprints")
    distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    found = fingerprint_components(distinct)
    placed = rows.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_text_")
    several = placed.groupBy("component").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    marked = placed.join(store(several, "first_of_component"), "component").groupBy("_id_", "_text_")
    marked = marked.agg(F.count("*").alias("copies"), F.max(order.eqNullSafe(F.col("first"))).alias("kept"))
    other = store(marked.filter("not kept or copies > 1").select("_id_", "_text_", "kept"), "not_kept_as_is")
    whole = packed(docs, *key).hint("merge").join(other, ["_id_", "_text_"], "left")
    # Of a repeated row one stays; the join has already brought its copies together.
    copy = F.row_number().over(Window.partitionBy("_id_", "_text_").orderBy(F.lit(0)))
    return whole.withColumn("_copy_", copy).filter("kept is null or kept and _copy_ = 1").select("_row_.*")
