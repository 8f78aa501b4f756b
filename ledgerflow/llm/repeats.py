"""Removal of repeated byte strings by a column-wise collection Burrows-Wheeler transform.

A byte goes if a string of ``SIZE`` (200) bytes that covers it also starts anywhere else in the collection. Building the
transform over whole documents takes as many rounds over all bytes as the longest document has symbols. So the collection
is first cut into places where repeats can meet, and the transform is built over short strings of equal layout:

* Every window of 200 bytes has an anchor: the least of the hashes of its 32-byte strings (the last one of equals). The
  choice depends on the window's bytes alone, so equal windows have equal anchors at the same place. A run of windows with
  one anchor is an occurrence; its bytes are at most 368, laid out around the anchor.
* Occurrences whose anchor hash is found once hold no repeat. Where all occurrences of a hash have the same layout and
  bytes, all of their windows are repeats. This settles most of the text from sums by hash.
* The others are distinct strings around one anchor. They are sent to the task of their anchor, and a round inserts one
  symbol of every string, from the last column to the first: the order of the suffixes is updated by the symbols
  (the last-to-first mapping), and the common prefixes of neighbours follow from the least ones between them. Columns lie
  in an external file that is read in sequence; only order and prefixes are in memory. A window whose neighbour in the
  order shares 200 bytes is a repeat.
* An anchor with more than ``CROWD`` distinct strings is not gathered in one task: its windows are counted by their own
  hash instead.

Edge cases: a null text counts as empty; texts under 200 bytes keep all bytes, as matches never cross documents.
Repeated rows are occurrences of their own: a repeated text of 200 bytes or more is removed whole in all its rows. Long
texts are read in overlapping slices. An empty table gives an empty result. Other columns are not read."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import store

SIZE = 200
GRAM = 32
#: Starts of windows that one anchor can serve.
REACH = SIZE - GRAM + 1
CROWD = 20_000
#: Strings of one transform, and bytes of a slice of text.
COLLECTION = 1 << 16
SLICE = 2 << 20
KEYS = ["k1", "k2"]

_PLACE = 24
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@cache
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and powers of the hash's base and of its inverse."""
    symbols = np.random.default_rng(200).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    power = np.full(size + 1, _BASE, dtype=np.uint64)
    inverse = np.full(size + 1, _BASE_INVERSE, dtype=np.uint64)
    power[0] = inverse[0] = 1
    return symbols, power.cumprod(dtype=np.uint64), inverse.cumprod(dtype=np.uint64)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


class Rolling:
    """Hashes of any stretch of a byte array; equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        symbols, self.power, inverse = _tables(max(SLICE + SIZE, 1 << (len(data) + 1).bit_length()))
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), (symbols[data] * inverse[: len(data)]).cumsum(dtype=np.uint64)))

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[begin]) * self.power[begin])


def _least_before(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys."""
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(keys) - width + 1
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each begin, one after another."""
    ends = sizes.cumsum()
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def occurrences(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, layout hash, anchor, first window, last window) of the runs of windows with one anchor.

    ``data`` holds texts one after another, positions are from its start."""
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    windows = _spread(starts, np.maximum(0, ends - starts - SIZE + 1))
    if not len(windows):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none, none
    rolling = Rolling(data)
    grams = np.arange(len(data) - GRAM + 1)
    hashes = rolling.between(grams, grams + GRAM)
    low = np.uint64((1 << _PLACE) - 1)
    # The place counts down, so that the last of equal hashes is the least.
    least = _least_before((hashes & ~low) | (low - grams.astype(np.uint64)), REACH)[windows]
    anchor = (low - (least & low)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.append(first[1:], len(anchor)) - 1
    begin, end, anchor = windows[first], windows[last], anchor[first]
    layout = rolling.between(begin, end + SIZE) + (anchor - begin).astype(np.uint64) * np.uint64(_BASE)
    layout = _mix(layout + (end - begin).astype(np.uint64))
    text = np.searchsorted(ends, begin, side="right")
    return text, hashes[anchor].view(np.int64), layout.view(np.int64), anchor, begin, end


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, rows, bytes, ends, offset of each part in its text): whole texts, long ones in parts that overlap."""
    for batch in batches:
        texts = [(text or "").encode("utf-8", "surrogatepass") for text in batch.column("text").to_pylist()]
        rows, parts, offsets, held = [], [], [], 0
        for row, text in enumerate(texts):
            for at in range(0, max(1, len(text) - SIZE + 1), SLICE):
                part = text[at : at + SLICE + SIZE - 1]
                if held + len(part) > SLICE and rows:
                    yield _slice(batch, rows, parts, offsets)
                    rows, parts, offsets, held = [], [], [], 0
                rows.append(row)
                parts.append(part)
                offsets.append(at)
                held += len(part)
        if rows:
            yield _slice(batch, rows, parts, offsets)


def _slice(batch, rows, parts, offsets):
    ends = np.array([len(part) for part in parts], dtype=np.int64).cumsum()
    return batch, np.array(rows), np.frombuffer(b"".join(parts), dtype=np.uint8), ends, np.array(offsets, dtype=np.int64)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows, data, ends, offsets in _slices(batches):
        text, gram, layout, anchor, begin, end = occurrences(data, ends)
        start = np.concatenate(([0], ends[:-1]))
        place = anchor - start[text] + offsets[text] if len(text) else text
        row = pa.array(rows[text] if len(text) else text)
        yield pa.RecordBatch.from_pydict(
            {
                "k1": batch.column("k1").take(row),
                "k2": batch.column("k2").take(row),
                "gram": pa.array(gram),
                "layout": pa.array(layout),
                "place": pa.array(place << 16 | (anchor - begin) << 8 | (end - begin)),
            }
        )


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with two hashes of both, which name the row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(F.lit(1), text, "doc_id").alias("k2"))


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """The occurrences of every anchor hash that is found twice or more; ``same``: all of them are equal."""
    found = texts.select("text", *KEYS).mapInArrow(_anchor_rows, "k1 long, k2 long, gram long, layout long, place long")
    sums = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("layout").alias("least"), F.max("layout").alias("most"))
    repeated = store(sums.filter("n > 1").select("gram", (F.col("least") == F.col("most")).alias("same")), "repeated_anchors")
    return store(found.join(repeated, "gram"), "repeated_occurrences")


# Where an occurrence's windows start and end in its text, from the packed place.
_ANCHOR, _BEFORE, _MORE = "shiftright(place, 16)", "(shiftright(place, 8) & 255)", "(place & 255)"


def _wanted_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted occurrences of each text."""
    for batch in batches:
        out: dict[str, list] = {"gram": [], "layout": [], "before": [], "crowded": [], "bytes": []}
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for one in wanted:
                before, more = one["place"] >> 8 & 255, one["place"] & 255
                begin = (one["place"] >> 16) - before
                row = (one["gram"], one["layout"], before, one["crowded"], data[begin : begin + more + SIZE])
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_pydict({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds, strict=True)})


def shared_windows(groups: np.ndarray, before: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """For each string, the windows that another string of its group holds at the same distance from the anchor.

    ``groups`` is sorted. Strings are laid out with their anchors in one column; columns are written to an external
    file, and a round reads one, from the last to the first. Returns pairs (string, window's start in the string)."""
    count, width = len(strings), 2 * SIZE - GRAM
    lead = REACH - 1 - before.astype(np.int64)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    found: list[np.ndarray] = []
    with tempfile.TemporaryFile() as file:
        layout = np.zeros((count, width), dtype=np.uint8)
        layout[np.repeat(np.arange(count), sizes), _spread(lead, sizes)] = np.frombuffer(b"".join(strings), dtype=np.uint8)
        file.write(np.ascontiguousarray(layout.T))
        del layout
        # A group's strings stay together in the order; ``common[i]`` is the prefix shared by places i - 1 and i.
        order, common = np.arange(count), np.zeros(count, dtype=np.int32)
        rank = np.concatenate(([0], (groups[1:] != groups[:-1]).cumsum())) * 257
        for column in range(width - 1, -1, -1):
            file.seek(column * count)
            symbols = np.frombuffer(file.read(count), dtype=np.uint8)[order].astype(np.int64)
            outside = (column < lead[order]) | (column >= (lead + sizes)[order])
            symbols[outside] = 256
            key = rank + symbols
            moved = np.argsort(key, kind="stable")
            key, outside = key[moved], outside[moved]
            equal = np.concatenate(([False], (key[1:] == key[:-1]) & ~outside[1:]))
            at = np.flatnonzero(equal)
            fresh = np.zeros(count, dtype=np.int32)
            if len(at):
                begin, span = moved[at - 1] + 1, moved[at] - moved[at - 1]
                fresh[at] = 1 + np.minimum.reduceat(common[_spread(begin, span)], np.concatenate(([0], span.cumsum()[:-1])))
            order, common = order[moved], fresh
            if column <= width - SIZE:
                shared = common >= SIZE
                shared[:-1] |= shared[1:]
                if shared.any():
                    found.append(np.stack((order[shared], column - lead[order[shared]]), axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)


def _runs(strings: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first, last) of runs of consecutive windows."""
    order = np.lexsort((windows, strings))
    strings, windows = strings[order], windows[order]
    new = np.concatenate(([True], (strings[1:] != strings[:-1]) | (windows[1:] != windows[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(strings)) - 1
    return strings[first], windows[first], windows[last]


def _transform_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of shared windows of the strings, which come sorted by anchor hash."""

    def settled(table: pa.Table) -> pa.RecordBatch:
        gram = table.column("gram").to_numpy()
        found = shared_windows(gram, table.column("before").to_numpy(), table.column("bytes").to_pylist())
        layout = table.column("layout").to_numpy()
        if not len(found):
            gram, layout, found = gram[:0], layout[:0], found[:0]
            first = last = np.zeros(0, dtype=np.int64)
        else:
            string, first, last = _runs(found[:, 0], found[:, 1])
            gram, layout = gram[string], layout[string]
        names = ("gram", "layout", "first", "last")
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(layout), pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=names)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(part.num_rows for part in held) < COLLECTION:
            continue
        table = pa.Table.from_batches(held)
        gram = table.column("gram").to_numpy()
        change = np.flatnonzero(gram[1:] != gram[:-1])
        if len(change):
            last = int(change[-1]) + 1
            yield settled(table.slice(0, last))
            held = table.slice(last).to_batches()
    if held:
        yield settled(pa.Table.from_batches(held))


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, layout, window, offset from the anchor, two hashes) of every window of the strings."""
    for batch in batches:
        for row in batch.to_pylist():
            data = np.frombuffer(row["bytes"], dtype=np.uint8)
            window = np.arange(len(data) - SIZE + 1)
            size = len(window)
            plain, turned = Rolling(data), Rolling(data[::-1])
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array(np.full(size, row["gram"])),
                    "layout": pa.array(np.full(size, row["layout"])),
                    "first": pa.array(window, pa.int32()),
                    "offset": pa.array(window - row["before"], pa.int32()),
                    "h1": pa.array(plain.between(window, window + SIZE).view(np.int64)),
                    "h2": pa.array(turned.between(len(data) - window - SIZE, len(data) - window).view(np.int64)),
                }
            )


def _crowd_runs(strings: DataFrame) -> DataFrame:
    """Shared windows of the strings of crowded anchors, by counts of window hashes."""
    schema = "gram long, layout long, first int, offset int, h1 long, h2 long"
    windows = strings.filter("crowded").select("gram", "layout", "before", "bytes").mapInArrow(_window_hashes, schema)
    same = ["gram", "offset", "h1", "h2"]
    twice = windows.groupBy(*same).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return windows.join(twice, same).select("gram", "layout", "first", F.col("first").alias("last"))


def shared_runs(texts: DataFrame, doubtful: DataFrame, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Windows (gram, layout, first, last) that distinct strings share, one occurrence standing for each string; and the
    occurrences of strings found twice, which repeat from end to end."""
    name = F.expr("xxhash64(k1, k2, place)")
    kinds = store(doubtful.groupBy("gram", "layout").agg(F.count("*").alias("n"), F.min(name).alias("name")), "distinct_strings")
    sizes = kinds.groupBy("gram").agg((F.count("*") > crowd).alias("crowded"))
    chosen = kinds.select("gram", "layout", "name").join(sizes, "gram")
    rows = doubtful.withColumn("name", name).join(chosen, ["gram", "layout", "name"])
    wanted = rows.groupBy(*KEYS).agg(F.collect_list(F.struct("gram", "layout", "place", "crowded")).alias("wanted"))
    strings = texts.join(wanted, KEYS).select("text", "wanted").mapInArrow(
        _wanted_strings, "gram long, layout long, before int, crowded boolean, bytes binary"
    )
    strings = store(strings, "strings")
    plain = strings.filter("not crowded").drop("crowded").repartition("gram").sortWithinPartitions("gram")
    runs = plain.mapInArrow(_transform_rows, "gram long, layout long, first int, last int").unionByName(_crowd_runs(strings))
    doubled = doubtful.join(kinds.filter("n > 1").select("gram", "layout"), ["gram", "layout"], "left_semi")
    return runs, doubled


def repeated_ranges(texts: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(k1, k2, first, last): starts of windows in each text that also start elsewhere, as ranges."""
    found = repeated_anchors(texts)
    doubtful = found.filter(~F.col("same"))
    runs, doubled = shared_runs(texts, doubtful, crowd)
    begin = F.expr(f"{_ANCHOR} - {_BEFORE}")
    whole = found.filter("same").select(*KEYS, "place").unionByName(doubled.select(*KEYS, "place"))
    whole = whole.select(*KEYS, begin.alias("first"), F.expr(f"{_ANCHOR} - {_BEFORE} + {_MORE}").alias("last"))
    part = doubtful.join(runs, ["gram", "layout"]).select(*KEYS, (begin + F.col("first")).alias("first"), (begin + F.col("last")).alias("last"))
    return whole.unionByName(part)


def covered(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows."""
    runs: list[list[int]] = []
    for first, last in sorted(ranges):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + SIZE)
        else:
            runs.append([first, last + SIZE])
    return [(begin, end) for begin, end in runs]


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            runs = covered([(r["first"], r["last"]) for r in ranges or ()])
            digest, free = hashlib.sha256(), 0
            for begin, end in runs:
                digest.update(data[free:begin])
                free = end
            digest.update(data[free:])
            rows.append((len(data), sum(end - begin for begin, end in runs), len(runs), digest.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *arrays], names=names)


def _removed_from(texts: DataFrame, crowd: int) -> DataFrame:
    """Each text with the ranges of its repeated windows."""
    ranges = repeated_ranges(texts, crowd).distinct()
    each = ranges.groupBy(*KEYS).agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    return texts.join(each, KEYS, "left")


def without_repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Per document: bytes, bytes removed, removed runs and the digest of what is left."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _removed_from(keyed(docs), crowd).select("doc_id", "text", "ranges").mapInArrow(_kept_rows, schema)


def kept_text(text: Column, ranges: Column) -> Column:
    """The text without its repeated bytes; characters cut in part are dropped."""
    def keep(texts: pd.Series, found: pd.Series) -> pd.Series:
        result = []
        for one, own in zip(texts, found, strict=True):
            data, free, parts = one.encode("utf-8", "surrogatepass"), 0, []
            for begin, end in covered([(r["first"], r["last"]) for r in own] if own is not None else []):
                parts.append(data[free:begin])
                free = end
            result.append(b"".join([*parts, data[free:]]).decode("utf-8", "ignore"))
        return pd.Series(result, dtype=object)

    return F.pandas_udf(keep, "string")(text, ranges)


def remove_repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, text) with the repeated bytes removed."""
    return _removed_from(keyed(docs), crowd).select("doc_id", kept_text(F.col("text"), F.col("ranges")).alias("text"))
