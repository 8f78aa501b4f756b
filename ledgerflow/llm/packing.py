"""Packing of token ids into sequences of at most 2048, in document order, by dynamic programming.

Documents in ascending order of doc_id form blocks of about a million ids. In a block, windows are cut at document ends,
at sentence ends, or, inside long sentences, at fixed steps. Over all cuts the padding plus the penalties is least: a cut
at a document's end is free, one at a sentence's end costs ``SENTENCE``, one inside a sentence ``TORN``. A sequence is
padded to 2048 unless its length is a power of two. The best earlier cut for a padded window is the least of a sliding
range, kept in a monotone queue, so each cut is entered and left once; the few power-of-two lengths are looked up.

Blocks are packed apart: the last sequence of a block ends at a document's end. ``sequence_id`` is partition * 2^32 plus
a counter.

Edge cases: a null or empty text is the end id alone, a piece of length one. Null doc_ids come first; equal ids are
ordered by their text, and repeated rows are packed each. A text longer than a block makes a block of its own. An empty
table gives no pieces. Other columns are not read."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerflow.llm.tokens import encoded, encoder, in_order, public_vocabulary

LENGTH = 2048
BLOCK_TOKENS = 1 << 20
#: Penalties in padding ids: a sequence at all, a cut at a sentence's end, a cut inside a sentence.
SEQUENCE, SENTENCE, TORN = 1, 4, 16
STEP = 64
#: Shorter sequences are always padded.
LEAST_POWER = 64


def cut_points(ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, and what each costs; the last is the end of the block."""
    total = int(ends[-1])
    cost = np.full(total + 1, -1, dtype=np.int64)
    cost[sentence_ends] = SENTENCE
    cost[ends] = 0
    known = np.concatenate(([0], np.flatnonzero(cost >= 0)))
    gaps = np.diff(known)
    wide = np.flatnonzero(gaps > STEP)
    for begin, gap in zip(known[wide].tolist(), gaps[wide].tolist(), strict=True):
        cost[begin + STEP : begin + gap : STEP] = TORN
    cost[0] = -1
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Ends of the windows with the least padding plus penalties."""
    total = int(places[-1])
    index = np.full(total + 1, -1, dtype=np.int64)
    index[0], index[places] = 0, np.arange(1, len(places) + 1)
    jumps: dict[int, list[int]] = {}
    power = LEAST_POWER
    while power < length:
        source = np.where(places >= power, index[np.maximum(places - power, 0)], -1)
        for at in np.flatnonzero(source >= 0).tolist():
            jumps.setdefault(at + 1, []).append(int(source[at]))
        power *= 2
    at, best, origin = [0, *places.tolist()], [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + place, number), least first
    for number, cost in enumerate(costs.tolist(), 1):
        here = at[number]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        value, source = queue[0]
        value += length - here
        for other in jumps.get(number, ()):
            if best[other] < value:
                value, source = best[other], other
        value += cost + SEQUENCE
        best.append(value)
        origin.append(source)
        value += here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, number))
    cuts, number = [], len(places)
    while number:
        cuts.append(at[number])
        number = origin[number]
    return np.array(cuts[::-1], dtype=np.int64)


FIELDS = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()


def pieces(doc_ids: list, ids: np.ndarray, ends: np.ndarray, sentence: np.ndarray, first: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of a block, and how many sequences it has."""
    cuts = best_cuts(*cut_points(ends, np.flatnonzero(sentence[ids]) + 1))
    stops = np.union1d(cuts, ends)
    begins = np.concatenate(([0], stops[:-1]))
    document, window = np.searchsorted(ends, stops), np.searchsorted(cuts, stops)
    starts, opens = np.concatenate(([0], ends[:-1])), np.concatenate(([0], cuts[:-1]))
    raw = memoryview(ids.astype("<u4").tobytes())
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
    names = pa.array(doc_ids, pa.int64()).take(pa.array(document))
    columns = (begins - starts[document], stops - begins, crc, (ends - starts)[document], window + first, begins - opens[window])
    return pa.RecordBatch.from_arrays([names, *(pa.array(column, pa.int64()) for column in columns)], names=FIELDS), len(cuts)


def _pack_rows(vocabulary: str, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, names, ids, ends, held = TaskContext.get().partitionId() << 32, [], [], [], 0
        sentence = encoder(vocabulary).ends_sentence
        for doc_ids, flat, stops in encoded(batches, vocabulary):
            begin = 0
            while begin < len(doc_ids):
                before = int(stops[begin - 1]) if begin else 0
                end = min(len(doc_ids), int(np.searchsorted(stops, before + block_tokens - held)) + 1)
                names.extend(doc_ids[begin:end])
                ids.append(flat[before : stops[end - 1]])
                ends.append(stops[begin:end] - before + held)
                held += int(stops[end - 1]) - before
                begin = end
                if held >= block_tokens:
                    batch, used = pieces(names, np.concatenate(ids), np.concatenate(ends), sentence, first)
                    yield batch
                    first, names, ids, ends, held = first + used, [], [], [], 0
        if names:
            yield pieces(names, np.concatenate(ids), np.concatenate(ends), sentence, first)[0]

    return run


def pack_documents(docs: DataFrame, vocabulary: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    schema = ", ".join(f"{name} long" for name in FIELDS)
    return in_order(docs).mapInArrow(_pack_rows(vocabulary or public_vocabulary(), block_tokens), schema)
