"""Line dedup against plain Python; the perfect hash and its arrays on their own."""

import hashlib
import random

import numpy as np
import pytest

from ledgerflow.llm import lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_documents=3):
    order = lambda i: (i is not None, i or 0)
    holders = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(doc_id)
    result = []
    for doc_id, text, *_ in rows:
        parts = (text or "").split("\n")
        keys = [part.strip(SPACE).translate(LOWER) for part in parts]
        kept = [
            part
            for part, key in zip(parts, keys, strict=True)
            if len(holders.get(key, ())) < min_documents or max(holders[key], key=order) == doc_id
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        result.append((order(doc_id), len(parts), len(parts) - len(kept), digest))
    return sorted(result)


def run(docs):
    return sorted(((row[0] is not None, row[0] or 0), *row[1:]) for row in map(tuple, lines.line_dedup(docs).collect()))


LICENSE = "This line stands in very many documents."


@pytest.fixture(scope="module")
def rows():
    pick, result = random.Random(4), []
    pool = [f"shared line number {at} of the pool" for at in range(60)]
    for at in range(300):
        parts = [pick.choice(pool) for _ in range(pick.randrange(6))] + [f"own line of document {at}", "short", ""]
        if at % 3 == 0:
            parts += [f"  {LICENSE.upper()}\t", LICENSE, LICENSE + "\r"]
        pick.shuffle(parts)
        result.append((at * 7 - 400, "\n".join(parts), "en", "s"))
    twenty, nineteen = "é" * 20, "é" * 19
    result += [(5000 + at, f"{twenty}\n{nineteen}\nÀ{twenty}\nà{twenty}", "en", "s") for at in range(3)]
    result += [(6000, "exactly two documents hold this\n", "en", "s"), (6001, "exactly two documents hold this", "en", "s")]
    result += [(6002, "one document in three rows holds this", "en", "s")] * 3
    result += [(None, LICENSE, "en", "s"), (None, LICENSE, "en", "s"), (6003, None, "en", "s"), (6004, "", "en", "s"), (6005, "\n\n", "en", "s")]
    result += [(6006, (LICENSE + "\n") * 40_000, "en", "s"), (6007, "z" * 5_000_000, "en", "s")]
    result += [(-(2**62) - at, "held by documents with very small numbers", "en", "s") for at in range(3)]
    result += [(2**62 + at, "held by documents with very large numbers", "en", "s") for at in range(3)]
    return result


def test_against_plain_python(make, rows):
    expected = brute(rows)
    assert sum(row[2] > 0 for row in expected) > 100
    assert run(make(rows)) == expected


def test_with_many_shards_and_blocks(make, rows, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 7)
    assert run(make(rows).repartition(23)) == brute(rows)


def test_null_ids_only(make):
    rows = [(None, LICENSE, "en", "s"), (1, LICENSE, "en", "s"), (2, LICENSE, "en", "s"), (None, "a\n" + LICENSE, "en", "s")]
    assert run(make(rows)) == brute(rows)


def test_other_columns_stay(given):
    found = lines.without_repeated_lines(given)
    assert found.columns == [*given.columns, "lines"]
    assert found.select(*given.columns).exceptAll(given).count() == 0
    rows = [(row.doc_id, row.text) for row in given.select("doc_id", "text").collect()]
    assert run(given) == brute(rows)


def test_other_limits(make):
    rows = [(at, "abc\nabcd\nabcde", "en", "s") for at in range(2)]
    found = lines.without_repeated_lines(make(rows), min_chars=4, min_documents=2).select("doc_id", "lines.text").collect()
    assert {row.doc_id: row.text for row in found} == {0: "abc", 1: "abc\nabcd\nabcde"}


def test_empty_table(make):
    assert run(make([(1, "x", "en", "s")]).limit(0)) == []


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 40_000])
def test_perfect_hash_is_minimal(count):
    pick = np.random.default_rng(count)
    keys = np.zeros(count, dtype=lines._KEY)
    keys["high"], keys["low"] = pick.integers(0, 1 << 63, (2, count), dtype=np.uint64)
    counts, largest, known = pick.integers(1, 200, count), pick.integers(-(1 << 62), 1 << 62, count), pick.random(count) < 0.5
    shard = lines.Shard.unpacked(lines.Shard.over(keys, counts, largest, known).packed())
    assert sorted(shard.hash.place(keys).tolist()) == list(range(count))
    found = shard.probe(keys)
    assert all(np.array_equal(a, b) for a, b in zip(found, (counts, largest, known), strict=True))


def test_fingerprints_reject_most_other_keys():
    pick = np.random.default_rng(1)
    keys = np.zeros(20_000, dtype=lines._KEY)
    keys["high"], keys["low"] = pick.integers(0, 1 << 63, (2, 20_000), dtype=np.uint64) * np.uint64(2)
    ones = np.ones(10_000, dtype=np.int64)
    shard = lines.Shard.over(keys[:10_000], ones, ones, ones.astype(bool))
    assert int((shard.probe(keys[10_000:])[0] > 0).sum()) <= 1
