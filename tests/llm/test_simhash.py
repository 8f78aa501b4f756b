"""Fingerprints, near duplicates and searches against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash

from ledgerflow.llm import components, fingerprint, neardup


def brute(text, size, lower):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    terms = [" ".join(words[at : at + size]) for at in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(term, seed=42) for term in terms]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def components_of(prints, radius):
    parent = list(range(len(prints)))

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(at) for at in range(len(prints))]


def test_near_duplicates(given):
    rows = sorted(given.select("doc_id", "text").collect(), key=lambda r: r.doc_id)
    prints = [brute(r.text, 4, ascii_lower) for r in rows]
    groups = components_of(prints, 4)
    expected = sorted((r.doc_id, f"{p:016x}", rows[g].doc_id) for r, p, g in zip(rows, prints, groups, strict=True))
    assert sorted(map(tuple, neardup.near_duplicates(given).collect())) == expected
    kept = neardup.keep_one_of_each(given).collect()
    assert sorted(r.doc_id for r in kept) == sorted({rows[g].doc_id for g in groups})
    assert kept[0].found == "mine"


def test_linked_fingerprints_always_share_a_key():
    random.seed(1)
    for blocks in (1, 5):
        masks = neardup.variant_masks(blocks)
        assert len(masks) == 64 * blocks
        for _ in range(500):
            flips = sum(1 << bit for bit in random.sample(range(64), 4))
            assert any(flips & mask == 0 for mask in masks)


@pytest.mark.parametrize("dense", [2048, 10])
def test_forest_connects_what_links_connect(dense):
    random.seed(2)
    centre = [random.getrandbits(64) for _ in range(6)]
    prints = sorted({c ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 5))) for c in centre for _ in range(60)})
    edges = neardup.forest_edges(np.array(prints, dtype=np.uint64), dense)
    groups = components_of(prints, 4)
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in edges)
    assert len(edges) == len(prints) - len(set(groups))


def test_refined_keys_give_the_same_components(spark):
    random.seed(5)
    prints = {random.getrandbits(64) for _ in range(50)}
    prints |= {p ^ sum(1 << b for b in random.sample(range(64), 4)) for p in prints}
    frame = spark.createDataFrame([(neardup._signed(p),) for p in prints], "fp long")
    found = [sorted(map(tuple, components.component_of(neardup.links(frame, blocks)).collect())) for blocks in (1, 5)]
    assert found[0] == found[1] and len(found[0]) >= 100


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(at, at + 1) for at in range(300)] + [(1000, 1002), (1001, 1002)], "u long, v long")
    found = dict(map(tuple, components.component_of(edges).collect()))
    assert found == {at: 0 for at in range(301)} | {at: 1000 for at in range(1000, 1003)}


def test_repeated_rows_and_null_ids(make):
    text = "one two three four five six seven"
    docs = make([(None, text, "en", "a"), (3, text, "en", "a"), (3, text, "en", "a"), (2, "other words only", "en", "a"), (None, "alone", "en", "a")])
    found = sorted((r.doc_id or 0, r.component_id or 0) for r in neardup.near_duplicates(docs).collect())
    assert found == [(0, 0), (0, 3), (2, 2), (3, 3), (3, 3)]
    assert sorted(r.doc_id or 0 for r in neardup.keep_one_of_each(docs).collect()) == [0, 2, 3]


def test_document_fingerprints(given):
    rows = sorted({(r.doc_id, r.text or "") for r in given.collect()}, reverse=True)
    found = {r.doc_id: r for r in fingerprint.document_fingerprints(given).collect()}
    assert len(found) == len(rows)
    assert fingerprint.document_fingerprints(given).count() == given.count()
    prints = [brute(text, 3, str.lower) for _, text in rows]
    for at, (name, text) in enumerate(rows):
        after, half = rows[(at + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row, new = found[name], brute(edited, 3, str.lower)
        near = lambda a, b: max(0.0, math.cos(math.pi * (a ^ b).bit_count() / 64))
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.n_chars, row.fingerprint, row.edited_fingerprint) == (len(text), f"{prints[at]:016x}", f"{new:016x}")
        assert abs(row.near_edited - near(prints[at], new)) < 1e-9
        assert abs(row.near_next - near(prints[at], prints[(at + 1) % len(rows)])) < 1e-9
        if name % 100 == 0:
            assert row.n_near == sum((prints[at] ^ other).bit_count() <= 3 for other in prints)
        else:
            assert row.n_near is None


def test_repeated_rows_get_a_fingerprint_each(make):
    docs = make([(100, "some words in a text", "en", "a")] * 3 + [(7, "some words in a text", "en", "a"), (8, "quite another one here", "en", "a")])
    rows = sorted(map(tuple, fingerprint.document_fingerprints(docs).collect()))
    assert [row[0] for row in rows] == [7, 8, 100, 100, 100]
    assert len({row[1:] for row in rows[2:]}) == 1
    assert [row[7] for row in rows] == [None, None, 4, 4, 4]


def test_block_tables_miss_no_neighbour():
    masks = fingerprint.block_masks()
    assert len(masks) == 20
    for bits in [(a, b, c) for a in range(0, 64, 3) for b in range(1, 64, 3) for c in range(2, 64, 3)]:
        assert any(not mask & sum(1 << b for b in set(bits)) for mask in masks)


def test_empty_table(given):
    empty = given.limit(0)
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.keep_one_of_each(empty).count() == 0
    assert fingerprint.document_fingerprints(empty).count() == 0
