"""Token files and packing against the tokenizer itself."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import grammar, packing, tokens

HARD = "İstanbul ΑΣ ß ŉ 日本 ½² don't <|endoftext|>x a\x1cb 한글 é ́ !!?? … x µª ĲĲ A,B.C"


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.fixture(scope="module")
def plain(given, make):
    docs = given.drop("found").unionByName(make([(-5, HARD, "en", "s")]))
    encode = tokens.encoder(tokens.public_vocabulary()).tokenizer.encode
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: r[0])
    return docs, [(name, [*encode(text or "", add_special_tokens=False).ids, 1]) for name, text in rows]


def test_files_give_back_every_id(plain):
    docs, rows = plain
    found = grammar.token_files(docs).collect()
    starts = [0, *itertools.accumulate(len(ids) for _, ids in rows)]
    expected = sorted((name, start, len(ids), crc(ids)) for (name, ids), start in zip(rows, starts, strict=False))
    assert sorted(map(tuple, found)) == expected


def test_small_shards_and_random_access(plain):
    docs, rows = plain
    shards = grammar.write_shards(docs, shard_tokens=3000).collect()
    assert len(shards) > 20
    by_id = dict(rows)
    for row in shards:
        shard = grammar.Shard(row.payload)
        for at, name in enumerate(row.doc_ids):
            ids = by_id[name]
            assert shard.document(at).tolist() == ids
            assert shard.document(at, 5, 9).tolist() == ids[5:9]
            assert shard.document(at, len(ids) // 2, len(ids) // 2 + 3).tolist() == ids[len(ids) // 2 : len(ids) // 2 + 3]


def test_frequent_pairs_shrink_the_sequence():
    ids = np.array([7, 8, 9, 7, 8, 9, 5, 5, 5, 5] * 500 + [1], dtype=np.uint32)
    pairs, sequence, _, base = grammar.compress(ids, np.array([len(ids)]))
    assert base == 10 and len(pairs) and len(sequence) < len(ids) / 3
    shard = grammar.Shard(grammar.pack(ids, np.array([len(ids)])))
    assert shard.all_ids().tolist() == ids.tolist()


def check_pieces(found, rows):
    by_doc, by_sequence = {}, {}
    for piece in found:
        by_doc.setdefault(piece.doc_id, []).append(piece)
        by_sequence.setdefault(piece.sequence_id, []).append(piece)
    for name, group in itertools.groupby(sorted(rows, key=lambda r: r[0]), key=lambda r: r[0]):
        copies = list(group)
        ids, own = copies[0][1], sorted(by_doc[name], key=lambda p: (p.start, p.sequence_id, p.offset))
        if len(copies) == 1:
            assert [p.start for p in own] == [0, *itertools.accumulate(p.length for p in own)][:-1]
        assert sum(p.length for p in own) == sum(len(copy[1]) for copy in copies)
        for p in own:
            assert (p.doc_tokens, p.ids_crc32) == (len(ids), crc(ids[p.start : p.start + p.length]))
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *itertools.accumulate(p.length for p in own)][:-1]
        assert sum(p.length for p in own) <= packing.LENGTH
    used = [sum(p.length for p in own) for own in by_sequence.values()]
    return 1 - sum(used) / sum(u if u & (u - 1) == 0 else packing.LENGTH for u in used)


def test_each_id_lies_in_one_piece_and_padding_is_small(plain):
    docs, rows = plain
    assert check_pieces(packing.pack_documents(docs).collect(), rows) < 0.02
    check_pieces(packing.pack_documents(docs, block_tokens=500).collect(), rows)


def test_cuts_are_the_best_ones():
    random.seed(3)
    for _ in range(60):
        places = np.array(sorted(random.sample(range(1, 260), 12)) + [260])
        costs = np.array([random.choice([0, 4, 16]) for _ in places])
        costs[-1] = 0
        places = np.union1d(places, np.arange(30, 260, 30))
        costs = np.resize(costs, len(places))
        costs[-1] = 0

        def total(cuts, places=places, costs=costs):
            cost = dict(zip(places.tolist(), costs.tolist(), strict=True))
            sizes = np.diff([0, *cuts])
            if sizes.max() > 100:
                return None
            pad = sum(0 if s >= 64 and s & (s - 1) == 0 else 100 - s for s in sizes.tolist())
            return pad + sum(cost[c] + packing.SEQUENCE for c in cuts)

        best = [0]
        order = [0, *places.tolist()]
        for at in range(1, len(order)):
            options = []
            for before in range(at):
                size = order[at] - order[before]
                if size <= 100:
                    pad = 0 if size >= 64 and size & (size - 1) == 0 else 100 - size
                    options.append(best[before] + pad + int(costs[at - 1]) + packing.SEQUENCE)
            best.append(min(options))
        assert total(packing.best_cuts(places, costs, 100).tolist()) == best[-1]


@pytest.mark.parametrize("ids", [[7] * 100_000, [1, 2, 1, 1, 2] * 5_000, list(range(60_000)) * 20, [0, 1, 2, 2, 1] * 9 + [3]])
def test_rounds_go_on_and_runs_are_halved(ids):
    flat = np.array(ids, dtype=np.uint32)
    ends = np.array(sorted({len(flat) // 3, len(flat) // 2, len(flat)}))
    payload = grammar.pack(flat, ends)
    shard = grammar.Shard(payload)
    assert np.array_equal(shard.all_ids(), flat)
    begins = [0, *ends[:-1].tolist()]
    for at, (begin, end) in enumerate(zip(begins, ends.tolist(), strict=True)):
        assert np.array_equal(shard.document(at), flat[begin:end])
        assert np.array_equal(shard.document(at, 5, 9), flat[begin + 5 : min(begin + 9, end)])
    if len(set(ids)) < 10 and len(ids) > 100:
        assert len(payload) < 500
        assert shard.lengths.max() > 1000
    if len(ids) == 1_200_000:  # more symbols than 16 bits hold
        assert len(shard.pairs) + shard.base > 1 << 16
        assert 3 * len(payload) < 4 * len(ids)  # of four bytes an id


def test_word_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "HELD_BYTES", 2000)
    monkeypatch.setattr(tokens, "PART_BYTES", 20)
    encoder = tokens.Encoder(tokens.public_vocabulary())
    long = " ".join(f"{at}é-" + "ab0" * 900 for at in range(8))
    for text in ("some words, more words.", "entirely other things !! here", long, "some words", long[::-1]):
        ids, ends = encoder.encode(pa.array([text, None]))
        assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1, 1]
        assert ends.tolist() == [len(ids) - 1, len(ids)]
        assert encoder.held < 2000 + 400 * len(text)
    encoder.encode(pa.array(["a"]))
    assert len(encoder.number) <= 3  # the long words are forgotten


def test_empty_table(given):
    empty = given.drop("found").limit(0)
    assert grammar.token_files(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
    one = given.filter(F.col("doc_id") == 900_001).withColumn("start", F.lit(1))
    assert [tuple(r) for r in grammar.token_files(one).collect()] == [(900_001, 0, 1, crc([1]))]
