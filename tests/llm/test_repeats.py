"""Removal of repeated strings against a table of all windows."""

import hashlib
import random

import numpy as np
import pytest

from ledgerflow.llm import repeats

SIZE = repeats.SIZE


def brute(texts):
    """Rows (bytes, removed, runs, digest) of each text, in order."""
    data = [(text or "").encode() for text in texts]
    first, twice = {}, set()
    for row, text in enumerate(data):
        for at in range(len(text) - SIZE + 1):
            window = text[at : at + SIZE]
            if first.setdefault(window, (row, at)) != (row, at):
                twice.add(window)
    result = []
    for text in data:
        gone = bytearray(len(text))
        for at in range(len(text) - SIZE + 1):
            if text[at : at + SIZE] in twice:
                gone[at : at + SIZE] = b"\1" * SIZE
        runs = sum(gone[at] and not (at and gone[at - 1]) for at in range(len(gone)))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        result.append((len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return result


def prose(size):
    return "".join(random.choices("abcdefgh éñ.", k=size))


@pytest.fixture(scope="module")
def hard():
    random.seed(11)
    passage, other = prose(700), prose(260)
    texts = [prose(random.randint(0, 900)) for _ in range(40)]
    texts += [prose(random.randint(0, 300)) + passage + prose(random.randint(0, 300)) for _ in range(25)]
    texts += [prose(150) + passage[at : at + 230] + prose(90) for at in range(0, 400, 23)]
    texts += [passage[:300] + other + passage[300:], other + other, prose(20) + other, "é" * 150, "x" * 3000, "xy" * 500, "x" * 199]
    near = list(prose(1500))
    for _ in range(20):
        copy = near[:]
        for _ in range(3):
            copy[random.randrange(len(copy))] = "Z"
        texts.append("".join(copy))
    return [*texts, None, "", texts[0], texts[3], passage, passage]


def rows_of(make, texts, **options):
    found = repeats.without_repeats(make([(at, text, "en", "s") for at, text in enumerate(texts)]), **options).collect()
    assert len(found) == len(texts)
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(found, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("crowd", [repeats.CROWD, 1])
def test_same_as_all_windows(make, hard, crowd):
    assert rows_of(make, hard, crowd=crowd) == brute(hard)


def test_slices_and_small_collections(make, hard, monkeypatch):
    found = brute(hard)
    monkeypatch.setattr(repeats, "COLLECTION", 5)
    strings = [text.encode() for text in hard if text]
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    ends = np.array([len(s) for s in strings]).cumsum()
    text, gram, layout, anchor, begin, end = repeats.occurrences(data, ends)
    starts = np.concatenate(([0], ends[:-1]))
    windows = [(int(t), int(s - starts[t])) for t, a, b in zip(text, begin, end, strict=True) for s in range(a, b + 1)]
    assert windows == [(t, s) for t, one in enumerate(strings) for s in range(len(one) - SIZE + 1)]
    assert all(b <= a <= b + repeats.REACH - 1 and e <= a for a, b, e in zip(anchor, begin, end, strict=True))
    assert rows_of(make, hard) == found


def test_long_texts_are_read_in_overlapping_parts(monkeypatch):
    import pyarrow as pa

    random.seed(4)
    monkeypatch.setattr(repeats, "SLICE", 500)
    text = prose(3000)
    batch = pa.RecordBatch.from_pydict({"text": [text, None, text[:100]], "k1": [1, 2, 3], "k2": [1, 2, 3]})
    rows = [row for part in repeats._anchor_rows([batch]) for row in part.to_pylist()]
    size = len(text.encode())
    runs = [((r["place"] >> 16) - (r["place"] >> 8 & 255), r["place"] & 255) for r in rows]
    windows = sorted(s for begin, more in runs for s in range(begin, begin + more + 1))
    assert windows == list(range(size - SIZE + 1))


def test_given_documents(given):
    docs = given.drop("found").filter("doc_id <> 900004 and doc_id <> 900005")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    expected = sorted((r.doc_id, *out) for r, out in zip(rows, brute([r.text for r in rows]), strict=True))
    assert sorted(map(tuple, repeats.without_repeats(given).filter("doc_id <> 900004 and doc_id <> 900005").collect())) == expected
    long = {r.doc_id: r for r in repeats.without_repeats(given).collect()}
    assert long[900_004].n_removed == 150_000 and long[900_005].n_removed == 100_000
    texts = {r.doc_id: r.text for r in repeats.remove_repeats(given).collect()}
    assert texts[900_004] == "" and texts[900_003] == " \n\t "


def test_empty_table(given):
    assert repeats.without_repeats(given.limit(0)).count() == 0
