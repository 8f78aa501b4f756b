"""Terminal counts against a dynamic program over each word alone."""

import math
import random
import re

import pyarrow as pa

from ledgerflow.llm import trie


def alone(word, scores, floor):
    text = trie.MARK + word
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for end in range(1, len(text) + 1):
        options = [
            (best[at][0] + scores[text[at:end]], best[at][1] + 1) for at in range(max(0, end - 40), end) if text[at:end] in scores
        ]
        if text[end - 1] not in scores:
            size = len(text[end - 1].encode())
            options.append((best[end - 1][0] + floor * size, best[end - 1][1] + size))
        best[end] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1][1], best[-1][0]


def test_same_as_each_word_alone(given):
    scores = trie.read_pieces(trie.public_pieces())
    floor = min(scores.values()) - 10
    seen = {}
    texts = {r.doc_id: r.text or "" for r in given.collect()}
    for row in trie.token_counts(given).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row.doc_id])
        if any(len(word) > 5000 for word in words):
            assert row.n_tokens > 0
            continue
        for word in words:
            if word not in seen:
                seen[word] = alone(word, scores, floor)
        assert (row.n_words, row.n_tokens) == (len(words), sum(seen[w][0] for w in words))
        assert math.isclose(row.score, sum(seen[w][1] for w in words), rel_tol=1e-9, abs_tol=1e-9)


def test_shared_prefixes_are_scored_once():
    random.seed(1)
    words = sorted({"".join(random.choices("ab", k=8)) for _ in range(500)})
    scores = {trie.MARK: -1.0, "a": -2.0, "b": -2.0, "ab": -3.0, "bb": -4.0, trie.MARK + "a": -3.5}
    tree = trie.PrefixTrie(scores)
    found = tree.terminals(words)
    assert found == {word: alone(word, scores, tree.byte_score) for word in words}
    assert tree.nodes == len({word[:at] for word in words for at in range(9)})


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(trie, "HELD_WORDS", 3)
    tree, held = trie.PrefixTrie({trie.MARK: -1.0, "a": -1.0}), {}
    for _ in range(3):
        words, tokens, _ = trie.count_batch(pa.array(["a aa aaa é", None, "", "b b"]), tree, held)
        assert words.tolist() == [4, 0, 0, 2]
        assert tokens.tolist() == [2 + 3 + 4 + 3, 0, 0, 4]
        assert len(held) <= 5


def test_empty_table(given):
    assert trie.token_counts(given.limit(0)).count() == 0
