"""Token counts under a unigram model, with the dynamic program shared over a trie of pre-tokens.

A pre-token is a word with the word mark in front. Its best cut into vocabulary pieces has the highest sum of piece
scores (of equal sums, the fewest pieces). The best score of a prefix depends on the prefix alone, so the distinct
pre-tokens of a batch are walked as a trie in depth-first order: a prefix that many words share is scored once, and a
word's end stores its token count. Counts of a document add up the terminal counts of its words.

The pieces are those of a public vocabulary; piece number r scores -ln(r + 2.7), which follows its rank. A character
that no piece covers takes one token for each UTF-8 byte, at a score below all pieces.

Every task builds its own trie: nothing is shuffled, and its memory is bounded by ``HELD_WORDS``.

Edge cases: a null text counts as empty and has no tokens. Repeated rows are counted each. Long words are scored whole,
in time linear in their length. An empty table gives an empty result. Other columns are not read."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerflow.llm.tokens import bounded

MARK = "▁"
HELD_WORDS = 1_500_000
#: Words longer than this are counted but not remembered.
HELD_LENGTH = 256


def public_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str) -> dict[str, float]:
    """Scores of the pieces of a vocabulary file; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (at for at in range(model.get_piece_size()) if not (model.is_control(at) or model.is_byte(at) or model.is_unknown(at)))
    return {model.id_to_piece(at): -math.log(at + 2.7) for at in plain}


class PrefixTrie:
    """Terminal counts and scores of pre-tokens."""

    def __init__(self, scores: dict[str, float]):
        self.byte_score = min(scores.values()) - 10.0
        # Every ending of a piece, with the piece's score or None: a search to the left stops where no piece goes on.
        self.endings: dict[str, float | None] = {}
        for piece in scores:
            for at in range(1, len(piece)):
                self.endings.setdefault(piece[at:], None)
        self.endings.update(scores)
        self.nodes = 0

    def _step(self, text: str, end: int, best: list[float], count: list[int]) -> tuple[float, int]:
        """The best score of the prefix that ends at ``end``, and its number of tokens."""
        endings, top, tokens = self.endings, -math.inf, 0
        for begin in range(end - 1, -1, -1):
            piece = text[begin:end]
            if piece not in endings:
                break
            score = endings[piece]
            if score is not None:
                score += best[begin]
                if score > top or score == top and count[begin] + 1 < tokens:
                    top, tokens = score, count[begin] + 1
        last = text[end - 1]
        if endings.get(last) is None:
            size = len(last.encode("utf-8", "surrogatepass"))
            score = best[end - 1] + size * self.byte_score
            if score > top:
                top, tokens = score, count[end - 1] + size
        return top, tokens

    def terminals(self, words: list[str]) -> dict[str, tuple[int, float]]:
        """(tokens, score) of each word; sorted order walks the trie, the lists hold the path from its root."""
        found, path, best, count = {}, "", [0.0], [0]
        for word in sorted(words):
            text = MARK + word
            shared, most = 0, min(len(path), len(text))
            while shared < most and path[shared] == text[shared]:
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                score, tokens = self._step(text, end, best, count)
                best.append(score)
                count.append(tokens)
            self.nodes += len(text) - shared
            path = text
            found[word] = (count[-1], best[-1])
        return found


@cache
def _worker_trie(path: str) -> tuple[PrefixTrie, dict[str, tuple[int, float]]]:
    """The trie of a worker, and the terminals it has met."""
    return PrefixTrie(read_pieces(path)), {}


def count_batch(texts: pa.Array, trie: PrefixTrie, held: dict[str, tuple[int, float]]) -> tuple[np.ndarray, ...]:
    """Words, tokens and score of each text."""
    pieces = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    words = pieces.flatten().dictionary_encode()
    distinct = words.dictionary.to_pylist()
    if len(held) > HELD_WORDS:
        held.clear()
    new = trie.terminals([word for word in distinct if word and word not in held])
    values = [(0, 0.0) if not word else new.get(word) or held[word] for word in distinct]
    held.update((word, value) for word, value in new.items() if len(word) <= HELD_LENGTH)
    at = words.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(texts)), np.diff(pieces.offsets.to_numpy()))
    each = np.array(values, dtype=np.float64).reshape(-1, 2)[at]
    full = np.array([bool(word) for word in distinct], dtype=bool)[at]
    size = len(texts)
    sums = [np.bincount(row, weights=column, minlength=size) for column in (full, each[:, 0], each[:, 1])]
    return sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2]


def _count_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            words, tokens, score = count_batch(batch.column("text"), *_worker_trie(path))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id").cast(pa.int64()), "n_words": words, "n_tokens": tokens, "score": score}
            )

    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens, score) of every document."""
    rows = docs.select("doc_id", "text").mapInArrow(
        _count_rows(vocabulary or public_pieces()), "doc_id long, n_words long, n_tokens long, score double"
    )
    return rows
