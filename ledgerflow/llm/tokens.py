"""Token ids of whole texts, and documents in a global order split into partitions.

A text is the sequence of its words, as the tokenizer drops white space and never joins what white space separates. So a
batch is split into words in Arrow, each distinct word is looked up once, and words not met before are encoded together."""

from __future__ import annotations

import itertools
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import BATCH_BYTES, bound_batches

END_ID = 1
#: A worker forgets its words when they take about so many bytes, and encodes words it has not met in parts of so many.
HELD_BYTES = 96 << 20
PART_BYTES = 64 << 10
#: What a held word takes besides its text and four bytes for each id.
_WORD_BYTES = 200

#: Words that are letters and then marks: the tokenizer cuts them there, and lower case changes one letter into one.
_SIMPLE = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<mark>[!-&(-/:-@\[-`{-~]*)$"
_LETTERS = re.compile("[a-zà-öø-ÿ]+")


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts with the end id after each, with a bounded memory of words."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_sentence = np.zeros(len(self.ends_word), dtype=bool)
        for token, at in vocabulary.items():
            self.ends_word[at] = token.endswith("</w>")
            self.ends_sentence[at] = self.ends_word[at] and token[:-4][-1:] in (".", "!", "?")
        self.forget()

    def forget(self) -> None:
        #: Numbers of the words met, without their marks; ids, starts and lengths are by number.
        self.number: dict[str, int] = {}
        self.held = 0
        self.ids, self.starts, self.lengths = array("I"), array("q"), array("q")

    def _hold(self, words: list[str], ids: Sequence[int], ends: np.ndarray) -> None:
        """Holds words whose ids stand one after another and end at ``ends``."""
        first = len(self.starts)
        self.number.update(zip(words, range(first, first + len(words)), strict=True))
        sizes = np.diff(ends, prepend=0).astype(np.int64)
        self.starts.frombytes((ends - sizes + len(self.ids)).astype(np.int64).tobytes())
        self.lengths.frombytes(sizes.tobytes())
        self.ids.extend(ids)
        self.held += _WORD_BYTES * len(words) + sum(map(len, words)) + 4 * len(ids)

    def _encode_plain(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; the tokenizer's own results take many bytes a token, so few of them are made at once."""
        begin = size = 0
        for at, text in enumerate(texts):
            size += len(text)
            if size >= PART_BYTES or at + 1 == len(texts):
                for part in self.tokenizer.encode_batch_fast(texts[begin : at + 1], add_special_tokens=False):
                    yield part.ids
                begin, size = at + 1, 0

    def _learn(self, words: list[str], together: int = 200) -> None:
        """Encodes letters-only words many at a time, as a token that ends a word shows where each one ends, and other
        words one by one."""
        plain, alone = [], []
        letters = _LETTERS.fullmatch
        for word in words:
            (plain if letters(word) else alone).append(word)
        groups = [plain[at : at + together] for at in range(0, len(plain), together)]
        for group, ids in zip(groups, self._encode_plain([" ".join(group) for group in groups]), strict=True):
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(group):
                self._hold(group, ids, ends)
            else:
                alone += group
        for word, ids in zip(alone, self._encode_plain(alone), strict=True):
            self._hold([word], ids, np.array([len(ids)]))

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.number.get, distinct, itertools.repeat(-1)), dtype=np.int64, count=len(distinct))
        if len(new := np.flatnonzero(numbers < 0)):
            words_met = [distinct[at] for at in new.tolist()]
            self._learn(words_met)
            numbers[new] = np.fromiter(map(self.number.__getitem__, words_met), dtype=np.int64, count=len(new))
        return numbers[coded.indices.to_numpy(zero_copy_only=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids end; a null text has the end id only.

        The distinct words of the batch are cut into letters and marks, and their ids put together, before the words of
        the texts are looked up."""
        pieces = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        words = pieces.flatten().dictionary_encode()
        distinct = words.dictionary
        if self.held > HELD_BYTES:
            self.forget()
        cut = pc.extract_regex(distinct, _SIMPLE)
        core = pc.coalesce(pc.utf8_lower(pc.struct_field(cut, "core")), distinct)
        mark = pc.coalesce(pc.struct_field(cut, "mark"), pa.scalar("", pa.large_string()))
        parts = np.stack((self._numbers(core), self._numbers(mark)), axis=1)
        lengths = np.array(self.lengths)
        known = gather(np.frombuffer(self.ids, dtype=np.uint32), np.array(self.starts), lengths, parts.ravel())
        sizes = np.append(lengths[parts].sum(axis=1), 1)
        known = np.append(known, np.uint32(END_ID))
        ends = np.diff(pieces.offsets.to_numpy()).cumsum()
        chosen = np.insert(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends, len(distinct))
        word_ends = sizes[chosen].cumsum()
        return gather(known, sizes.cumsum() - sizes, sizes, chosen), word_ends[ends + np.arange(len(ends))]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen pieces of a flat array, one after another."""
    sizes = lengths[chosen]
    ends = sizes.cumsum()
    return flat[np.repeat(starts[chosen] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and worker."""
    return Encoder(path)


def bounded(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        size = pc.binary_length(batch.column("text").cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False).cumsum()
        begin = 0
        while begin < batch.num_rows:
            before = size[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc ids, ids of all texts, their ends) of bounded slices."""
    for batch in bounded(batches):
        yield (batch.column("doc_id").to_pylist(), *encoder(path).encode(batch.column("text")))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id and text in ascending order over partitions: null ids first, equal ids by a hash of the text."""
    bound_batches(docs.sparkSession)
    order = [F.col("doc_id"), F.xxhash64("text")]
    return docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
