"""Personal data by bootstrapped contextual extraction.

Four fixed patterns give the base spans; they are the seeds. One and two words to the left, to the right, and one on both
sides of a seed are its lexical patterns. Every other token that looks like an identifier (it has a digit or an at sign) is
an instance of the patterns around it; for a pattern of one word, so is any other word there, without trust. Over
the graph of distinct patterns and instances Spark scores in rounds: a pattern by the share of its instances that are
trusted, an instance by the mean of its patterns. Patterns of high confidence with enough seeds add the tokens they
introduce as spans of kind ``id``, and these are seeds of the next round, until no pattern is added. Base spans always stay;
an added span never overlaps one.

A one-word pattern with so many other words in its place that it can never be of high confidence has score 0. That is found
first from the words of one hash in 64, whose count is a lower bound; so common words fall out at once, and all words are
counted only beside the patterns that are left. Patterns and instances are known by 128-bit hashes.

Edge cases: a null text counts as empty and has no spans. Repeated rows get the same spans each; the graph counts
distinct pairs only, so copies add no confidence. An empty table gives an empty result. Very long texts are searched
whole, in time linear in their length, also where they are one word or one run of digits. Other columns are passed on as they are."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import ROW, WORD, bound_batches, numbered, span_text, store
from ledgerflow.llm.tokens import bounded

KINDS = ("email", "ip", "card", "phone", "id")
ID = len(KINDS) - 1

# The base patterns. A run of digits that begins no address begins none further on, so only its start is tried.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile("[0-9@]")
_WHITE = re.compile(r"[\x20\x09-\x0D]")
_EDGE = ".,;:!?\"'()[]{}<>"

ROUNDS = 3
MINIMUM_SEEDS = 5
CONFIDENCE = 0.6
#: One word in so many is counted beside the one-word patterns that are left, step by step.
SHARES = (64, 1)
#: Bits of the filter of patterns that tasks get; more patterns pass more pairs, never too few.
_FILTER_BITS = 1 << 24
_SAME_DIGIT = str.maketrans("123456789", "0" * 9)


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from the at sign outwards so that time stays linear."""
    found, free = [], 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            found.append((start, match.end()))
            free = match.end()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the four kinds; matches that fail their check are dropped, not retried."""
    spans = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    if _DIGIT.search(text) is None:
        return sorted(spans)
    for match in _IP.finditer(text):
        if all(int(part.lstrip("0")[:4] or "0") <= 255 for part in match.group().split(".")):
            spans.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", match.group())
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, match.group())) <= 15:
                spans.append((match.start(), 3, match.end()))
    return sorted(spans)


def _plain(word: str) -> str:
    """A word of a context: lower case, without edge punctuation, all digits alike."""
    return word.strip(_EDGE).lower().translate(_SAME_DIGIT) or word


def _digest(said: str) -> bytes:
    return xxhash.xxh3_128_digest(said.encode("utf-8", "surrogatepass"))


def pattern_id(kind: bytes, *words: bytes) -> bytes:
    """A pattern by its kind (words to the left, to the right, on both sides) and the hashes of its plain words."""
    return xxhash.xxh3_128_digest(kind + b"".join(words))


class Surroundings:
    """The words of a text and its base spans, to find the patterns around a place.

    A word that the place cuts counts with the part outside, up to the next base span, if that is more than punctuation. A word
    is hashed once, however many places it stands beside."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]):
        self.text = text
        self.words = [match.span() for match in WORD.finditer(text)]
        self.begins = [start for start, _ in self.words]
        self.starts, self.ends = sorted(start for start, _, _ in spans), sorted(end for _, _, end in spans)
        self.hashes: dict[int, bytes] = {}

    def _word(self, at: int) -> bytes:
        if at not in self.hashes:
            self.hashes[at] = _digest(_plain(self.text[slice(*self.words[at])]))
        return self.hashes[at]

    def _part(self, start: int, end: int) -> list[bytes]:
        piece = self.text[start:end]
        return [_digest(_plain(piece))] if piece.strip(_EDGE) else []

    def left(self, start: int) -> list[bytes]:
        """Up to two words before a place, nearest first."""
        at, found = bisect_left(self.begins, start) - 1, []
        if at >= 0 and self.words[at][1] > start:
            before = bisect_right(self.ends, start)
            found = self._part(max(self.words[at][0], self.ends[before - 1] if before else 0), start)
            at -= 1
        return (found + [self._word(place) for place in range(at, max(-1, at - 2), -1)])[:2]

    def right(self, end: int) -> list[bytes]:
        """Up to two words after a place, nearest first."""
        at, found = bisect_left(self.begins, end), []
        if at and self.words[at - 1][1] > end:
            after = bisect_left(self.starts, end)
            found = self._part(end, min(self.words[at - 1][1], self.starts[after] if after < len(self.starts) else len(self.text)))
        return (found + [self._word(place) for place in range(at, min(len(self.words), at + 2))])[:2]

    def patterns(self, start: int, end: int) -> list[tuple[bytes, bool]]:
        """(pattern, has one word): one and two words to the left, to the right, and one on both sides."""
        left, right = self.left(start), self.right(end)
        found = [(pattern_id(b"1<", left[0]), True)] if left else []
        found += [(pattern_id(b"1>", right[0]), True)] if right else []
        found += [(pattern_id(b"2<", left[1], left[0]), False)] if len(left) == 2 else []
        found += [(pattern_id(b"2>", *right), False)] if len(right) == 2 else []
        return found + ([(pattern_id(b"<>", left[0], right[0]), False)] if left and right else [])


def _marked_words(text: str) -> Iterator[tuple[int, int]]:
    """Places of the words with a digit or an at sign."""
    free = 0
    while mark := _MARK.search(text, free):
        start = 1 + max(text.rfind(space, free, mark.start()) for space in " \t\n\v\f\r")
        stop = _WHITE.search(text, mark.end())
        yield max(start, free), stop.start() if stop else len(text)
        free = stop.end() if stop else len(text)


def instances(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, list[tuple[bytes, bool]], str, bool]]:
    """(start, end, patterns, instance, is seed) of the seeds and of the tokens that look like identifiers."""
    places = [(start, end, True) for start, _, end in spans]
    ahead = 0
    for begin, stop in _marked_words(text):
        token = text[begin:stop]
        start, end = begin + len(token) - len(token.lstrip(_EDGE)), stop - len(token) + len(token.rstrip(_EDGE))
        while ahead < len(spans) and spans[ahead][2] <= start:
            ahead += 1
        near = spans[max(0, ahead - 3) : ahead + 4]
        if end - start >= 4 and not any(s < end and start < e for s, _, e in near):
            places.append((start, end, False))
    if not places:
        return []
    around = Surroundings(text, spans)
    found = [(start, end, around.patterns(start, end), text[start:end], seed) for start, end, seed in places]
    return [part for part in found if part[2]]


_FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<start:long,kind:int,end:long>>,"
    " candidates array<struct<start:long,end:long,patterns:array<struct<pattern:binary,one_word:boolean>>,instance:binary,seed:boolean>>"
)


def _find(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        text = text or ""
        spans = base_spans(text)
        said = ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
        counts = [sum(kind == wanted for _, kind, _ in spans) for wanted in range(4)]
        base = [{"start": start, "kind": kind, "end": end} for start, kind, end in spans]
        more = []
        for start, end, patterns, instance, seed in instances(text, spans):
            hashed = [{"pattern": pattern, "one_word": one_word} for pattern, one_word in patterns]
            more.append({"start": start, "end": end, "patterns": hashed, "instance": _digest(instance), "seed": seed})
        rows.append((*counts, hashlib.sha256(said.encode()).hexdigest(), base, more))
    columns = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "candidates"]
    return pd.DataFrame(rows, columns=columns)


def find_base(text: Column) -> Column:
    """Counts, digest and base spans of a text, and the candidates of the method, as one struct."""
    return F.pandas_udf(_find, _FOUND)(text)


def _filter_of(patterns: DataFrame) -> np.ndarray:
    """One bit for each pattern, at a place given by its hash; the size is fixed."""
    place = F.conv(F.substring(F.hex("pattern"), 1, 6), 16, 10).cast("long") % _FILTER_BITS + 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    result = np.zeros((_FILTER_BITS >> 15, 4096), dtype=np.uint8)
    for row in patterns.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits")).collect():  # 512 rows at most
        result[row["bucket"] - 1] = np.frombuffer(row["bits"], dtype=np.uint8)
    return result.ravel()


def _filter_places(digests: np.ndarray) -> np.ndarray:
    """The bits of 16-byte hashes."""
    first = digests.reshape(-1, 16)[:, :3].astype(np.int64)
    return ((first[:, 0] << 16 | first[:, 1] << 8 | first[:, 2]) % _FILTER_BITS).astype(np.int64)


def _neighbours(share: int, bits: np.ndarray):
    """(pattern, word): one-word patterns that pass the filter with the other words in their place, distinct in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            split = pc.ascii_split_whitespace(batch.column("text").cast(pa.large_string()).fill_null(""))
            coded = split.flatten().dictionary_encode()
            text = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
            said = coded.dictionary.to_pylist()
            plain = [_digest(_plain(word)) for word in said]
            hashes = np.frombuffer(b"".join(plain), dtype="<u8")[::2]
            other = np.fromiter((_MARK.search(word) is None for word in said), dtype=bool, count=len(said))
            counted = other & (hashes % np.uint64(share) == 0)
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            real = np.fromiter(map(len, said), dtype=np.int64, count=len(said))[code] > 0
            code, text = code[real], text[real]
            together = text[1:] == text[:-1]
            for mark, context, word in ((b"1<", code[:-1], code[1:]), (b"1>", code[1:], code[:-1])):
                digests = np.frombuffer(b"".join([pattern_id(mark, one) for one in plain]), dtype=np.uint8)
                at = _filter_places(digests)
                wanted = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                chosen = np.flatnonzero(together & wanted[context] & counted[word])
                pair = np.unique(context[chosen] * len(said) + word[chosen])
                names = digests.reshape(-1, 16)[pair // max(1, len(said))]
                columns = {
                    "pattern": pa.array([name.tobytes() for name in names], pa.binary()),
                    "word": pa.array(hashes[pair % max(1, len(said))].astype(np.uint64).view(np.int64), pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def beside(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, others) from stored one-word ``patterns`` (pattern, n instances): how many distinct words that are no
    identifiers stand in the place of each; null where they are too many for high confidence.

    A common word stands before a few identifiers and very many other words; without these it would look like a sure sign."""
    bound_batches(docs.sparkSession)
    lost = patterns.select("pattern", F.lit(None).cast("long").alias("others")).limit(0)
    left = patterns
    for share in SHARES:
        if left.isEmpty():
            break
        pairs = docs.select("text").mapInArrow(_neighbours(share, _filter_of(left)), "pattern binary, word long").distinct()
        counts = pairs.groupBy("pattern").agg(F.count("*").alias("others"))
        seen = store(left.drop("others").join(counts, "pattern", "left").withColumn("others", F.coalesce("others", F.lit(0))), f"beside_{share}")
        many = F.col("n") < CONFIDENCE * (F.col("n") + F.col("others"))
        lost = lost.unionByName(seen.filter(many).select("pattern", F.lit(None).cast("long").alias("others")))
        left = seen.filter(~many)
    known = left.select("pattern", "others") if "others" in left.columns else lost.limit(0)
    return lost.unionByName(known)


def score_patterns(edges: DataFrame, others: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, score, seeds, good) from stored distinct edges (pattern, instance, seed) and other words per pattern (null:
    too many, score 0).

    An instance starts with trust 1 as a seed and 0 otherwise. Each round, a pattern's score is the mean trust of its
    instances and other words. A pattern of high confidence with enough seeds is good and stays so, and its instances are
    seeds of the next round; any other instance takes the mean score of its patterns. After ``rounds`` rounds, more follow
    until no pattern is added."""
    counted = edges.withColumn("others", F.lit(0))
    if others is not None:
        counted = edges.join(others.withColumn("lost", F.col("others").isNull()), "pattern", "left")
        counted = counted.withColumn("others", F.when(~F.coalesce("lost", F.lit(False)), F.coalesce("others", F.lit(0))))
    trust = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("trust"), F.max("seed").alias("is_seed"))
    before, at, known = -1, 0, None
    while True:
        scores = counted.join(trust, "instance").groupBy("pattern").agg(
            F.coalesce(F.sum("trust") / (F.count("*") + F.max("others")), F.lit(0.0)).alias("score"), F.sum(F.col("is_seed").cast("long")).alias("seeds")
        )
        good = (F.col("score") >= CONFIDENCE) & (F.col("seeds") >= MINIMUM_SEEDS)
        if known is not None:
            scores = scores.join(known.select("pattern", F.lit(True).alias("was")), "pattern", "left")
            good = good | F.coalesce("was", F.lit(False))
        scores = store(scores.select("pattern", "score", "seeds", good.alias("good")), f"pattern_scores_{at}")
        known = scores.filter("good")
        now, at = known.count(), at + 1
        if at >= rounds and now == before:
            return scores
        before = now
        reached = edges.join(scores, "pattern").groupBy("instance")
        reached = reached.agg(F.max(F.col("seed") | F.col("good")).alias("is_seed"), F.avg("score").alias("mean"))
        trust = reached.select("instance", F.when(F.col("is_seed"), 1.0).otherwise(F.col("mean")).alias("trust"), "is_seed")


def added_spans(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(row number, added array of spans) that patterns of high confidence discover."""
    seen = found.select(ROW, F.explode("candidates").alias("c")).select(ROW, "c.*")
    seen = seen.select("*", F.explode("patterns").alias("p")).select(*[name for name in seen.columns if name != "patterns"], "p.*")
    pairs = seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("one_word").alias("one_word"))
    edges = store(pairs, "pattern_edges")
    enough = edges.filter("one_word").groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= MINIMUM_SEEDS)
    others = store(beside(docs, store(enough, "one_word_patterns")), "pattern_others")
    good = score_patterns(edges, others).filter("good")
    span = F.struct("start", F.lit(ID).alias("kind"), "end")
    return (
        seen.filter(~F.col("seed")).join(good.select("pattern"), "pattern").groupBy(ROW).agg(F.collect_set(span).alias("added"))
    )


def _with_added(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows without other candidates skip the join."""
    open_row = F.exists("candidates", lambda c: ~c["seed"])
    nothing = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    joined = found.filter(open_row).join(added_spans(found, docs), ROW, "left")
    joined = joined.withColumn("added", F.coalesce("added", nothing))
    return joined.unionByName(found.filter(~open_row).withColumn("added", nothing))


def _all_spans() -> Column:
    return F.array_sort(F.concat("base", "added"))


def personal_data(docs: DataFrame) -> DataFrame:
    found = numbered(docs.select("doc_id", find_base(F.col("text")).alias("f")).select("doc_id", "f.*"), "personal_data")
    result = _with_added(found, docs)
    return result.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", span_text(_all_spans(), KINDS).alias("spans")
    )


def _mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts with each run of overlapping spans replaced by the kind of its first span, in brackets."""
    result = []
    for text, found in zip(texts, spans, strict=True):
        parts, free = [], 0
        for span in found if text else ():
            if span["start"] >= free:
                parts += [text[free : span["start"]], f"[{KINDS[span['kind']].upper()}]"]
            free = max(free, span["end"])
        result.append("".join(parts) + text[free:] if parts else text)
    return pd.Series(result, dtype=object)


def masked(text: Column, spans: Column) -> Column:
    return F.pandas_udf(_mask, "string")(text, spans)


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """The documents with all spans masked; ``n_chars``, where there, is the new length."""
    columns = docs.columns
    row = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("_row_")
    found = numbered(docs.select(row, find_base(F.col("text")).alias("f")).select("_row_", "f.base", "f.candidates"), "masking")
    result = _with_added(found, docs).select("_row_", masked(F.col("_row_.text"), _all_spans()).alias("_text_"))
    new = {"text": F.col("_text_"), "n_chars": F.char_length("_text_").cast("long")}
    return result.select(*[new.get(name, F.col(f"_row_.`{name}`")).alias(name) for name in columns])
