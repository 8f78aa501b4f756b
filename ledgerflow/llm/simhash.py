"""SimHash fingerprints in DataFrame functions: weighted term hashes vote on the 64 bits of a fingerprint.

The votes for bits j and j + 32 are counted in the two halves of one sum, so a row of 32 sums holds all of them and the
aggregation stays in generated code; a task sends one such row per text.

A term is a run of ``size`` words; a text with fewer words is one term, one without words has fingerprint zero."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
_HALF = 32
_BOTH = (1 << _HALF) | 1


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def term_hashes(words: Column, size: int) -> Column:
    """XXH64 (seed 42) of every run of ``size`` words, joined by a space."""
    count = F.size(words)
    run = lambda at: F.concat_ws(" ", *[F.get(words, at + step) for step in range(size)])
    runs = F.transform(F.sequence(F.lit(0), count - size), lambda at: F.xxhash64(run(at)))
    short = F.array(F.xxhash64(F.concat_ws(" ", words)))
    return F.when(count >= size, runs).when(count > 0, short).otherwise(F.array().cast("array<bigint>"))


def fingerprints(terms: DataFrame, keys: list[str], hashes: str = "hashes") -> DataFrame:
    """One fingerprint per distinct ``keys`` from the array of its term hashes; a term that occurs often votes as often.
    A bit is one where over half the votes set it."""
    voters = terms.select(*keys, F.explode_outer(hashes).alias("_hash_"))
    bits = [F.sum(F.shiftright("_hash_", at).bitwiseAND(F.lit(_BOTH))).alias(f"_votes_{at}_") for at in range(_HALF)]
    votes = voters.groupBy(*keys).agg(F.count("_hash_").alias("_terms_"), *bits)
    total = F.col("_terms_")
    parts = []
    for at in range(_HALF):
        low = F.col(f"_votes_{at}_").bitwiseAND(F.lit((1 << _HALF) - 1))
        high = F.shiftrightunsigned(f"_votes_{at}_", _HALF)
        parts += [F.when(2 * low > total, F.lit(1 << at)).otherwise(F.lit(0).cast("long"))]
        parts += [F.when(2 * high > total, F.lit(_signed(1 << (at + _HALF)))).otherwise(F.lit(0).cast("long"))]
    whole = functools.reduce(operator.add, parts)
    return votes.select(*keys, F.when(total > 0, whole).otherwise(F.lit(0).cast("long")).alias("fingerprint"))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def distance(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))
