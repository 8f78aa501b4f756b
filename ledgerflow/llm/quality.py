"""Quality rules as a short-circuit cascade.

Each rule is a small function of the text that says whether to reject it. Cost and share of rejected documents of every
rule are measured on a sample; the rules then run in the order of rejection per cost, and a text that one rule rejects
is not shown to the later ones. The order changes the time only: a text is kept where no rule rejects it.

Edge cases: a null text counts as empty; a text without words fails the base rule on 50 words. Repeated rows get the same
result each. An empty table gives an empty result. Other columns are passed on as they are."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD, bound_batches, packed

LETTER = re.compile(r"[^\W\d_]")
LINE_SPACE = " \t\n\x0b\x0c\r"

MINIMUM_WORDS = 50
REPEATED_SHARE = 50
#: Thresholds of the cascade's own rules.
SYMBOLS_PER_WORD = 0.2
SHOUTED_SHARE = 0.5
DUPLICATE_LINE_SHARE = 0.5
LETTERLESS_SHARE = 0.4
WORD_LENGTH = (2.0, 20.0)
SAMPLE_ROWS = 2000


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(LINE_SPACE)]
    return len(lines) - len(set(lines))


def repeated_words(found: list[str]) -> int:
    """Words inside windows of three words that the text holds at least twice, the first one included."""
    if len(found) < 4:
        return 0
    last: dict[tuple[str, str, str], int] = {}
    covered = bytearray(len(found))
    for at, window in enumerate(zip(found, found[1:], found[2:], strict=False)):
        before = last.setdefault(window, at)
        if before != at:
            covered[before : before + 3] = covered[at : at + 3] = b"\1\1\1"
    return sum(covered)


def measure(text: str) -> tuple[int, int, int, int, int]:
    found = WORD.findall(text)
    symbols = sum(map(text.count, "#*$%&|<>"))
    return len(found), sum(map(len, found)), symbols, duplicate_lines(text), repeated_words(found)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MINIMUM_WORDS or 100 * n_repeat_words > REPEATED_SHARE * n_words


def too_few_words(text: str) -> bool:
    return sum(1 for _ in WORD.finditer(text)) < MINIMUM_WORDS


def too_repetitive(text: str) -> bool:
    found = WORD.findall(text)
    return 100 * repeated_words(found) > REPEATED_SHARE * len(found)


def too_many_symbols(text: str) -> bool:
    return sum(map(text.count, "#*$%&|<>")) > SYMBOLS_PER_WORD * sum(1 for _ in WORD.finditer(text))


def shouting(text: str) -> bool:
    found = WORD.findall(text)
    return sum(word.isupper() for word in found) > SHOUTED_SHARE * len(found)


def duplicated_lines(text: str) -> bool:
    lines = sum(1 for line in text.split("\n") if line.strip(LINE_SPACE))
    return duplicate_lines(text) > DUPLICATE_LINE_SHARE * lines


def letterless(text: str) -> bool:
    found = WORD.findall(text)
    return sum(LETTER.search(word) is None for word in found) > LETTERLESS_SHARE * len(found)


def odd_word_length(text: str) -> bool:
    found = WORD.findall(text)
    mean = sum(map(len, found)) / max(1, len(found))
    return bool(found) and not WORD_LENGTH[0] <= mean <= WORD_LENGTH[1]


BASE_RULES: dict[str, Callable[[str], bool]] = {"too_few_words": too_few_words, "too_repetitive": too_repetitive}
RULES: dict[str, Callable[[str], bool]] = {
    "too_many_symbols": too_many_symbols,
    "shouting": shouting,
    "duplicated_lines": duplicated_lines,
    "letterless": letterless,
    "odd_word_length": odd_word_length,
}


def rule_statistics(docs: DataFrame, rules: dict[str, Callable[[str], bool]], sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per rule, over a random sample of about ``sample_rows`` texts: texts seen, rejected, and nanoseconds taken."""
    bound_batches(docs.sparkSession)
    total = docs.count()
    sample = docs.select("text").sample(min(1.0, sample_rows / max(1, total)), seed=7)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, rule in rules.items():
                began = time.perf_counter_ns()
                rejected = sum(rule(text or "") for text in batch["text"])
                rows.append((name, len(batch), rejected, time.perf_counter_ns() - began))
            yield pd.DataFrame(rows, columns=["rule", "seen", "rejected", "cost"])

    parts = sample.mapInPandas(run, "rule string, seen long, rejected long, cost long")
    return parts.groupBy("rule").agg(*[F.sum(name).alias(name) for name in ("seen", "rejected", "cost")])


def rule_order(docs: DataFrame, rules: dict[str, Callable[[str], bool]], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rules by rejected texts per nanosecond, best first; one row per rule comes to the driver."""
    measured = {row["rule"]: row["rejected"] / max(1, row["cost"]) for row in rule_statistics(docs, rules, sample_rows).collect()}
    return sorted(rules, key=lambda name: (-measured.get(name, 0.0), name))


def first_rejection(text: str, order: list[str], rules: dict[str, Callable[[str], bool]]) -> str | None:
    return next((name for name in order if rules[name](text)), None)


def quality_table(docs: DataFrame) -> DataFrame:
    """Every document's measures, the base verdict and the cascade's."""
    order = rule_order(docs, RULES)
    schema = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    )

    @F.pandas_udf(schema)
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            found = measure(text)
            failed = base_failed(found[0], found[4])
            rows.append((*found, failed, not failed and first_rejection(text, order, RULES) is None))
        return pd.DataFrame(rows, columns=[part.split()[0] for part in schema.split(", ")])

    return docs.select("doc_id", judge("text").alias("judged")).select("doc_id", "judged.*")


def quality_sql() -> str:
    """The same table in DuckDB, for unique doc_ids."""
    space = r"[\x20\x09-\x0D]"
    share = lambda count, limit: f"{count} > {limit} * n_words"
    rejected = [
        share("n_symbols", SYMBOLS_PER_WORD),
        share("len(list_filter(found, lambda w: upper(w) = w AND lower(w) <> w))", SHOUTED_SHARE),
        f"n_dup_lines > {DUPLICATE_LINE_SHARE} * n_lines",
        share(r"len(list_filter(found, lambda w: NOT regexp_matches(w, '\p{L}')))", LETTERLESS_SHARE),
        f"n_words > 0 AND NOT word_chars / n_words BETWEEN {WORD_LENGTH[0]} AND {WORD_LENGTH[1]}",
    ]
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    parts AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS found,
        list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
    measures AS (SELECT doc_id, found, len(found) AS n_words, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM parts),
    windows AS (SELECT doc_id, place, found[place] || ' ' || found[place + 1] || ' ' || found[place + 2] AS term
        FROM (SELECT doc_id, found, unnest(range(1, n_words - 1)) AS place FROM measures)),
    repeats AS (SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, term) > 1),
    covered AS (SELECT doc_id, count(DISTINCT place + step) AS n_repeat_words FROM repeats, range(3) AS steps(step) GROUP BY 1),
    judged AS (SELECT *, n_words < {MINIMUM_WORDS} OR 100 * n_repeat_words > {REPEATED_SHARE} * n_words AS base_failed
        FROM (SELECT measures.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM measures LEFT JOIN covered USING (doc_id)))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND NOT ({" OR ".join(f"({rule})" for rule in rejected)}) AS kept FROM judged"""


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that neither the base rules nor the cascade's own rules reject."""
    rules = BASE_RULES | RULES
    order = rule_order(docs, rules)

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        return pd.Series([first_rejection(text or "", order, rules) is None for text in texts], dtype=bool)

    return packed(docs, F.col("text").alias("_text_")).filter(passes("_text_")).select("_row_.*")
