"""Text clean-up as Column -> Column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import vocabulary as words

# Every character that counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ASCII_SPACES = r"\t-\r\x1c-\x20"
OTHER_SPACES = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER_AFTER_SIGN = r"(?<=[^\p{L} ])(?=\p{L})"
WORD_MARK = "\x01 "
# What a pattern has to replace in text of one byte per character.
UNEVEN_SPACES = ("  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f")


def single_spaced(value: Column, others: str = "") -> Column:
    """Runs of white space (and of the given characters) as one space, none at the ends.

    Most texts have single spaces only, which byte searches find out faster than any pattern. Text of one byte per character
    gets the pattern without the rarer spaces."""
    narrow = F.octet_length(value) == F.length(value)
    uneven = reduce(Column.__or__, [F.contains(value, F.lit(part)) for part in (*UNEVEN_SPACES, *others)])
    plain = F.regexp_replace(value, f"[{ASCII_SPACES}{others}]+", " ")
    full = F.regexp_replace(value, f"[{ASCII_SPACES}{OTHER_SPACES}{others}]+", " ")
    return F.trim(F.when(narrow & ~uneven, value).when(narrow, plain).otherwise(full))


def clean_text(value: Column) -> Column:
    """Single spaces, no outer blanks; a blank text becomes null."""
    return F.nullif(single_spaced(value), F.lit(""))


def strip(value: Column) -> Column:
    """Text without outer white space, by character set rather than by pattern; text between two printable ASCII
    characters stays as it is."""
    tight = F.ascii(value).between(33, 126) & F.ascii(F.substring(value, -1, 1)).between(33, 126)
    return F.when(tight, value).otherwise(F.btrim(value, F.lit(WHITESPACE)))


def title_clean(value: Column) -> Column:
    """Cleaned text with a capital after every non-letter.

    ``initcap`` only looks at spaces, so it gets a marked space before each letter after another sign."""
    marked = F.regexp_replace(F.lower(clean_text(value)), LETTER_AFTER_SIGN, WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(WORD_MARK), F.lit(""))


def upper_clean(value: Column) -> Column:
    """Cleaned text in capitals: ids, states, currencies."""
    return F.upper(clean_text(value))


def literal_map(entries: Mapping[str, str]) -> Column:
    cells = ", ".join("'" + item.replace("'", "\\'") + "'" for pair in entries.items() for item in pair)
    return F.expr(f"map({cells})")


def canonical(value: Column, spellings: Mapping[str, str]) -> Column:
    """Canonical name of a known spelling, else the cleaned text in title case.

    Underscores and hyphens count as spaces in a spelling."""
    spelling = single_spaced(F.lower(value), "_-")
    return F.coalesce(F.element_at(literal_map(spellings), spelling), title_clean(value))


def normalize_category(value: Column) -> Column:
    return canonical(value, words.CATEGORY_SPELLINGS)


def normalize_status(value: Column) -> Column:
    return canonical(value, words.STATUS_SPELLINGS)


def normalize_channel(value: Column) -> Column:
    return canonical(value, words.CHANNEL_SPELLINGS)


def normalize_account_type(value: Column) -> Column:
    return canonical(value, words.ACCOUNT_TYPE_SPELLINGS)


def normalize_transaction_type(value: Column) -> Column:
    return canonical(value, words.TRANSACTION_TYPE_SPELLINGS)


def normalize_currency(value: Column) -> Column:
    return upper_clean(value)


def region_of_state(state: Column) -> Column:
    return F.coalesce(F.element_at(literal_map(words.REGION_OF_STATE), state), F.lit("Unknown"))


def location_business_key(city: Column, state: Column) -> Column:
    """``city|state``; a missing part is written as the text ``None``."""
    return F.concat_ws("|", F.coalesce(city, F.lit("None")), F.coalesce(state, F.lit("None")))


def numbered_id(prefix: str, number: Column) -> Column:
    return F.format_string(prefix + "%07d", number)


def fired_names(rules: Sequence[str]) -> Column:
    """Names of the true boolean columns, in the given order."""
    return F.concat_ws(", ", *[F.when(F.col(rule), F.lit(rule)) for rule in rules])


def pretty_label(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def currency_label(value: Column) -> Column:
    """``$1,234``, or ``$-1,234`` below zero."""
    return F.concat(F.lit("$"), F.format_number(F.bround(value.cast("decimal(38,6)"), 0), 0))


def percent_label(value: Column) -> Column:
    return F.format_string("%.1f%%", value * 100)


def standard_name(name: str) -> str:
    """Lower snake case of a column heading."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def standardize_column_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[standard_name(name) for name in frame.columns])
