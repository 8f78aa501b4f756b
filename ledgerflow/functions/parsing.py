"""Typed values out of text; anything unreadable becomes null instead of failing the job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import literal_map, strip
from ledgerflow.functions.vocabulary import TRUE_SPELLINGS

#: Amounts as read: 30 digits before the point, 8 after it. Larger numbers are held at the limit, and a number that is not
#: zero never becomes zero: it is one step at least.
AMOUNT = "decimal(38,8)"
AMOUNT_LIMIT = "9" * 30
AMOUNT_STEP = "0.00000001"
#: Amounts of the fact tables, in cents.
MONEY = "decimal(28,2)"

# The months, as English date texts name them or their first letters.
MONTHS = (
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
)
SHORT_MONTHS = {name[:3]: f"{at:02d}" for at, name in enumerate(MONTHS, 1)}

YEAR_FIRST = r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})(\D.*)?$"
COMPACT = r"^(\d{4})(\d{2})(\d{2})(\D.*)?$"
YEAR_LAST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(\D.*)?$"
SHORT_YEAR = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{2})(\D.*)?$"
DAY_THEN_NAME = r"^(\d{1,2})[- ]+([A-Za-z]{3,9})\.?,?[- ]+(\d{4})(\D.*)?$"
NAME_THEN_DAY = r"^([A-Za-z]{3,9})\.?[- ]+(\d{1,2}),?[- ]+(\d{4})(\D.*)?$"
NAME_AND_YEAR = r"^([A-Za-z]{3,9})\.?,?[- ]+(\d{4})$"
# Names of days as date texts begin with them, whole or short.
WEEKDAY = r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?[.,]*[ ]+"
# Frequent spellings that are read by place, without a search for others.
NUMERIC_DATE = r"^\d{2}/\d{2}/\d{4}\z"
SHORT_NAME_DATE = r"^[A-Za-z]{3} \d{2}, \d{4}\z"
TWELVE_HOURS = r"^(.*\d)[ T]+(\d{1,2}):(\d{2})((?::\d{2}(?:\.\d+)?)?) *([AaPp])\.?[Mm]\.?$"


def _amount(text: Column) -> Column:
    """A decimal; a finite number beyond its range takes the limit, so that it still counts as a number, and one between
    zero and the smallest step takes the step, so that it does not count as zero."""
    exact, wide = text.try_cast(AMOUNT), text.try_cast("double")
    limit, step = F.lit(AMOUNT_LIMIT).cast(AMOUNT), F.lit(AMOUNT_STEP).cast(AMOUNT)
    signed = lambda size: F.when(text.startswith("-"), (-size).cast(AMOUNT)).otherwise(size)
    has_value = text.rlike("^[^eE]*[1-9]")
    return (
        F.when((exact == 0) & has_value, signed(step))
        .when(exact.isNotNull(), exact)
        .when(F.abs(wide) < float("inf"), signed(limit))
    )


def _without_marks(value: Column) -> Column:
    """Text without ``$`` and ``,``: two searches cost less than looking at each character."""
    return F.replace(F.replace(value, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))


def parse_currency(value: Column) -> Column:
    """Amounts such as ``$1,234.50``, ``12 USD`` or ``(25.00)`` (negative), with all their places."""
    bare = strip(F.replace(_without_marks(value), F.lit("USD"), F.lit("")))
    bracketed = bare.startswith("(") & bare.endswith(")")
    inner = F.concat(F.lit("-"), F.substring(bare, F.lit(2), F.length(bare) - 2))
    return _amount(F.when(bracketed, inner).otherwise(bare))


def parse_plain_amount(value: Column) -> Column:
    """Amounts with nothing but ``$`` and ``,`` removed, as the raw-total check reads them."""
    return _amount(strip(_without_marks(value)))


def amount_text(amount: Column) -> Column:
    """An amount as text with two places, or more where it has more."""
    plain = F.when(amount == 0, F.lit("0.00")).otherwise(amount.cast("string"))
    return F.regexp_replace(plain, r"(\.\d\d\d*?)0+$", "$1")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; a plain column expression would repeat it at each mention."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _with_day_hours(text: Column) -> Column:
    """Twelve-hour times rewritten to 24 hours; an hour beyond 12 gives null."""
    part = lambda at: F.regexp_extract(text, TWELVE_HOURS, at)
    late = F.when(F.lower(part(5)) == "p", 12).otherwise(0)
    written = lambda hour: F.when(hour.between(1, 12), F.lpad((hour % 12 + late).cast("string"), 2, "0"))
    changed = F.concat(part(1), F.lit(" "), _let(part(2).try_cast("int"), written), F.lit(":"), part(3), part(4))
    return F.when(text.rlike(TWELVE_HOURS), changed).otherwise(text)


def _month(name: Column) -> Column:
    """Two digits of a month by its name or the first letters of it, three at least (also ``sept``)."""
    full = F.filter(F.array(*[F.lit(month) for month in MONTHS]), lambda month: month.startswith(name))
    number = F.array_position(F.array(*[F.lit(month) for month in MONTHS]), F.get(full, F.lit(0)))
    return F.when((F.length(name) >= 3) & (F.size(full) > 0), F.lpad(number.cast("string"), 2, "0"))


def _named(text: Column) -> Column:
    """ISO text of a date with a month's name."""

    def iso(ordered: Column) -> Column:
        part = lambda at: F.regexp_extract(ordered, NAME_THEN_DAY, at)
        month = _let(F.regexp_replace(F.lower(part(1)), "^sept$", "sep"), _month)
        return F.concat(part(3), F.lit("-"), month, F.lit("-"), part(2), part(4))

    return _let(F.regexp_replace(text, DAY_THEN_NAME, "$2 $1, $3$4"), iso)


def _short_year(text: Column, month_day: str) -> Column:
    """ISO text of a date with two digits for the year: the year within fifty years of today."""
    today = F.year(F.current_date())
    near = today - today % 100 + F.regexp_extract(text, SHORT_YEAR, 3).try_cast("int")
    year = lambda y: F.when(y >= today + 50, y - 100).when(y < today - 50, y + 100).otherwise(y)
    return F.concat(_let(near, year).cast("string"), F.regexp_replace(text, SHORT_YEAR, month_day))


def _other_spelling(text: Column, kind: str) -> Column:
    def tried(*spellings: Column) -> Column:
        return F.coalesce(*[one.try_cast(kind) for one in spellings])

    named = F.regexp_replace(text, NAME_AND_YEAR, "$1 1, $2")
    month_first = tried(F.regexp_replace(text, YEAR_LAST, "$3-$1-$2$4"), F.regexp_replace(text, YEAR_LAST, "$3-$2-$1$4"))
    return (
        F.when(text.rlike(YEAR_LAST), month_first)
        .when(text.rlike(SHORT_YEAR), tried(_short_year(text, "-$1-$2$4"), _short_year(text, "-$2-$1$4")))
        .when(text.rlike("[A-Za-z]{3}"), tried(_let(named, _named)))
        .when(text.rlike(COMPACT), tried(F.regexp_replace(text, COMPACT, "$1-$2-$3$4")))
        .otherwise(tried(F.regexp_replace(text, YEAR_FIRST, "$1-$2-$3$4")))
    )


def _short_spelling(text: Column, kind: str) -> Column:
    """``MM/dd/yyyy`` (or day first) and ``MMM dd, yyyy``, read by place as ``_other_spelling`` reads them by pattern; null
    for any other text."""
    part = lambda at, size: F.substring(text, at, size)
    iso = lambda month, day: F.concat(part(-4, 4), F.lit("-"), month, F.lit("-"), day).try_cast(kind)
    month = F.element_at(literal_map(SHORT_MONTHS), F.lower(part(1, 3)))
    return F.when(
        text.rlike(NUMERIC_DATE), F.coalesce(iso(part(1, 2), part(4, 2)), iso(part(4, 2), part(1, 2)))
    ).when(text.rlike(SHORT_NAME_DATE), iso(month, part(5, 2)))


def _parse(value: Column, kind: str) -> Column:
    """ISO text, or one of the other spellings rewritten to it; a day that could be a month is read month first.

    Casting ISO text keeps the session time zone out of the result. The other spellings are only tried on texts that
    have a digit and are not ISO."""
    iso = strip(value)
    other = _let(_with_day_hours(F.regexp_replace(iso, WEEKDAY, "")), lambda text: _other_spelling(text, kind))
    return F.coalesce(
        F.when(~iso.rlike(r"^\d{5}"), iso.try_cast(kind)), _short_spelling(iso, kind), F.when(iso.rlike(r"\d"), other)
    )


def parse_date(value: Column) -> Column:
    return _parse(value, "date")


def parse_timestamp(value: Column) -> Column:
    return _parse(value, "timestamp_ntz")


def parse_bool(value: Column) -> Column:
    return F.coalesce(F.lower(strip(value)).isin(*TRUE_SPELLINGS), F.lit(False))


def parse_integer(value: Column) -> Column:
    """Whole numbers in any spelling of a number (``12.0``, ``1e2``); others become null.

    The decimal shows the places near the point, the double those that the decimal cuts off."""
    text = strip(value)
    number, wide = text.try_cast("decimal(38,8)"), text.try_cast("double")
    return F.when((number == F.floor(number)) & (wide == F.floor(wide)), number.try_cast("bigint"))
