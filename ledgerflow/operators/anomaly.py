"""Rule-based review flags, score and priority."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions import numbers, text
from ledgerflow.operators.neighbours import Before, previous_in_groups, previous_in_ranges
from ledgerflow.operators.numbering import number_by_position
from ledgerflow.operators.quantiles import exact_quantiles
from ledgerflow.settings import Settings
from ledgerflow.sources.staging import Staging

GEOGRAPHY_HOURS = 2
BALANCE_ISSUE_AMOUNT = 1000
SPENDING_FLOOR = 500
DECLINES_PER_DAY = 3
UNUSUAL_INTERNATIONAL_PER_CUSTOMER = 2
# Rows of one customer in one slot of this length are ordered by one task, unless they are more than SLOT_ROWS.
SLOT_HOURS = 6
SLOT_ROWS = 1 << 20

REPORTED_COLUMNS = (
    "transaction_id",
    "customer_id",
    "account_id",
    "transaction_date",
    "transaction_amount",
    "transaction_category",
    "transaction_channel",
)


def high_value(threshold: float) -> Column:
    return _certain(F.col("transaction_amount") >= threshold)


def unusual_time(start_hour: int, end_hour: int) -> Column:
    return _certain(F.hour("transaction_timestamp").between(start_hour, end_hour))


def balance_issue(warning: float) -> Column:
    low = F.col("balance_after_transaction") <= warning
    return _certain(low & (F.col("transaction_amount") >= BALANCE_ISSUE_AMOUNT))


def _certain(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def amount_counts(transactions: DataFrame) -> DataFrame:
    """How often each customer has each amount, in cents: all that the spending statistics need of the transactions."""
    cents = numbers.cents(F.col("transaction_amount")).alias("cents")
    return transactions.where("customer_id is not null").groupBy("customer_id", cents).agg(F.count("*").alias("times"))


def customer_spending(counts: DataFrame) -> DataFrame:
    """Rows, and mean, sample deviation (0 for one row) and exact median of each customer's amounts, from ``amount_counts``.

    Sums of cents and of their squares are whole numbers, so the limits do not depend on the order of rows. Sums beyond
    38 digits fall back to doubles. ``counts`` is read several times, so it should be a stored table."""
    known = F.col("cents").isNotNull()
    value, times = F.col("cents").cast("decimal(19,0)"), F.col("times").cast("decimal(19,0)")
    parts = counts.select(
        "customer_id",
        "times",
        F.when(known, F.col("times")).alias("n"),
        F.try_multiply(value, times).alias("part"),
        F.try_multiply((value * value).cast("decimal(38,0)"), times).cast("decimal(38,0)").alias("square"),
        (F.col("cents").cast("double") * F.col("times")).alias("plain_part"),
        (F.col("cents").cast("double") * F.col("cents") * F.col("times")).alias("plain_square"),
    )

    def whole_sum(name: str) -> Column:
        """Null where a part or the sum has more than 38 digits."""
        return F.when(F.count(name) == F.count("n"), F.try_sum(name))

    sums = parts.groupBy("customer_id").agg(
        F.sum("times").alias("customer_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("decimal(19,0)").alias("n"),
        whole_sum("part").alias("total"),
        whole_sum("square").alias("squares"),
        F.sum("plain_part").alias("plain_total"),
        F.sum("plain_square").alias("plain_squares"),
    )
    rows, pairs = F.col("n").cast("double"), (F.col("n") * (F.col("n") - 1)).cast("double")
    # n * squares - total^2, as far as whole numbers hold it
    spread = F.try_subtract(F.try_multiply(F.col("n"), F.col("squares")), F.try_multiply(F.col("total"), F.col("total")))
    plain = F.greatest(rows * F.col("plain_squares") - F.col("plain_total") * F.col("plain_total"), F.lit(0.0))
    deviation = F.sqrt(F.try_divide(F.coalesce(spread.cast("double"), plain), pairs))
    mean = F.try_divide(F.coalesce(F.col("total").cast("double"), F.col("plain_total")), rows)
    moments = sums.select(
        "customer_id",
        "customer_rows",
        (mean / 100).alias("mean_amount"),
        (F.coalesce(deviation, F.lit(0.0)) / 100).alias("amount_deviation"),
    )
    medians = exact_quantiles(counts, ["customer_id"], "cents", {"median_cents": 0.5}, times="times", counted=True)
    median = (F.col("median_cents") / 100).alias("median_amount")
    return moments.join(medians, "customer_id", "left").select(*moments.columns, median)


def spending_limit() -> Column:
    return F.greatest(
        F.col("mean_amount") + 3 * F.col("amount_deviation"),
        F.col("median_amount") * 4,
        F.lit(float(SPENDING_FLOOR)),
    )


def early_international(transactions: DataFrame) -> DataFrame:
    """Per customer, the moment up to which international activity is unusual: its second one.

    ``row_number() <= 2`` is limited before the shuffle, so a heavy customer sends two rows per
    task."""
    moment = F.struct("transaction_timestamp", "source_row_number")
    place = F.row_number().over(
        Window.partitionBy("customer_id").orderBy("transaction_timestamp", "source_row_number")
    )
    return (
        transactions.where("is_international and customer_id is not null")
        .select("customer_id", "transaction_timestamp", "source_row_number")
        .withColumn("place", place)
        .where(F.col("place") <= UNUSUAL_INTERNATIONAL_PER_CUSTOMER)
        .groupBy("customer_id")
        .agg(F.max(moment).alias("last_unusual"))
    )


def is_early_international() -> Column:
    moment = F.struct("transaction_timestamp", "source_row_number")
    return _certain(F.col("is_international") & (moment <= F.col("last_unusual")))


def customer_history(transactions: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row per customer with all that the customer rules compare a transaction with. ``counts`` may hold the
    ``amount_counts`` as a stored table."""
    spending = customer_spending(amount_counts(transactions) if counts is None else counts)
    return spending.join(early_international(transactions), "customer_id", "left")


def with_customer_history(transactions: DataFrame, history: DataFrame) -> DataFrame:
    """Flags that compare a row with its customer's totals. One join serves both: the totals have
    one row per customer, and the skew join splits the transactions of a heavy one."""
    over_limit = _certain(F.col("transaction_amount").cast("double") > spending_limit())
    flagged = transactions.join(history, "customer_id", "left").withColumns(
        {"spending_deviation": over_limit, "unusual_international_activity": is_early_international()}
    )
    return flagged.drop(*[name for name in history.columns if name != "customer_id"])


def with_spending_deviation(transactions: DataFrame) -> DataFrame:
    spending = customer_spending(amount_counts(transactions))
    over_limit = _certain(F.col("transaction_amount").cast("double") > spending_limit())
    flagged = transactions.join(spending, "customer_id", "left").withColumn("spending_deviation", over_limit)
    return flagged.select(*transactions.columns, "spending_deviation")


def with_unusual_international(transactions: DataFrame) -> DataFrame:
    flagged = transactions.join(early_international(transactions), "customer_id", "left")
    return flagged.select(*transactions.columns, is_early_international().alias("unusual_international_activity"))


def _lookback(minutes: int) -> int:
    """Seconds that the rules about the previous row look back."""
    return max(minutes * 60, GEOGRAPHY_HOURS * 3600)


def _slot(lookback_seconds: int) -> tuple[Column, Column]:
    """The time slot of a row, and whether the row lies in the lookback of the next slot."""
    width = max(SLOT_HOURS * 3600, lookback_seconds) * 1_000_000
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, F.col("transaction_timestamp"))
    slot = F.floor(micros / width)
    return slot, micros >= (slot + 1) * width - lookback_seconds * 1_000_000


def in_time_slots(transactions: DataFrame, lookback_seconds: int, columns: Sequence[str]) -> DataFrame:
    """Rows with a time slot, and copies of a slot's last rows carried into the next one.

    A window over (customer, slot) then sees every predecessor within the lookback, while the
    history of a heavy customer is spread over as many tasks as it has slots."""
    slot, near_end = _slot(lookback_seconds)
    copies = F.array_compact(F.array(F.struct(slot.alias("slot"), F.lit(False).alias("carried")),
                                     F.when(near_end, F.struct((slot + 1).alias("slot"), F.lit(True).alias("carried")))))
    return transactions.select(*columns, F.explode(copies).alias("at")).select(*columns, "at.slot", "at.carried")


def crowded_slots(
    transactions: DataFrame, minutes: int, customers: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """(customer_id, slot) with more than ``limit`` rows (``SLOT_ROWS``), counted before the shuffle.

    ``customers`` (a column customer_id) may name the only ones that can have so many; the others are not counted."""
    if customers is not None:
        transactions = transactions.join(customers.select("customer_id"), "customer_id", "left_semi")
    slotted = in_time_slots(transactions.where("customer_id is not null"), _lookback(minutes), ["customer_id", "transaction_timestamp"])
    counts = slotted.groupBy("customer_id", "slot").agg(F.count("*").alias("slot_rows"))
    return counts.where(F.col("slot_rows") > (SLOT_ROWS if limit is None else limit)).select("customer_id", "slot")


# What the rules need to know of the row before.
_SEARCHES = {
    "rapid_repeat_transaction": Before(("merchant_id", "rounded_amount"), {"repeat_timestamp": "transaction_timestamp"}),
    "geographic_inconsistency": Before((), {"last_region": "region", "last_timestamp": "transaction_timestamp"}),
}


def _is_rapid(minutes: int) -> Column:
    gap = numbers.elapsed(F.col("repeat_timestamp"), F.col("transaction_timestamp"), 60)
    known = F.col("customer_id").isNotNull() & F.col("merchant_id").isNotNull()
    return _certain(known & gap.between(0, minutes))


def _is_far_apart() -> Column:
    before = F.col("last_region")
    gap = numbers.elapsed(F.col("last_timestamp"), F.col("transaction_timestamp"), 3600)
    moved = (F.col("region") != before) & (F.col("region") != "Unknown") & (before != "Unknown")
    return _certain(F.col("customer_id").isNotNull() & moved & (gap <= GEOGRAPHY_HOURS))


def with_previous_row_flags(
    transactions: DataFrame,
    minutes: int,
    flags: Sequence[str] = ("rapid_repeat_transaction", "geographic_inconsistency"),
    crowded: DataFrame | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Flags that compare a row with the one before it. Both windows share one shuffle on
    (customer, slot): hashing by part of a window's keys already keeps its rows together.

    ``crowded`` may hold the ``crowded_slots`` as a stored table. The rows of these slots are spread over ranges of time
    instead; their sorted rows are stored. Rows without customer or time have no flag and are spread by their number."""
    derived = transactions.withColumns(
        {
            "rounded_amount": numbers.whole_units(F.col("transaction_amount")),
            "region": text.region_of_state(F.col("state")),
            "slot_owner": F.when(F.col("transaction_timestamp").isNotNull() & F.col("customer_id").isNotNull(), F.col("customer_id")).otherwise(
                F.concat(F.lit("row "), F.col("source_row_number").cast("string"))
            ),
        }
    )
    searches = {name: _SEARCHES[name] for name in flags}
    rules = {"rapid_repeat_transaction": _is_rapid(minutes), "geographic_inconsistency": _is_far_apart()}
    slotted = in_time_slots(derived, _lookback(minutes), derived.columns)
    shared, order = ["slot_owner", "slot"], ["transaction_timestamp", "source_row_number"]
    few, many = slotted, None
    if crowded is not None and not crowded.isEmpty():
        named = crowded.withColumnRenamed("customer_id", "slot_owner")
        few, many = slotted.join(named, shared, "left_anti"), slotted.join(named, shared, "left_semi")
    found = previous_in_groups(few, shared, order, searches)
    if many is not None:
        staging = Staging(transactions.sparkSession) if staging is None else staging
        found = found.unionByName(previous_in_ranges(many, shared, order, searches, staging, "crowded_slot_rows"))
    flagged = found.withColumns({name: rules[name] for name in flags})
    return flagged.where(~F.col("carried")).select(*transactions.columns, *flags)


def busy_decline_days(transactions: DataFrame) -> DataFrame:
    """Customers and days with at least three declines; counts are combined before the shuffle."""
    return (
        transactions.where(F.col("transaction_status") == "Declined")
        .groupBy("customer_id", "transaction_date")
        .agg(F.count("transaction_id").alias("declines"))
        .where(F.col("declines") >= DECLINES_PER_DAY)
    )


def with_repeated_declines(transactions: DataFrame, busy_days: DataFrame | None = None) -> DataFrame:
    """Flags the declined rows of busy days, which are few next to the transactions."""
    busy = busy_decline_days(transactions) if busy_days is None else busy_days
    flagged = transactions.join(busy, ["customer_id", "transaction_date"], "left")
    repeated = _certain((F.col("transaction_status") == "Declined") & F.col("declines").isNotNull())
    return flagged.select(*[F.col(name) for name in transactions.columns], repeated.alias("repeated_declines"))


def anomaly_score(weights: Mapping[str, int], present: Sequence[str]) -> Column:
    """Sum of the weights of fired rules; rules without a column are skipped."""
    score = F.lit(0)
    for rule, weight in weights.items():
        if rule in present:
            score = score + F.when(F.col(rule), F.lit(int(weight))).otherwise(F.lit(0))
    return score


def review_priority(score: Column) -> Column:
    return F.when(score >= 6, "High").when(score >= 3, "Medium").when(score > 0, "Low").otherwise("None")


def flag_transactions(
    transactions: DataFrame,
    settings: Settings,
    history: DataFrame | None = None,
    busy_days: DataFrame | None = None,
    crowded: DataFrame | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Every transaction with its eight rule flags, score, priority and fired rules.

    ``history``, ``busy_days`` and ``crowded`` (slots) may come as stored tables, whose size tells Spark whether the
    transactions have to be shuffled for the joins."""
    history = customer_history(transactions) if history is None else history
    busy_days = busy_decline_days(transactions) if busy_days is None else busy_days
    flagged = with_previous_row_flags(transactions, settings.rapid_transaction_minutes, crowded=crowded, staging=staging)
    flagged = with_repeated_declines(with_customer_history(flagged, history), busy_days)
    flagged = flagged.withColumns(
        {
            "high_value_transaction": high_value(settings.high_value_transaction),
            "unusual_transaction_time": unusual_time(settings.unusual_hour_start, settings.unusual_hour_end),
            "balance_issue": balance_issue(settings.negative_balance_warning),
        }
    )
    score = anomaly_score(settings.weights, flagged.columns)
    return flagged.withColumns(
        {
            "anomaly_score": score,
            "review_priority": review_priority(score),
            "triggered_rules": text.fired_names(list(settings.weights)),
        }
    )


def flagged_rows(
    transactions: DataFrame,
    settings: Settings,
    history: DataFrame | None = None,
    busy_days: DataFrame | None = None,
    crowded: DataFrame | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """The transactions with a score, still without ids. A ``transaction_key`` is carried along."""
    keys = [name for name in ("transaction_key",) if name in transactions.columns]
    return (
        flag_transactions(transactions, settings, history, busy_days, crowded, staging)
        .where("anomaly_score > 0")
        .select(
            "source_row_number",
            *keys,
            *REPORTED_COLUMNS,
            *settings.weights,
            "triggered_rules",
            "anomaly_score",
            "review_priority",
            "synthetic_anomaly_flag",
        )
    )


def number_flags(flagged: DataFrame) -> DataFrame:
    """Flagged rows with ids in source order."""
    numbered = number_by_position(flagged, "anomaly_number", "source_row_number")
    others = [name for name in flagged.columns if name != "source_row_number"]
    return numbered.select(text.numbered_id("ANOM", F.col("anomaly_number")).alias("anomaly_id"), *others)


def crowded_slots_of(transactions: DataFrame, settings: Settings, history: DataFrame) -> DataFrame:
    """The crowded slots, looked for only among customers with so many rows; ``history`` is stored."""
    busy = history.where(F.col("customer_rows") > SLOT_ROWS).select("customer_id")
    return crowded_slots(transactions, settings.rapid_transaction_minutes, busy)


def run_anomaly_rules(transactions: DataFrame, settings: Settings, staging: Staging | None = None) -> DataFrame:
    """The flag table. What the rules compare rows with and the flagged rows are stored once."""
    staging = Staging(transactions.sparkSession) if staging is None else staging
    counts = staging.save(amount_counts(transactions), "amount_counts")
    history = staging.save(customer_history(transactions, counts), "customer_history")
    busy_days = staging.save(busy_decline_days(transactions), "busy_decline_days")
    crowded = staging.save(crowded_slots_of(transactions, settings, history), "crowded_slots")
    flagged = flagged_rows(transactions, settings, history, busy_days, crowded, staging)
    return number_flags(staging.save(flagged, "flagged_rows"))
