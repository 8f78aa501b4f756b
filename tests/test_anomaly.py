"""Review rules against small cases and against a row-by-row reading of their definitions."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from fixtures import table
from pyspark.sql import functions as F

from ledgerflow.functions.vocabulary import REGION_OF_STATE
from ledgerflow.operators import anomaly
from ledgerflow.settings import DEFAULT_WEIGHTS, Settings

SETTINGS = Settings()


def flags(frame, name):
    return [row[0] for row in frame.orderBy("source_row_number").select(name).collect()]


def at(hour, minute=0, second=0, day=1):
    return datetime(2024, 1, day, hour, minute, second)


def rows(spark, *changes):
    return table(spark, "transactions", *[{"transaction_id": f"T{at}", **change} for at, change in enumerate(changes, 1)])


def test_high_value_includes_the_threshold(spark):
    frame = rows(spark, *[dict(transaction_amount=Decimal(value)) for value in (100, 6000, 5000)])
    assert flags(frame.withColumn("flag", anomaly.high_value(5000)), "flag") == [False, True, True]


def test_rapid_repeat(spark):
    frame = rows(
        spark,
        dict(transaction_amount=Decimal("25.00"), transaction_timestamp=at(10)),
        dict(transaction_amount=Decimal("25.40"), transaction_timestamp=at(10, 5)),
        dict(transaction_amount=Decimal("25.00"), transaction_timestamp=at(11)),
        dict(transaction_amount=Decimal("24.50"), transaction_timestamp=at(11, 1)),
        dict(transaction_amount=Decimal("25.00"), transaction_timestamp=at(11, 10)),
        dict(transaction_amount=Decimal("25.00"), transaction_timestamp=at(11, 20, 1)),
    )
    flagged = anomaly.with_previous_row_flags(frame, 10)
    assert flags(flagged, "rapid_repeat_transaction") == [False, True, False, False, True, False]


def test_repeat_across_the_edge_of_a_time_slot(spark):
    frame = rows(spark, dict(transaction_timestamp=at(5, 59)), dict(transaction_timestamp=at(6, 1)), dict(transaction_timestamp=at(6, 1)))
    flagged = anomaly.with_previous_row_flags(frame, 10)
    assert flags(flagged, "rapid_repeat_transaction") == [False, True, True]
    assert flagged.count() == 3


def test_geography_needs_two_known_regions_within_two_hours(spark):
    moves = [("TX", at(3)), ("NY", at(5)), ("TX", at(7, 0, 1)), ("ZZ", at(7, 30)), ("NY", at(8)), ("MA", at(9)), ("CA", at(9))]
    frame = rows(spark, *[dict(state=state, transaction_timestamp=moment) for state, moment in moves])
    flagged = anomaly.with_previous_row_flags(frame, 10)
    assert flags(flagged, "geographic_inconsistency") == [False, True, False, False, False, False, True]


def test_first_two_international_rows_are_unusual(spark):
    abroad = [True, False, True, True]
    frame = rows(spark, *[dict(is_international=value, transaction_timestamp=at(10)) for value in abroad])
    assert flags(anomaly.with_unusual_international(frame), "unusual_international_activity") == [True, False, True, False]


def test_night_hours_include_both_ends(spark):
    frame = rows(spark, *[dict(transaction_timestamp=moment) for moment in (at(0), at(5, 59, 59), at(6))])
    assert flags(frame.withColumn("flag", anomaly.unusual_time(0, 5)), "flag") == [True, True, False]


def test_three_declines_in_a_day(spark):
    days = [(1, "Declined")] * 3 + [(1, "Approved")] + [(2, "Declined")] * 2
    frame = rows(spark, *[dict(transaction_date=date(2024, 1, day), transaction_status=status) for day, status in days])
    assert flags(anomaly.with_repeated_declines(frame), "repeated_declines") == [True] * 3 + [False] * 3


def test_balance_issue(spark):
    cases = [(-500, 1000), (-499, 1000), (-500, 999)]
    frame = rows(spark, *[dict(balance_after_transaction=Decimal(b), transaction_amount=Decimal(a)) for b, a in cases])
    assert flags(frame.withColumn("flag", anomaly.balance_issue(-500)), "flag") == [True, False, False]


def test_spending_of_a_single_row_customer(spark):
    frame = rows(spark, dict(transaction_amount=Decimal(501)), dict(transaction_amount=Decimal(9), customer_id="OTHER"))
    assert flags(anomaly.with_spending_deviation(frame), "spending_deviation") == [False, False]


def test_spending_beyond_whole_numbers_and_without_amounts(spark):
    rows_ = [("A", 10**18, 5), ("A", 10**18 + 10**17, 5), ("B", 1000, 10**18), ("B", 3000, 10**18), ("C", None, 4), ("D", 700, 1)]
    counts = spark.createDataFrame(rows_, "customer_id string, cents bigint, times bigint")
    found = {row.customer_id: row for row in anomaly.customer_spending(counts).collect()}
    assert found["A"].mean_amount == pytest.approx(1.05e16)
    assert found["A"].amount_deviation == pytest.approx(0.05e16 * (10 / 9) ** 0.5)
    assert (found["B"].mean_amount, found["B"].customer_rows) == (20.0, 2 * 10**18)
    assert found["B"].amount_deviation == pytest.approx(10.0)
    assert (found["C"].mean_amount, found["C"].amount_deviation, found["C"].median_amount) == (None, 0.0, None)
    assert (found["D"].mean_amount, found["D"].amount_deviation, found["D"].median_amount) == (7.0, 0.0, 7.0)


def test_spending_does_not_depend_on_partitions(spark):
    pick = random.Random(8)
    changes = [dict(customer_id=f"C{at % 3}", transaction_amount=Decimal(pick.randrange(1, 10**7)) / 100) for at in range(600)]
    frame = rows(spark, *changes)
    found = [sorted(map(tuple, anomaly.customer_spending(anomaly.amount_counts(frame.repartition(n))).collect())) for n in (1, 200)]
    assert found[0] == found[1]


def test_score_skips_absent_rules_and_reads_null_as_false(spark):
    frame = spark.createDataFrame(
        [(True, True, False), (False, True, True), (None, None, None)],
        "high_value_transaction boolean, rapid_repeat_transaction boolean, balance_issue boolean",
    )
    weights = {"high_value_transaction": 2, "rapid_repeat_transaction": 2, "balance_issue": 2, "absent": 9}
    scored = frame.select(anomaly.anomaly_score(weights, frame.columns).alias("score"))
    assert [row.score for row in scored.collect()] == [4, 4, 0]


def test_priority_limits(spark):
    frame = spark.createDataFrame([(value,) for value in (6, 5, 3, 2, 1, 0)], "score int")
    found = [row[0] for row in frame.select(anomaly.review_priority(F.col("score"))).collect()]
    assert found == ["High", "Medium", "Medium", "Low", "Low", "None"]


def expected_flags(pdf):
    """Row-by-row reading of the rules, in plain pandas."""
    pdf = pdf.sort_values("source_row_number").reset_index(drop=True)
    out = pd.DataFrame(index=pdf.index)
    amounts = pdf["transaction_amount"].astype(float)
    out["high_value_transaction"] = amounts >= SETTINGS.high_value_transaction
    limits = amounts.groupby(pdf["customer_id"]).transform(
        lambda group: max(group.mean() + 3 * (group.std() if len(group) > 1 else 0), group.median() * 4, 500)
    )
    out["spending_deviation"] = amounts > limits
    ordered = pdf.sort_values(["transaction_timestamp", "source_row_number"])
    repeat, moved, abroad = {}, {}, {}
    last_repeat, last_place, seen = {}, {}, {}
    for index, row in ordered.iterrows():
        moment, customer = row["transaction_timestamp"], row["customer_id"]
        key = (customer, row["merchant_id"], round(float(row["transaction_amount"])))
        repeat[index] = key in last_repeat and moment - last_repeat[key] <= timedelta(minutes=10)
        last_repeat[key] = moment
        region = REGION_OF_STATE.get(row["state"], "Unknown")
        before = last_place.get(customer)
        moved[index] = bool(before and before[0] != region and "Unknown" not in (before[0], region) and moment - before[1] <= timedelta(hours=2))
        last_place[customer] = (region, moment)
        abroad[index] = bool(row["is_international"] and seen.get(customer, 0) <= 1)
        seen[customer] = seen.get(customer, 0) + int(row["is_international"])
    out["rapid_repeat_transaction"] = pd.Series(repeat)
    out["geographic_inconsistency"] = pd.Series(moved)
    out["unusual_international_activity"] = pd.Series(abroad)
    out["unusual_transaction_time"] = pdf["transaction_timestamp"].dt.hour <= 5
    declined = pdf["transaction_status"] == "Declined"
    per_day = declined.groupby([pdf["customer_id"], pdf["transaction_date"]]).transform("sum")
    out["repeated_declines"] = declined & (per_day >= 3)
    out["balance_issue"] = (pdf["balance_after_transaction"].astype(float) <= -500) & (amounts >= 1000)
    return out[list(DEFAULT_WEIGHTS)]


@pytest.mark.parametrize("slot_rows", [anomaly.SLOT_ROWS, 15])
def test_all_rules_with_one_customer_holding_a_third_of_the_rows(spark, monkeypatch, slot_rows):
    monkeypatch.setattr(anomaly, "SLOT_ROWS", slot_rows)
    random.seed(11)
    start = datetime(2024, 1, 1)
    changes = []
    for _ in range(1500):
        customer = "HEAVY" if random.random() < 0.35 else f"C{random.randrange(30)}"
        moment = start + timedelta(seconds=random.randrange(0, 3 * 86400, 30))
        changes.append(
            dict(
                customer_id=customer, merchant_id=f"M{random.randrange(2)}", transaction_timestamp=moment, transaction_date=moment.date(),
                transaction_amount=Decimal(random.choice(["24.50", "25.50", "25.00", "600.00", "1500.00", "7000.00"])),
                state=random.choice(["TX", "NY", "CA", "ZZ", None]), is_international=random.random() < 0.05,
                transaction_status=random.choice(["Approved", "Declined"]), balance_after_transaction=Decimal(random.randrange(-2000, 2000)),
            )
        )
    frame = rows(spark, *changes).repartition(5)
    expected = expected_flags(frame.toPandas())
    scored = anomaly.flag_transactions(frame, SETTINGS).toPandas().sort_values("source_row_number").reset_index(drop=True)
    assert len(scored) == 1500
    for rule in DEFAULT_WEIGHTS:
        assert expected[rule].any(), rule
        assert scored[rule].tolist() == expected[rule].tolist(), rule
    score = sum(expected[rule].astype(int) * weight for rule, weight in DEFAULT_WEIGHTS.items())
    assert scored["anomaly_score"].tolist() == score.tolist()
    crowded = anomaly.crowded_slots(frame, SETTINGS.rapid_transaction_minutes)
    assert (crowded.count() > 5) == (slot_rows == 15)
    again = anomaly.flag_transactions(frame, SETTINGS, crowded=crowded).toPandas().sort_values("source_row_number").reset_index(drop=True)
    assert again[list(DEFAULT_WEIGHTS)].equals(scored[list(DEFAULT_WEIGHTS)])
    reported = anomaly.run_anomaly_rules(frame, SETTINGS).toPandas().sort_values("anomaly_id")
    assert reported["transaction_id"].tolist() == scored.loc[score > 0, "transaction_id"].tolist()
    assert reported["anomaly_id"].iloc[0] == "ANOM0000001"
    first = next(rule for rule in DEFAULT_WEIGHTS if expected[rule][score.to_numpy().nonzero()[0][0]])
    assert reported["triggered_rules"].iloc[0].split(", ")[0] == first


def test_no_flags_for_no_rows(spark):
    assert anomaly.run_anomaly_rules(rows(spark).limit(0), SETTINGS).count() == 0
