"""What keeps heavy keys and large tables apart: plans and row placement."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from fixtures import SCHEMAS, table
from pyspark.sql import functions as F

from ledgerflow.operators import anomaly, dimensions, facts, numbering, quality
from ledgerflow.operators.neighbours import Before, previous_in_groups, previous_in_ranges
from ledgerflow.plans import measures, pipeline, rollup, views
from ledgerflow.plans.pipeline import Warehouse
from ledgerflow.session import apply_settings
from ledgerflow.settings import Settings
from ledgerflow.sources import csv
from ledgerflow.sources.staging import Staging


@pytest.fixture
def small_limits(spark):
    """Limits small enough for test data to count as skewed, and no broadcast joins."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in changed}
    apply_settings(spark)
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def heavy_rows(spark, count=200_000):
    """A third of the rows has key 0 and an eighth has none."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 8 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(0, count, 1, 8).select("id", key.cast("bigint").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_lookup_of_a_heavy_key_is_split(small_limits):
    rows = heavy_rows(small_limits)
    dimension = small_limits.range(5000).select((F.col("id") + 1).alias("member_key"), F.col("id").alias("business_key"))
    keyed = numbering.lookup_key(rows, dimension, "member_key", "key", "business_key")
    found = keyed.select("id", "member_key", "text")
    assert len(found.collect()) == 200_000
    assert "skew=true" in final_plan(found)


def test_existence_check_of_a_heavy_key_is_split(small_limits):
    rows = heavy_rows(small_limits)
    known = small_limits.range(100).select(F.col("id").alias("key"))
    marked = quality.mark_known(rows, "key", known, "key", "is_known").select("id", "is_known", "text")
    found = marked.collect()
    assert len(found) == 200_000
    assert sum(row.is_known for row in found) == rows.where("key < 100").count()
    assert "skew=true" in final_plan(marked)


def test_history_of_a_heavy_customer_is_spread(spark):
    start = datetime(2024, 1, 1)
    changes = [
        dict(transaction_id=f"T{at}", transaction_timestamp=start + timedelta(hours=at), transaction_amount=Decimal("10.00"))
        for at in range(400)
    ]
    rows = table(spark, "transactions", *changes)
    slotted = anomaly.in_time_slots(rows, 7200, ["customer_id", "transaction_timestamp", "source_row_number"])
    sizes = slotted.groupBy("customer_id", "slot").count().collect()
    assert max(row["count"] for row in sizes) <= anomaly.SLOT_HOURS + 2
    plan = anomaly.with_previous_row_flags(rows, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_one_hour_of_one_customer_is_spread_over_ranges(spark, tmp_path):
    """Rows before, over ranges, equal those of one window; the hour lies in many ranges of like size."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        count = 20_000
        rows = spark.range(0, count, 1, 4).select(
            F.lit("HEAVY").alias("owner"), F.col("id"), ((F.col("id") * 7919) % 3600).alias("second"),
            (F.col("id") % 7).alias("merchant"), F.when(F.col("id") % 3 == 0, F.col("id") % 1000).alias("amount"),
        ).unionByName(spark.range(count, count + 500).selectExpr("concat('C', id % 50) owner", "id", "id % 3600 second", "id % 2 merchant", "id % 3 amount"))
        wanted = {"repeat": Before(("merchant", "amount"), {"r": "id"}), "last": Before((), {"l": "id", "m": "merchant"})}
        plain = previous_in_groups(rows, ["owner"], ["second", "id"], wanted)
        staging = Staging(spark)
        ranged = previous_in_ranges(rows, ["owner"], ["second", "id"], wanted, staging, "rows")
        assert ranged.columns == plain.columns
        assert sorted(map(str, ranged.collect())) == sorted(map(str, plain.collect()))
        sizes = spark.read.parquet(staging.path("rows")).where("owner = 'HEAVY'").groupBy("range_number").count().collect()
        assert len(sizes) >= 3
        assert max(row["count"] for row in sizes) < count / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_spending_reads_the_transactions_once(spark):
    """Statistics and medians come from the stored counts; the transactions are grouped once."""
    rows = table(spark, "transactions", *[dict(transaction_id=f"T{at}", transaction_amount=Decimal(at)) for at in range(1, 40)])
    staging = Staging(spark)
    counts = staging.save(anomaly.amount_counts(rows), "amount_counts")
    plan = final_plan(anomaly.customer_history(rows, counts))
    assert plan.count("Scan ExistingRDD") == 1  # early_international
    assert "FileScan parquet [customer_id" in plan


def test_each_lookup_table_is_joined_once(small_limits):
    """The check finds the surrogate keys; the fact joins only what the valid rows themselves define."""
    settings = Settings()
    cleaned = {name: table(small_limits, name) for name in SCHEMAS}
    staging = Staging(small_limits)
    known = {name: staging.save(build(cleaned), name) for name, build in dimensions.BUILDERS.items() if name in {row[4] for row in quality.LOOKUPS}}
    checked = quality.check_transactions(cleaned, settings, dimensions=known)
    assert final_plan(checked).count("SortMergeJoin") == len(quality.LOOKUPS) + 1  # and the repeated ids
    checked = staging.save(checked, "checked_transactions")
    tables = {**cleaned, "valid_transactions": quality.valid_transactions(checked)}
    rest = {name: staging.save(build(tables), name) for name, build in dimensions.BUILDERS.items() if name not in known}
    words = staging.save(numbering.kept_words(tables["valid_transactions"], "source_row_number"), "words")
    keyed = numbering.number_kept_rows(quality.keyed_transactions(checked), "transaction_key", "source_row_number", words)
    fact = facts.build_fact_transaction(keyed, {**known, **rest})
    assert final_plan(fact).count("SortMergeJoin") == 4  # channel, status, place and the row's own number
    plain = facts.build_fact_transaction(tables["valid_transactions"], {**known, **rest})
    assert fact.collect() == plain.collect()


def test_early_international_rows_are_limited_before_the_shuffle(spark):
    plan = final_plan(anomaly.early_international(table(spark, "transactions")))
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_views_sum_before_they_join(spark):
    fact = spark.range(1000).select(
        (F.col("id") % 7).alias("transaction_category_key"), F.lit(Decimal("1.00")).alias("transaction_amount"),
        F.lit(Decimal("1.00")).alias("approved_amount"), F.lit(False).alias("is_declined"),
    )
    category = spark.range(7).select(F.col("id").alias("transaction_category_key"), F.col("id").cast("string").alias("transaction_category"))
    frame = views.category_performance({"fact_transaction": fact, "dim_transaction_category": category})
    below_join = final_plan(frame).split("Join")[-1]
    assert "partial_sum" in below_join
    assert frame.agg(F.sum("transaction_count")).first()[0] == 1000


def test_groups_of_a_ranged_number_are_bounded(spark):
    frame = spark.range(0, 300_000, 3).select("id")
    numbered = numbering.number_by_position(frame, "number", "id", bits=12)
    outside = numbered.where(F.col("number") != F.col("id") / 3 + 1)
    assert outside.count() == 0
    largest = frame.groupBy(F.shiftright("id", 12)).count().agg(F.max("count")).first()[0]
    assert largest <= 4096


def test_views_are_added_up_from_one_pass_over_the_fact(spark):
    """Totals from the stored rollups equal those of the fact, for every key set and coarser ones; the fact is not read."""
    key = lambda size, step: (F.col("id") * step % size).cast("bigint")
    flag = lambda size: F.col("id") % size == 0
    money = lambda step: (F.col("id") * step % 1000 / 100).cast("decimal(28,2)")
    fact = spark.range(3000).select(
        F.col("id").cast("string").alias("transaction_id"), (20240101 + F.col("id") % 5).cast("int").alias("date_key"), key(4, 7).alias("transaction_category_key"),
        key(3, 5).alias("channel_key"), key(2, 3).alias("transaction_status_key"), key(40, 11).alias("customer_key"), key(9, 13).alias("merchant_key"),
        key(50, 17).alias("account_key"), key(6, 19).alias("location_key"), flag(4).alias("is_recurring"), flag(7).alias("is_international"), flag(2).alias("is_approved"),
        flag(3).alias("is_declined"), flag(5).alias("is_reversed"), flag(11).alias("is_pending"),
        *[money(at).alias(name) for at, name in enumerate(("transaction_amount", "approved_amount", "debit_amount", "credit_amount", "signed_transaction_amount"), 3)],
    )
    staging = Staging(spark)
    stored = staging.save(fact, "fact")

    class Stored(dict):
        def rollups(self):
            return held

    held = staging.save(rollup.fact_rollups(stored), "rollups")
    assert held.count() < 800
    tables, plain = Stored(fact_transaction=stored), {"fact_transaction": stored}
    names = list(rollup._measures())
    cuts = [*rollup.ROLLUPS, (), ("date_key",), ("is_recurring",), ("customer_key",), ("channel_key", "date_key"), ("customer_key", "merchant_key")]
    for keys in cuts:
        found, expected = rollup.totals_by_key(tables, list(keys), names), rollup.totals_by_key(plain, list(keys), names)
        assert found.schema == expected.schema or found.dtypes == expected.dtypes
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect())), keys
        reads_rollups = "rollup_set" in final_plan(found)
        assert reads_rollups == (keys != ("customer_key", "merchant_key"))
    empty = Stored(fact_transaction=stored.limit(0))
    held = staging.save(rollup.fact_rollups(stored.limit(0)), "no_rollups")
    assert tuple(rollup.totals_by_key(empty, [], ["rows", "approved_count", "total_transaction_value"]).first()) == (0, 0, None)


def test_transactions_are_shuffled_once_for_accounts_customers_and_devices(small_limits):
    """The stored combinations of ids give the same check in one join; ids that are null or unknown keep their rows."""
    changes = [
        dict(transaction_id=f"T{at}", account_id=account, customer_id=customer, device_id=device)
        for at, (account, customer, device) in enumerate(
            [("ACC000001", "CUST000001", "DEV00001"), ("ACC000001", "CUST000001", None), ("ACC9", "CUST000001", "DEV9"), (None, None, None), (None, "CUST9", None), (None, None, None)]
        )
    ]
    cleaned = {name: table(small_limits, name) for name in SCHEMAS} | {"transactions": table(small_limits, "transactions", *changes)}
    staging = Staging(small_limits)
    known = {name: staging.save(build(cleaned), name) for name, build in dimensions.BUILDERS.items() if name in {row[4] for row in quality.LOOKUPS}}
    repeated = staging.save(quality.repeated_values(cleaned["transactions"], "transaction_id"), "repeated_ids")
    parties = staging.save(quality.known_parties(cleaned, known), "known_parties")
    assert parties.count() == 5
    plain = quality.check_transactions(cleaned, Settings(), repeated, known)
    checked = quality.check_transactions(cleaned, Settings(), repeated, known, parties)
    assert final_plan(checked).count("SortMergeJoin") == final_plan(plain).count("SortMergeJoin") - 2
    assert checked.schema == plain.schema
    assert sorted(map(str, checked.collect())) == sorted(map(str, plain.collect()))


def test_exports_are_compressed(spark, tmp_path):
    frame = spark.range(20_000).select("id", F.lit("a description, with a comma").alias("text"))
    (path,) = csv.export_tables({"rows": frame}, str(tmp_path))
    assert sum(file.stat().st_size for file in (tmp_path / "rows").glob("part-*")) < 200_000
    assert csv.read_csv(spark, path).select(F.col("id").cast("bigint"), "text").orderBy("id").collect() == frame.collect()


def test_a_query_makes_only_the_totals_it_reads(spark):
    """One key set by itself has the rows that the pass over all sets gives it, and the warehouse stores no other set."""
    keys = [f"cast(id * {step} % {size} AS bigint) AS {key}" for key, step, size in (
        ("transaction_category_key", 7, 4), ("channel_key", 5, 3), ("transaction_status_key", 3, 2), ("customer_key", 11, 40), ("merchant_key", 13, 9),
        ("account_key", 17, 50), ("location_key", 19, 6))]
    flags = [f"id % {at} = 0 AS {name}" for at, name in enumerate(("is_recurring", "is_international", "is_approved", "is_declined", "is_reversed", "is_pending"), 2)]
    names = ("transaction_amount", "approved_amount", "debit_amount", "credit_amount", "signed_transaction_amount")
    money = [f"cast(id * {at} % 1000 / 100 AS decimal(28,2)) AS {name}" for at, name in enumerate(names, 3)]
    calendar = ["cast(id AS string) AS transaction_id", "cast(20240101 + id % 5 AS int) AS date_key"]
    fact = spark.range(500).selectExpr(*calendar, *keys, *flags, *money)
    together = rollup.fact_rollups(fact)
    for at, key_set in enumerate(rollup.ROLLUPS):
        alone = rollup.fact_rollup(fact, key_set)
        assert alone.dtypes == together.dtypes
        expected = together.where(F.col("rollup_set") == rollup._rollup_id(key_set))
        assert alone.count() > 0 and alone.exceptAll(expected).isEmpty() and expected.exceptAll(alone).isEmpty(), at
    warehouse = Warehouse({}, Settings(), Staging(spark))
    warehouse._ready["fact_transaction"] = fact
    found = rollup.totals_by_key(warehouse, ["date_key"], ["rows"])
    assert sorted(map(tuple, found.collect())) == [(20240101 + day, 100) for day in range(5)]
    assert set(warehouse._ready) == {"fact_transaction", "fact_rollup_0"}


def odd_transactions(spark):
    """Cleaned tables whose transactions fail every kind of rule, some with ids that are null or unknown."""
    odd = [{}, {}, dict(transaction_id="TWICE"), dict(transaction_id="TWICE"), dict(transaction_id=None), dict(account_id=None), dict(account_id="ACC9"), dict(customer_id=None)]
    odd += [dict(customer_id="CUST9"), dict(merchant_id=None), dict(merchant_id="MER9"), dict(branch_id="BR9"), dict(branch_id=None), dict(device_id="DEV9"), dict(device_id=None)]
    odd += [dict(transaction_category="Gambling"), dict(transaction_category=None), dict(transaction_amount=Decimal(-1)), dict(transaction_amount=None), dict(transaction_date=None)]
    odd += [dict(transaction_timestamp=None), dict(currency="EUR"), dict(transaction_status="Declined"), dict(city=None, state=None), dict(transaction_amount=Decimal("7.555"))]
    rows = [dict(transaction_id=f"T{at}", source_row_number=at + 1) | changes for at, changes in enumerate(odd * 4)]
    for at, row in enumerate(rows):
        if (row["transaction_id"] or "").startswith("T") and row["transaction_id"] != "TWICE":
            row["transaction_id"] = f"T{at}"
    return {name: table(spark, name) for name in SCHEMAS} | {"transactions": table(spark, "transactions", *rows)}


def warehouse_of(spark, cleaned, whole):
    made = Warehouse({}, Settings(), Staging(spark))
    made._ready.update(cleaned)
    made._all_rollups = whole
    return made


def test_valid_rows_are_found_by_their_ids(small_limits):
    """F8, F9, F13-F20: the joins with the lookup tables see ids and dates, never a whole row, and find the rows that the check finds."""
    cleaned, staging = odd_transactions(small_limits), Staging(small_limits)
    cleaned = {name: staging.save(frame, name) for name, frame in cleaned.items()}
    owners = staging.save(quality.known_parties(cleaned, ids=quality.OWNER_COLUMNS), "owners")
    found = quality.valid_row_numbers(cleaned, Settings(), owners)
    expected = quality.valid_transactions(quality.check_transactions(cleaned, Settings())).select("source_row_number")
    wanted = sorted(row[0] for row in expected.collect())
    assert sorted(row[0] for row in found.collect()) == wanted
    assert 0 < len(wanted) < cleaned["transactions"].count()
    for part in final_plan(found).split("Exchange")[1:]:
        assert not {"transaction_amount", "description", "city", "balance_after_transaction"} & set(part.split("FileScan")[0].replace("#", " ").split())


def test_totals_need_neither_the_check_nor_the_fact(spark):
    """A query on totals stores no checked transactions and no fact; totals, fact, dimensions and flags equal those of a full run."""
    apply_settings(spark)
    cleaned = odd_transactions(spark)
    alone, whole = warehouse_of(spark, cleaned, False), warehouse_of(spark, cleaned, True)
    names = list(rollup._measures())
    for keys in [*rollup.ROLLUPS, (), ("date_key", "transaction_category_key"), ("customer_key",)]:
        found, expected = (sorted(map(str, rollup.totals_by_key(made, list(keys), names).collect())) for made in (alone, whole))
        assert found == expected and found, keys
    assert not {"checked_transactions", "fact_transaction", "numbered_transactions"} & set(alone._ready)
    assert "checked_transactions" in whole._ready
    tables = ("fact_transaction", "dim_channel", "dim_location", "dim_transaction_status", "fact_anomaly_flag", "fact_customer_monthly_summary")
    for name in tables:
        assert alone[name].dtypes == whole[name].dtypes
        assert sorted(map(str, alone[name].collect())) == sorted(map(str, whole[name].collect())), name
    assert alone["fact_transaction"].count() > 0
    assert "checked_transactions" not in alone._ready


def test_shuffles_are_cut_fine_enough_to_sort_without_spilling(spark):
    apply_settings(spark)
    cuts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(spark.conf.get(cuts)) >= 400
    rows = spark.range(0, 100_000, 1, 4).groupBy(F.col("id") % 50_000).count()
    rows.collect()
    assert len(rows.collect()) == 50_000


def test_distinct_keys_need_neither_the_fact_nor_the_valid_rows(spark):
    """customers and accounts are counted from the pairs that occur in the valid transactions; no row is stored for them."""
    apply_settings(spark)
    cleaned = odd_transactions(spark)
    alone, whole = warehouse_of(spark, cleaned, False), warehouse_of(spark, cleaned, True)
    names = ["active_customers", "active_accounts"]
    for attributes in ({"dim_transaction_category": ["transaction_category"]}, {"dim_merchant": ["merchant_id"], "dim_date": ["month_start_date"]}):
        found, expected = (sorted(map(str, measures.measures_by(made, attributes, names).collect())) for made in (alone, whole))
        assert found == expected and found, attributes
    assert not {"checked_transactions", "fact_transaction", "valid_rows"} & set(alone._ready)
    by_channel = {"dim_channel": ["transaction_channel"]}
    found, expected = (sorted(map(str, measures.measures_by(made, by_channel, names).collect())) for made in (alone, whole))
    assert found == expected and "fact_transaction" not in alone._ready


def test_owners_come_from_their_tables_and_no_row_is_stored_for_totals(small_limits):
    """the accounts with their customers are found without the transactions, and totals by customer read only their columns."""
    cleaned, staging = odd_transactions(small_limits), Staging(small_limits)
    accounts = [{}, dict(customer_id="CUST9"), dict(account_id="ACC2", customer_id="CUST9"), dict(account_id=None), dict(account_id="ACC3", customer_id=None)]
    accounts += [dict(account_id="ACC4", account_status="Closed", close_date=datetime(2024, 1, 15).date()), dict(account_id="ACC5", open_date=datetime(2024, 3, 1).date())]
    customers = [{}, {}, dict(customer_id=None), dict(customer_id="CUST2")]
    rows = [dict(transaction_id=f"O{at}", account_id=account, customer_id=owner) for at, (account, owner) in enumerate(
        [("ACC000001", "CUST000001"), ("ACC000001", "CUST2"), ("ACC2", "CUST9"), ("ACC3", None), (None, None), ("ACC4", "CUST000001"), ("ACC5", "CUST000001")])]
    cleaned |= {"accounts": table(small_limits, "accounts", *accounts), "customers": table(small_limits, "customers", *customers)}
    cleaned["transactions"] = table(small_limits, "transactions", *rows)
    cleaned = {name: staging.save(frame, name) for name, frame in cleaned.items()}
    owners = quality.known_owners({name: cleaned[name] for name in ("accounts", "customers")})
    assert sorted(row.account_id for row in owners.collect()) == ["ACC000001", "ACC4", "ACC5"]
    found = quality.valid_row_numbers(cleaned, Settings(), staging.save(owners, "known_owners"))
    expected = quality.valid_transactions(quality.check_transactions(cleaned, Settings())).select("source_row_number")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect())) == [(1,)]
    alone = warehouse_of(small_limits, cleaned, False)
    assert views.customer_spending_summary(alone).count() == 1
    assert not {"valid_rows", "dim_account", "fact_transaction"} & set(alone._ready)


def test_lines_are_not_shuffled_to_tables_of_few_rows(spark):
    """merchants and suppliers beyond Spark's size limit are still broadcast while their rows are few."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    staging = Staging(spark)
    cleaned = {name: staging.save(frame, name) for name, frame in odd_transactions(spark).items()}
    known = {name: staging.save(build(cleaned), name) for name, build in dimensions.BUILDERS.items() if name in {row[4] for row in quality.LOOKUPS}}
    owners = staging.save(quality.known_owners(cleaned), "known_owners")
    repeated = staging.save(quality.repeated_values(cleaned["transactions"], "transaction_id"), "repeated_ids")
    plain = quality.valid_row_numbers(cleaned, Settings(), owners, repeated)
    wanted = sorted(map(tuple, plain.collect()))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        found = quality.valid_row_numbers(cleaned, Settings(), owners, repeated, known)
        assert final_plan(found).count("BroadcastHashJoin") == 3
        assert sorted(map(tuple, found.collect())) == wanted
        assert "Broadcast" not in final_plan(spark.range(9).join(numbering.sent_if_small(spark.range(5), most=4), "id"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Broadcast" not in final_plan(spark.range(9).join(numbering.sent_if_small(spark.range(5)), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_ids_that_grow_with_the_customers_are_not_broadcast(spark, monkeypatch):
    """customers beyond the row limit are joined without a broadcast, however small their files are."""
    cleaned, staging = {name: table(spark, name) for name in SCHEMAS}, Staging(spark)
    cleaned = {name: staging.save(frame, name) for name, frame in cleaned.items()}
    known = {name: staging.save(build(cleaned), name) for name, build in dimensions.BUILDERS.items() if name in {row[4] for row in quality.LOOKUPS}}
    checked = quality.check_accounts(cleaned["accounts"], cleaned["customers"], cleaned["branches"])
    assert final_plan(checked).count("SortMergeJoin") == 1 and checked.first().failed_rules == 0
    owners = quality.known_owners(cleaned)
    assert "BroadcastHashJoin" not in final_plan(owners) and owners.count() == 1
    few = quality.known_parties(cleaned, known)
    assert final_plan(few).count("BroadcastHashJoin") == 3
    monkeypatch.setattr(numbering.merged_if_large, "__defaults__", (0,))
    many = quality.known_parties(cleaned, known)
    assert "BroadcastHashJoin" not in final_plan(many)
    assert many.collect() == few.collect()


def test_all_tables_and_views_read_one_check(spark, tmp_path):
    """F2-F5: counts, reports and views by name build their tables like a full run, without a second search for valid rows."""
    cleaned = odd_transactions(spark)
    made = {
        "counts": lambda star: pipeline.reporting_tables(star),
        "reports": lambda star: pipeline.export_reports(star, str(tmp_path / "reports")),
        "tables": lambda star: pipeline.prepared(star, ("dim_channel", "fact_data_quality_issue")),
    }
    for name, make in made.items():
        star = warehouse_of(spark, cleaned, False)
        star.raw = {name: frame.select([F.col(part).cast("string") if part != "source_row_number" else F.col(part) for part in frame.columns]) for name, frame in cleaned.items()}
        make(star)
        assert "checked_transactions" in star._ready and not {"valid_rows", "known_owners"} & set(star._ready), name
        assert ("fact_rollups" in star._ready) == (name != "tables")
    plain = {"dim_channel": cleaned["branches"]}
    assert pipeline.prepared(plain, ("dim_channel",)) is plain
