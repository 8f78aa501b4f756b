"""Dimensions, facts, KPIs, reconciliation and the whole run from CSV."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from fixtures import tables
from pyspark.sql import functions as F

from ledgerflow.__main__ import main
from ledgerflow.operators import dimensions, facts, quality
from ledgerflow.operators.reconciliation import calculate_reconciliation_totals, checks
from ledgerflow.plans import kpis, pipeline, views
from ledgerflow.settings import Settings, read_settings
from ledgerflow.sources import csv

SETTINGS = Settings(end_date=date(2024, 12, 31))


def test_dim_date(spark):
    rows = dimensions.build_dim_date(spark, "2024-01-01", "2024-01-07").orderBy("date_key").collect()
    assert [row.date_key for row in rows[:3]] == [20240101, 20240102, 20240103]
    assert (rows[0].month_name, rows[0].quarter, rows[0].week_number, rows[0].day_of_week) == ("January", "Q1", 1, "Monday")
    assert [row.is_weekend for row in rows] == [False] * 5 + [True] * 2


def fact_rows(spark):
    return spark.createDataFrame(
        [
            ("T1", 1, 20240101, True, False, 100.0, 0.0, -100.0, 100.0, False, False),
            ("T2", 1, 20240115, True, False, 0.0, 500.0, 500.0, 500.0, True, False),
            ("T3", 2, 20991231, False, True, 1.0, 0.0, -1.0, 1.0, False, True),
        ],
        "transaction_id string, customer_key bigint, date_key int, is_approved boolean, is_declined boolean, debit_amount double, "
        "credit_amount double, signed_transaction_amount double, transaction_amount double, is_recurring boolean, is_international boolean",
    )


def test_monthly_summary_keeps_days_outside_the_calendar(spark):
    calendar = dimensions.build_dim_date(spark, "2024-01-01", "2024-01-31")
    first, second = facts.calculate_customer_monthly_summary(fact_rows(spark), calendar).orderBy("customer_monthly_summary_key").collect()
    assert (first.transaction_count, first.debit_transaction_value, first.net_transaction_flow) == (2, 100.0, 400.0)
    assert (first.customer_monthly_summary_key, first.month_date_key, first.average_transaction_amount) == (1, 20240101, 300.0)
    assert (second.month_start_date, second.transaction_count) == (None, 1)


def test_rates_and_totals(spark):
    fact = spark.createDataFrame(
        [("T1", True, False, -100.0, 100.0), ("T2", False, True, -50.0, 50.0), ("T3", True, False, 200.0, 0.0)],
        "transaction_id string, is_approved boolean, is_declined boolean, signed_transaction_amount double, debit_amount double",
    )
    assert tuple(fact.agg(kpis.approval_rate(), kpis.decline_rate(), kpis.net_flow()).first()) == (2 / 3, 1 / 3, 50.0)
    monthly = spark.createDataFrame([(3, 150.0)], "transaction_count bigint, debit_transaction_value double")
    assert tuple(calculate_reconciliation_totals(fact, monthly).first()) == (3.0, 3.0, 150.0, 150.0)
    assert tuple(fact.limit(0).agg(kpis.approval_rate()).first()) == (0.0,)


def build(spark, transactions, **others):
    validated = quality.validate_datasets(tables(spark, transactions=transactions, **others), SETTINGS)
    dims = dimensions.build_dimensions(validated, SETTINGS)
    return validated, facts.build_model_tables(validated, dims, SETTINGS)


def test_amounts_follow_the_indicator(spark):
    indicators = ["Debit", "Credit", "Hold", None]
    _, model = build(spark, [dict(transaction_id=f"T{at}", debit_credit_indicator=name) for at, name in enumerate(indicators)])
    rows = model["fact_transaction"].orderBy("transaction_key").collect()
    found = [(float(row.signed_transaction_amount), float(row.debit_amount), float(row.credit_amount)) for row in rows]
    assert found == [(-100.0, 100.0, 0.0), (100.0, 0.0, 100.0), (-100.0, 0.0, 0.0), (-100.0, 0.0, 0.0)]
    assert [row.transaction_key for row in rows] == [1, 2, 3, 4]


def test_keys_and_unknown_members(spark):
    _, model = build(
        spark, [dict(device_id="DEV9"), dict(transaction_id="T2", city=None, state="NY")],
        branches=({}, dict(branch_id="BR002", city="Boston", state="MA")),
    )
    fact = model["fact_transaction"].orderBy("transaction_key").collect()
    assert [(row.customer_key, row.device_key, row.branch_key) for row in fact] == [(1, 0, 0), (1, 1, 0)]
    places = {row.location_business_key: row.location_key for row in model["dim_location"].collect()}
    assert places == {"Unknown": 0, "Dallas|TX": 1, "None|NY": 2, "Boston|MA": 3}
    assert [row.location_key for row in fact] == [1, 2]
    unknown = model["dim_account"].where("account_key = 0").first()
    assert (unknown.account_id, unknown.open_date, unknown.current_balance) == ("Unknown", None, None)


def test_categories_are_deduplicated_by_name(spark):
    _, model = build(
        spark, [{}], transaction_categories=({}, dict(category_id="CAT02"), dict(category_id="CAT03", transaction_category="Travel"))
    )
    rows = model["dim_transaction_category"].orderBy("transaction_category_key").collect()
    assert [(row.transaction_category_key, row.category_id) for row in rows] == [(0, "Unknown"), (1, "CAT01"), (2, "CAT03")]


def test_daily_balance_takes_the_last_approved_row(spark):
    moment = datetime(2024, 2, 1, 12)
    changes = [
        dict(transaction_id="T1", transaction_timestamp=moment, balance_after_transaction=Decimal("1.00")),
        dict(transaction_id="T2", transaction_timestamp=moment, balance_after_transaction=Decimal("2.00")),
        dict(transaction_id="T3", transaction_timestamp=datetime(2024, 2, 1, 13), transaction_status="Declined"),
        dict(transaction_id="T4", transaction_date=date(2024, 2, 2), balance_after_transaction=Decimal("4.00")),
    ]
    _, model = build(spark, changes)
    rows = model["fact_account_daily_balance"].orderBy("account_daily_balance_key").collect()
    assert [(row.account_daily_balance_key, row.date_key, float(row.ending_balance)) for row in rows] == [(1, 20240201, 2.0), (2, 20240202, 4.0)]


def test_growth_needs_two_months(spark):
    one = spark.createDataFrame([(date(2024, 1, 1), 5.0)], "month_start_date date, debit_transaction_value double")
    two = one.unionAll(spark.createDataFrame([(date(2024, 3, 1), 15.0), (None, 99.0)], one.schema))
    zero = one.select("month_start_date", F.lit(0.0).alias("debit_transaction_value")).unionAll(two.where("debit_transaction_value = 15"))
    growth = [kpis.last_month_growth(frame).first().growth for frame in (one, two, zero, one.limit(0))]
    assert growth == [0.0, 2.0, 0.0, 0.0]


RAW_LINE = {
    "customers": "customer_id,customer_display_name,age_group,city,state,customer_segment,account_tenure_months,join_date,preferred_channel,"
    "risk_tier,income_band\ncust1,jo o'neil,25-34,dallas,tx,students,12,01/15/2023,mobile,low,$40k-$75k\n",
    "accounts": "account_id,customer_id,account_type,open_date,account_status,close_date,current_balance,credit_limit,branch_id,currency,"
    'product_tier\nacc1,cust1,checking,2024-01-01,active,,"$1,500.00",,br1,usd,standard\n',
    "transactions": "Transaction ID,account_id,customer_id,merchant_id,transaction_date,transaction_timestamp,transaction_amount,"
    "transaction_category,transaction_type,transaction_status,transaction_channel,device_id,branch_id,city,state,currency,"
    "debit_credit_indicator,description,is_international,is_recurring,balance_after_transaction,synthetic_anomaly_flag\n"
    't1,acc1,cust1,mer1,02/01/2024,2024-02-01 03:00:00,"$7,000.00", dinning ,card purchase, apprved ,POS,dev1,,dallas,tx,usd,debit,lunch,'
    'False,False,(900.00),False\n'
    "t2,acc1,cust1,mer1,2024-02-02,2024-02-02 13:00:00,50.00,dining,card purchase,declined,mobile,dev1,,dallas,tx,usd,debit,lunch,"
    "False,True,100.00,False\n"
    "t3,acc1,cust1,mer1,\"Mar 15, 2024\",2024-03-15 13:00:00,0,dining,card purchase,approved,mobile,dev1,,dallas,tx,usd,debit,lunch,"
    "False,True,100.00,False\n",
    "merchants": "merchant_id,merchant_name,merchant_category,city,state,region,is_online_only\nmer1,joe's,dinning,dallas,TX,south,no\n",
    "transaction_categories": "category_id,transaction_category,category_group\ncat1,dining,spending\n",
    "branches": "branch_id,branch_name,city,state,region,branch_type\nbr1,dallas,dallas,TX,south,Retail\n",
    "devices": "device_id,customer_id,device_type,operating_system,trusted_device\ndev1,cust1,Mobile App,iOS,yes\n",
    "customer_segments": "segment_id,segment_name,spend_multiplier,digital_preference\nseg1,students,1.0,0.8\n",
}


def test_whole_run_from_csv_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, content in RAW_LINE.items():
        (raw / csv.RAW_FILES[name]).write_text(content)
    out = str(tmp_path / "out")
    summary = {row.metric: row.value for row in pipeline.run_pipeline(spark, str(raw), out, SETTINGS).collect()}
    assert summary["raw_transaction_rows"] == "3"
    assert summary["valid_analyzed_transactions"] == "2"
    assert summary["potential_anomaly_flags"] == "1"
    assert summary["data_quality_issues"] == "1"
    assert summary["powerbi_export_files"] == "32"
    assert (summary["database_table_count_checks"], summary["database_view_count_checks"]) == ("17", "15")
    assert summary["excel_workbook"] == f"{out}/reports" and len(summary) == 13
    flag = csv.read_csv(spark, f"{out}/reporting/fact_anomaly_flag").first()
    assert (flag.transaction_id, flag.triggered_rules, flag.anomaly_score, flag.review_priority) == (
        "T1", "high_value_transaction, unusual_transaction_time, balance_issue", "5", "Medium")
    assert (flag.high_value_transaction, flag.transaction_date, flag.transaction_key) == ("1", "2024-02-01", "1")
    status = {row.reconciliation_name: row.status for row in csv.read_csv(spark, f"{out}/reports/reconciliation").collect()}
    assert len(status) == len(checks(SETTINGS)) == 14
    assert status["Raw transaction count versus valid processed count"] == "Failed"
    assert status["Raw transaction count versus valid plus rejected count"] == "Passed"
    found = csv.read_csv(spark, f"{out}/kpi_summary").collect()
    assert len(found) == 26
    assert {row.metric_name: float(row.metric_value) for row in found}["Median Transaction Amount"] == 3525.0


def test_run_command_with_settings_and_a_surplus_field(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, content in RAW_LINE.items():
        (raw / csv.RAW_FILES[name]).write_text(content.replace("dev1,cust1,Mobile App,iOS,yes", "dev1,cust1,Mobile App,iOS,yes,more"))
    (tmp_path / "settings.json").write_text('{"start_date": "2024-01-01", "weights": {"balance_issue": 9}, "supported_currency": ["USD"]}')
    main([str(raw), str(tmp_path / "out"), "--settings", str(tmp_path / "settings.json")])
    assert "data_quality_issues: 2" in capsys.readouterr().out
    log = csv.read_csv(spark, f"{tmp_path}/out/reporting/fact_data_quality_issue").where("rule_name = 'source_line_fields'").collect()
    assert [(r.source_file, r.record_identifier, r.original_value) for r in log] == [("devices.csv", "dev1", "dev1,cust1,Mobile App,iOS,yes,more")]
    flag = csv.read_csv(spark, f"{tmp_path}/out/reporting/fact_anomaly_flag").first()
    assert flag.anomaly_score == "12"


def test_unknown_settings_are_refused(tmp_path):
    (tmp_path / "settings.json").write_text('{"start": 1}')
    with pytest.raises(ValueError, match="start"):
        read_settings(str(tmp_path / "settings.json"))


def test_views_can_be_read_with_sql(spark):
    validated, model = build(spark, [{}])
    model["fact_anomaly_flag"] = facts.attach_transaction_keys(_no_flags(validated), model["fact_transaction"])
    names = views.register_views(spark, model)
    assert len([name for name in names if name.startswith("vw_")]) == 15
    assert spark.sql("SELECT total_transaction_count, potential_anomaly_count FROM vw_executive_kpis").first() == (1, 0)


def _no_flags(validated):
    from ledgerflow.operators import anomaly

    return anomaly.run_anomaly_rules(validated["valid_transactions"], SETTINGS)
