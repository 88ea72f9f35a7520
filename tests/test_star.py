import datetime as dt

from sparkmart.operators import dims, facts, marts, roi

D = dt.date
CUSTOMER_DDL = (
    "customer_id bigint, first_name string, last_name string, email string, gender string,"
    " region string, acquisition_channel string, signup_date date, credit_tier string,"
    " credit_score int, annual_income double, is_active boolean, data_quality_score double"
)


def _customers(spark, rows):
    """rows: (id, channel, signup, score, income)"""
    full = [
        (i, "A", "B", None, "Male", "West", ch, day, "Prime", score, income, True, 1.0)
        for i, ch, day, score, income in rows
    ]
    return spark.createDataFrame(full, CUSTOMER_DDL)


def _txns(spark, rows):
    """rows: (id, customer, date, amount, status)"""
    full = [
        (i, c, a, "Card", s, dt.datetime.combine(d, dt.time(1)) if d else None, "Food", False, 1.0)
        for i, c, d, a, s in rows
    ]
    return spark.createDataFrame(
        full,
        "transaction_id bigint, customer_id bigint, amount double, product_type string,"
        " status string, timestamp timestamp_ntz, merchant_category string,"
        " is_amount_outlier boolean, data_quality_score double",
    )


def test_customer_bands(spark):
    rows = [
        (1, "Email", D(2024, 1, 1), 750, 100000.0), (2, "Email", D(2024, 1, 1), 700, 60000.0),
        (3, "Email", None, 650, 59999.99), (4, "Email", D(2024, 1, 1), 649, None),
        (5, "Email", D(2024, 1, 1), None, 1.0),
    ]
    out = {r.customer_id: r for r in dims.customer(_customers(spark, rows), "2024-01-31").collect()}
    assert [out[i].credit_score_band for i in range(1, 6)] == [
        "Excellent", "Good", "Fair", "Poor", "Poor",
    ]
    assert [out[i].income_band for i in range(1, 6)] == ["High", "Medium", "Low", "Low", "Low"]
    assert out[1].days_since_signup == 30 and out[3].days_since_signup is None
    assert out[1].full_name == "A B"


def test_products(spark):
    ddl = (
        "product_id bigint, sku string, product_name string, category string, unit_cost double,"
        " selling_price double, stock_level int, reorder_point int, reorder_quantity int,"
        " lead_time_days int, supplier string, is_active boolean, data_quality_score double"
    )
    rows = [
        (1, "s", "n", "c", 5.0, 10.0, 0, 5, 1, 1, "x", True, 1.0),
        (2, "s", "n", "c", 7.0, 10.0, 5, 5, 1, 1, "x", True, 1.0),
        (3, "s", "n", "c", 7.01, 10.0, 6, 5, 1, 1, "x", True, 1.0),
        (4, "s", "n", "c", 7.0, 0.0, 6, 5, 1, 1, "x", True, 1.0),
        (5, "s", "n", "c", 1.0, 2.0, 6, 5, 1, 1, "x", False, 1.0),
        (6, "s", "n", "c", 1.0, 2.0, 6, 5, 1, 1, "x", None, 1.0),
    ]
    out = {r.product_id: r for r in dims.product(spark.createDataFrame(rows, ddl)).collect()}
    assert sorted(out) == [1, 2, 3, 4]
    assert [out[i].stock_status for i in (1, 2, 3)] == ["Out of Stock", "Low Stock", "In Stock"]
    assert [out[i].margin_band for i in (1, 2, 3)] == ["High Margin", "Medium Margin", "Low Margin"]
    assert out[4].margin_pct is None and out[4].margin_band == "Low Margin"
    mart = marts.inventory_health(dims.product(spark.createDataFrame(rows, ddl))).first()
    assert (mart.total_products, mart.out_of_stock_count, mart.out_of_stock_rate_pct) == (4, 1, 25.0)
    assert mart.total_units_to_reorder == 2 and mart.estimated_reorder_cost == 12.0


def test_campaign_maps(spark):
    rows = [("Welcome Series", "u"), ("Brand Awareness", "u"), (None, None), ("Welcome Series", "u")]
    out = {r.campaign: r for r in dims.campaign(
        spark.createDataFrame(rows, "campaign string, utm_campaign string")).collect()}
    assert (out["Welcome Series"].primary_channel, out["Welcome Series"].campaign_objective) == (
        "Email", "Acquisition",
    )
    assert out["Brand Awareness"].primary_channel == "Other" and len(out) == 3
    assert out[None].campaign_objective == "Other"


def test_calendar(spark):
    spine = dims.date_spine(spark, "2020-01-01", "2027-12-31")
    out = dims.date(spine)
    assert out.count() == 2921
    days = {r.date_id: r for r in out.where("year = 2024").collect()}
    sunday = days[D(2024, 3, 3)]
    assert (sunday.day_of_week, sunday.is_weekend, sunday.is_weekday) == (1, True, False)
    assert (sunday.season, sunday.quarter_label, sunday.month_year) == ("Spring", "Q1 2024", "Mar 2024")
    assert (sunday.day_name, sunday.week_of_year, sunday.year_month) == ("Sunday", 9, "2024-03")
    assert days[D(2024, 12, 1)].season == "Winter" and days[D(2024, 11, 30)].season == "Fall"


def test_transaction_facts_keep_clean_rows(spark):
    customers = _customers(spark, [(1, "Email", D(2024, 1, 1), 700, 1.0)])
    txns = _txns(
        spark,
        [
            (1, 1, D(2023, 12, 31), 5.0, "Completed"), (2, 9, D(2024, 1, 2), 5.0, "Failed"),
            (3, 1, None, 5.0, "Pending"),
        ],
    )
    out = {r.transaction_id: r for r in facts.transactions(txns, customers).collect()}
    assert out[1].days_since_signup_at_transaction == -1 and out[1].completed_amount == 5.0
    assert out[2].days_since_signup_at_transaction is None and out[2].is_failed == 1
    assert out[2].completed_amount == 0.0 and out[3].transaction_date is None
    dirty = txns.selectExpr("* except(data_quality_score)", "0.8D as data_quality_score")
    assert facts.clean_transactions(dirty).count() == 0


def _touches(spark, rows):
    full = [(i, c, "Email", "k", None, 2.0, conv, "u", "v", False, 1.0) for i, c, conv in rows]
    return spark.createDataFrame(
        full,
        "touch_id bigint, customer_id bigint, channel string, campaign string,"
        " touchpoint_date date, cost double, converted boolean, utm_source string,"
        " utm_campaign string, is_cost_outlier boolean, data_quality_score double",
    )


def test_unknown_outcome_is_in_neither_spend(spark):
    customers = _customers(spark, [(1, "Email", D(2024, 1, 1), 700, 1.0)])
    rows = [(1, 1, True), (2, 1, False), (3, 1, None)]
    spend = facts.marketing_spend(_touches(spark, rows), customers)
    out = {r.touch_id: (r.is_converted, r.converted_spend, r.unconverted_spend) for r in spend.collect()}
    assert out == {1: (1, 2.0, 0.0), 2: (0, 0.0, 2.0), 3: (0, 0.0, 0.0)}
    conversions = facts.conversions(_touches(spark, rows), customers).collect()
    assert {r.touch_id: r.cost_per_conversion for r in conversions} == {1: 2.0, 2: None, 3: None}
    keys = {r.channel_key for r in dims.channel(_touches(spark, rows)).collect()}
    assert keys == {r.channel_key for r in spend.collect()}


def test_ratios_without_conversions_are_null(spark):
    customers = _customers(spark, [(1, "Email", D(2024, 1, 1), 700, 1.0)])
    spend = facts.marketing_spend(_touches(spark, [(1, 1, False)]), customers)
    assert marts.channel_performance(spend).first().cost_per_conversion is None
    row = roi.cac_gap(spend).first()
    assert row.blended_cac is None and row.pct_underestimate is None and row.conversions == 0


def test_credit_risk_default_rate_is_zero_without_approvals(spark):
    ddl = (
        "application_id string, customer_id bigint, application_date date, requested_amount double,"
        " approval_status string, loan_amount double, interest_rate double, loan_term_months int,"
        " default_flag boolean, purpose string, is_requested_amount_outlier boolean,"
        " is_loan_amount_outlier boolean, data_quality_score double"
    )
    rows = [
        ("a", 1, D(2024, 2, 1), 10.0, "Declined", 0.0, None, 12, False, "p", False, False, 1.0),
        ("b", 1, D(2024, 2, 1), 10.0, "Approved", 8.0, 5.0, 12, True, "p", False, False, 1.0),
        ("c", 1, D(2024, 2, 1), 10.0, "Approved", 8.0, 5.0, 12, None, "p", False, False, 1.0),
    ]
    customers = _customers(spark, [(1, "Email", D(2024, 1, 1), 700, 1.0)])
    mart = marts.credit_risk(facts.loans(spark.createDataFrame(rows, ddl), customers))
    out = {r.approval_status: r for r in mart.collect()}
    assert out["Declined"].default_rate_pct == 0.0 and out["Approved"].default_rate_pct == 50.0
    assert out["Approved"].avg_annual_interest == 0.4 and out["Approved"].avg_amount_gap == 2.0
    assert out["Declined"].avg_interest_rate is None and out["Approved"].avg_days_to_application == 31


def test_cohorts(spark):
    customers = _customers(
        spark,
        [(1, "Email", D(2024, 1, 31), 1, 1.0), (2, "Email", D(2024, 1, 1), 1, 1.0),
         (3, "Email", D(2024, 1, 5), 1, 1.0)],
    )
    txns = _txns(
        spark,
        [
            (1, 1, D(2024, 2, 1), 10.0, "Completed"), (2, 1, D(2024, 2, 2), 5.0, "Completed"),
            (3, 2, D(2024, 2, 3), 4.0, "Completed"), (4, 2, D(2023, 12, 30), 9.0, "Completed"),
            (5, 2, D(2024, 3, 3), 9.0, "Failed"),
        ],
    )
    (row,) = marts.cohort(customers, facts.clean_transactions(txns)).collect()
    assert (row.cohort_month, row.months_since_signup, row.active_customers) == ("2024-01", 1, 2)
    assert (row.total_transactions, row.total_spend, row.avg_spend_per_customer) == (3, 19.0, 9.5)


def test_retention_days(spark):
    day = D(2024, 1, 1)
    customers = _customers(spark, [(i, "Email", day, 1, 1.0) for i in range(1, 6)])
    after = {1: 0, 2: 30, 3: 31, 4: 90}
    rows = [(i, i, day + dt.timedelta(days=n), 1.0, "Completed") for i, n in after.items()]
    rows.append((9, 5, D(2024, 1, 3), 1.0, "Failed"))
    txns = facts.clean_transactions(_txns(spark, rows))
    (row,) = roi.retention(customers, txns).collect()
    assert (row.cohort_size, row.retained_30d, row.retained_60d, row.retained_90d) == (5, 1, 2, 3)
    assert row.retention_rate_90d == 60.0
    (row,) = roi.retention(customers, txns, by="acquisition_channel").collect()
    assert (row.cohort_size, row.retention_30d_pct) == (5, 20.0)
