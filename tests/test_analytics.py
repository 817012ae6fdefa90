"""Business questions on hand-made facts."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.plans import analytics, views

D = Decimal


def day(n, month=1, year=2024):
    return datetime(year, month, n, 10)


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame(
        [(1, "A", "checking"), (2, "B", "savings"), (3, "C", "savings"), (-1, "-1", "unknown")],
        "account_key bigint, account_id string, product_type string",
    )


def make_fact(spark, rows):
    """Rows of (account_key, customer_key, ts, amount, fraud)."""
    cells = [
        (f"t{i:03d}", a, c, 1, D(str(m)), ts, ts.year * 10000 + ts.month * 100 + ts.day, "online", fraud)
        for i, (a, c, ts, m, fraud) in enumerate(rows)
    ]
    return spark.createDataFrame(
        cells,
        "transaction_id string, account_key bigint, customer_key bigint, merchant_category_key bigint, "
        "amount decimal(16,2), transaction_ts timestamp, date_key int, channel string, is_fraud boolean",
    )


@pytest.fixture(scope="module")
def t(spark):
    return make_fact(
        spark,
        [
            (1, 1, day(1), 100, False),
            (1, 1, day(2), 200, False),
            (1, 1, day(3), 300, True),
            (2, 2, day(1), 50, False),
            (2, 2, day(2), 50, False),
        ],
    )


def test_running_total_restarts_per_account_and_lag_starts_null(t, accounts):
    rows = analytics.running_balance(t, accounts).orderBy("account_id", "full_date").collect()
    assert [(r.account_id, int(r.running_total), r.prior_amount) for r in rows] == [
        ("A", 100, None),
        ("A", 300, D(100)),
        ("A", 600, D(200)),
        ("B", 50, None),
        ("B", 100, D(50)),
    ]


def test_windows_keep_rows_and_groups_collapse(t):
    row = analytics.window_row_count(t).first()
    assert (row.fact_rows, row.windowed_rows, row.groups) == (5, 5, 2)


def test_ranks_differ_on_ties(t, accounts):
    rows = analytics.ranking_ties(t, accounts).where("account_id = 'B'").collect()
    assert sorted(r.amount_row_number for r in rows) == [1, 2]
    assert {(r.amount_rank, r.amount_dense_rank) for r in rows} == {(1, 1)}


def test_last_value_needs_the_whole_frame(t, accounts):
    row = analytics.last_value_frames(t, accounts).where("transaction_id = 't000'").first()
    assert (row.default_frame_last, row.full_frame_last) == (D(100), D(300))


def test_window_tour_limit_is_a_prefix_of_the_whole(t, accounts):
    order = ["account_id", "transaction_ts", "transaction_id"]
    whole = analytics.window_tour(t, accounts, limit=None).orderBy(*order).collect()
    for n in (1, 3, 4, 20):
        assert analytics.window_tour(t, accounts, limit=n).collect() == whole[:n]
    first = whole[0]
    assert (first.next_amount, first.first_txn_amount, first.last_txn_amount) == (D(200), D(100), D(300))
    assert (float(whole[2].moving_avg_7), float(whole[2].pct_of_account_total)) == (200.0, 50.0)
    assert [r.amount_quartile for r in whole[:3]] == [1, 2, 3]


def test_not_in_with_null_keeps_nothing(spark):
    values = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")

    def kept(*members):
        excluded = spark.createDataFrame([(m,) for m in members], "y int")
        return sorted(r.x or 0 for r in analytics.not_in(values, "x", excluded, "y").collect())

    assert kept(2, None) == []
    assert kept(2) == [1, 3]
    assert kept() == [0, 1, 2, 3]


def test_islands(spark, accounts):
    fact = make_fact(spark, [(1, 1, day(n), 1, False) for n in (1, 2, 3, 3, 7, 8)])
    rows = analytics.activity_streaks(fact, accounts, min_days=1).collect()
    assert [(r.streak_start, r.streak_end, r.consecutive_days, r.span_check) for r in rows] == [
        (date(2024, 1, 1), date(2024, 1, 3), 3, 3),
        (date(2024, 1, 7), date(2024, 1, 8), 2, 2),
    ]
    assert analytics.activity_streaks(fact, accounts).count() == 0
    gaps = analytics.inactivity_gaps(fact, accounts, 3).collect()
    assert [(g.last_active, g.active_again, g.idle_days) for g in gaps] == [(date(2024, 1, 3), date(2024, 1, 7), 3)]


def test_dormant_accounts_include_the_never_used(t, accounts):
    rows = analytics.dormant_accounts(t, accounts, date(2024, 1, 12), 10).collect()
    assert {(r.account_id, r.idle_days) for r in rows} == {("B", 10), ("C", None)}


def test_filter_equals_case(t):
    row = analytics.filter_vs_case(t, 100).first()
    assert row.filter_count == row.case_count == 2
    assert row.filter_sum == row.case_sum == D(500)


def customers_of(spark, rows):
    return spark.createDataFrame(
        [(k, i, s, s, True, j) for k, i, s, j in rows],
        "customer_key bigint, customer_id string, full_name string, segment string, is_current boolean, join_date date",
    )


@pytest.fixture(scope="module")
def people(spark):
    joined = date(2024, 1, 15)
    return customers_of(spark, [(1, "c1", "mass", joined), (2, "c2", "mass", joined), (-1, "-1", None, None)])


def test_percentiles_on_skewed_amounts(spark, people):
    fact = make_fact(spark, [(1, 1, day(1), m, False) for m in (10, 10, 10, 10, 1000)])
    row = analytics.amount_percentiles(fact, people).first()
    assert row.mean > row.median
    assert (row.n, float(row.mean), float(row.median), float(row.p90), row.max) == (5, 208.0, 10.0, 604.0, D(1000))
    assert analytics.amount_percentile_disc(fact, people).first().p90 == D(1000)
    assert analytics.amount_percentiles(fact, people, approx=True).first().median == D(10)


def test_summary_without_fraud_has_null_fraud_amount(spark, people):
    fact = make_fact(spark, [(1, 1, day(1), 5, False), (1, 2, day(2), 6, False), (1, 2, day(3), 7, False)])
    categories = spark.createDataFrame([(1, "Grocery")], "merchant_category_key bigint, category_name string")
    row = views.mv_monthly_transaction_summary(fact, people, categories).first()
    assert (row.transaction_count, row.total_amount, float(row.avg_amount)) == (3, D(18), 6.0)
    assert (row.fraud_count, row.fraud_amount, row.distinct_customers) == (0, None, 2)


def test_growth_skips_missing_months_unless_strict(spark, people):
    fact = make_fact(
        spark,
        [(1, 1, day(1, 1), 100, False), (1, 1, day(1, 2), 150, False), (1, 1, day(1, 4), 75, False), (1, 1, day(1, 5), 0, False), (1, 1, day(1, 6), 9, False)],
    )
    loose = analytics.monthly_growth(fact, people).collect()
    assert [r.mom_growth_pct and float(r.mom_growth_pct) for r in loose] == [None, 50.0, -50.0, -100.0, None]
    strict = analytics.monthly_growth(fact, people, strict_calendar=True).collect()
    assert [r.prior_month for r in strict] == [None, D(100), None, D(75), D(0)]


def test_top_customers_and_first_last(spark, people):
    fact = make_fact(
        spark,
        [(1, 1, day(1), 100, False), (1, 2, day(2), 40, False), (1, 2, day(9), 50, False), (1, -1, day(5), 999, False)],
    )
    top = analytics.top_customers_per_segment(fact, people, n=1).collect()
    assert [(r.customer_id, r.total_spend, r.rank_in_segment) for r in top] == [("c1", D(100), 1)]
    spans = analytics.first_last_txn(fact, people).collect()
    assert [(r.customer_id, r.days_active, r.total_txns) for r in spans] == [("c2", 7, 2), ("c1", 0, 1)]


def test_cohort_size_counts_active_customers_only(spark, people):
    fact = make_fact(
        spark,
        [(1, 1, day(20, 1), 1, False), (1, 1, day(21, 1), 1, False), (1, 1, day(1, 3), 1, False), (1, 2, day(1, 3), 1, False), (1, 2, day(1, 3, 2026), 1, False)],
    )
    rows = analytics.cohort_retention(fact, people).collect()
    assert [(r.cohort_size, r.month_offset, r.active_customers, float(r.retention_pct)) for r in rows] == [
        (2, 0, 1, 50.0),
        (2, 2, 2, 100.0),
    ]


def test_third_highest_keeps_ties(spark, accounts):
    fact = make_fact(
        spark,
        [(1, 1, day(1), m, False) for m in (9, 9, 8, 7, 7, 7, 6)] + [(2, 1, day(1), m, False) for m in (5, 4)],
    )
    rows = analytics.third_highest_amount(fact, accounts).collect()
    assert [(r.account_id, r.amount, r.dense_rank) for r in rows] == [("A", D(7), 3)] * 3
    assert analytics.third_highest_amount(fact, accounts, limit=2).count() == 2
    assert analytics.third_highest_amount(fact, accounts, limit=None).count() == 3


def test_third_highest_reads_the_fact_once(spark, accounts, tmp_path, monkeypatch):
    """All ties come back, in pieces; amounts of NULL have a rank but no row."""
    monkeypatch.setattr(analytics, "TIES", 4, raising=False)
    rows = [(1, 1, day(1), m, False) for m in (9, 8, 8, *[7] * 13, 6)] + [(2, 1, day(1), m, False) for m in (5, 4, 3)]
    fact = make_fact(spark, rows).withColumn("amount", F.when(F.col("amount") != 3, F.col("amount")))
    fact.write.parquet(str(tmp_path / "fact"))
    answer = analytics.third_highest_amount(spark.read.parquet(str(tmp_path / "fact")), accounts)
    assert [(r.account_id, r.amount, r.dense_rank) for r in answer.collect()] == [("A", D(7), 3)] * 13
    assert answer._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_accounts_without_fraud(t, accounts):
    rows = analytics.accounts_without_fraud(t, accounts).collect()
    assert [r.account_id for r in rows] == ["B", "C"]


def loan_months(spark, rows):
    return spark.createDataFrame(
        [(loan, key, bucket, D(balance), bucket == "90+") for loan, key, bucket, balance in rows],
        "loan_id string, date_key int, delinquency_bucket string, outstanding_balance decimal(16,2), is_defaulted boolean",
    )


def test_roll_rate(spark):
    fact = loan_months(
        spark,
        [("a", 20240131, "30-59", 100), ("a", 20240229, "60-89", 90), ("b", 20240131, "30-59", 50), ("b", 20240229, "current", 40), ("c", 20240229, "current", 5), ("b", 20240430, "30-59", 40)],
    )
    rows = analytics.delinquency_roll_rate(fact).collect()
    got = [(r.month, r.from_bucket, r.to_bucket, r.loan_count, r.balance_at_risk, float(r.roll_rate_pct)) for r in rows]
    assert got == [
        (2, "30-59", "60-89", 1, D(100), 50.0),
        (2, "30-59", "current", 1, D(50), 50.0),
        (4, "current", "30-59", 1, D(40), 100.0),
    ]
    assert analytics.delinquency_roll_rate(fact, strict_calendar=True).count() == 2


def test_vintages(spark):
    loans = spark.createDataFrame(
        [(f"l{i}", day_, D(100), score, bad) for i, (day_, score, bad) in enumerate(
            [(date(2023, 11, 5), 700, True), (date(2023, 12, 5), 600, False), (date(2024, 1, 5), 500, False)])],
        "loan_id string, origination_date date, principal decimal(16,2), credit_score_at_origination int, defaulted boolean",
    )
    first, second = analytics.vintage_analysis(loans).collect()
    assert (first.vintage_quarter, float(first.default_rate_pct), first.prior_vintage_default_rate) == (4, 50.0, None)
    assert (float(second.default_rate_change), float(second.score_change)) == (-50.0, -150.0)
    months = loan_months(
        spark,
        [("l0", 20231130, "current", 1), ("l0", 20231231, "90+", 1), ("l0", 20240131, "90+", 1), ("l1", 20231231, "current", 1), ("l2", 20240131, "current", 1)],
    )
    curve = analytics.vintage_curve(months, loans).orderBy("vintage_year", "months_on_book").collect()
    assert [(r.vintage_year, r.months_on_book, r.loans, r.cumulative_defaults) for r in curve] == [
        (2023, 0, 2, 0),
        (2023, 1, 2, 1),
        (2023, 2, 2, 1),
        (2024, 0, 1, 0),
    ]


def test_fraud_lookup(t):
    row = analytics.fraud_lookup(t, 20240101, 20240331).first()
    assert row["count"] == 1 and row.sum_amount == D(300)
    assert analytics.fraud_lookup(t, 20250101, 20250331).first().sum_amount is None


def test_latest_and_monthly_volume(t, accounts):
    latest = {r.account_id: r.amount for r in analytics.latest_txn_per_account(t, accounts).collect()}
    assert latest == {"A": D(300), "B": D(50)}
    row = analytics.monthly_volume(t).first()
    assert (row.txn_count, row.total_amount, row.min_amount, row.max_amount, row.avg_amount) == (
        5, D(700), D(50), D(300), D(140))


def test_dedup_keeps_the_first_in_order(spark):
    df = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3)], "id string, n int")
    rows = analytics.dedup_transactions(df, ["id"], [F.col("n")], ["id", "n"]).collect()
    assert sorted(map(tuple, rows)) == [("x", 1), ("y", 3)]
