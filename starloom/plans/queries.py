"""Every operator as a query over the sample tables: name -> f(spark, sf_dir) -> DataFrame.

Surrogate keys and load stamps are left out of the results (an independent engine cannot repeat
them); natural keys and validity dates stand in. Rounded ratios are shown as doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import attributes
from starloom.functions.keys import UNKNOWN_KEY
from starloom.operators import dimensions, facts, history, quality
from starloom.plans import analytics, load, views
from starloom.session import bound_tasks, use_utc
from starloom.sources import sample
from starloom.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONEY = "decimal(38,2)"
BALANCES_END = date(2024, 2, 10)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        bound_tasks(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Show UTC timestamps without a zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _events(spark: SparkSession, sf_dir: str) -> sample.Star:
    return sample.star(spark, sf_dir, "events")


def _lineitem(spark: SparkSession, sf_dir: str) -> sample.Star:
    return sample.star(spark, sf_dir, "lineitem")


def _with_natural_keys(fact: DataFrame, star: sample.Star) -> DataFrame:
    """Replace the fact's surrogate keys by natural keys and the version's first day."""
    account = star.accounts.select("account_key", "account_id")
    version = star.customers.select(
        "customer_key", "customer_id", F.col("valid_from").alias("customer_from")
    )
    category = star.categories.select("merchant_category_key", "category_code")
    return (
        fact.join(account, "account_key")
        .join(version, "customer_key")
        .join(category, "merchant_category_key")
    )


CUSTOMER_COLUMNS = [
    "customer_id",
    "full_name",
    "age",
    "annual_income",
    "credit_score",
    "credit_band",
    "dti",
    "segment",
    "join_date",
    "home_branch_id",
    "valid_from",
    "valid_to",
    "is_current",
    "row_hash",
]
ACCOUNT_COLUMNS = [
    "account_id",
    "customer_id",
    "product_type",
    "product_family",
    "apr",
    "open_date",
    "status",
    "initial_balance",
]
FACT_COLUMNS = [
    "transaction_id",
    "date_key",
    "account_id",
    "customer_id",
    "customer_from",
    "category_code",
    "amount",
    "transaction_ts",
    "hour_of_day",
    "channel",
    "is_fraud",
    "load_id",
]


# --- sources, sinks, merges ---------------------------------------------------------------------


@query
def stage_transactions(spark, sf_dir):
    return _wall_clock(sample.lineitem_transactions(spark, sf_dir), "timestamp")


@query
def dim_date(spark, sf_dir):
    return dimensions.dim_date_spanning(
        sample.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")), "day"
    )


def _seen_categories(spark, sf_dir) -> DataFrame:
    """A category dimension as late arrivals would leave it: the codes of the staged events."""
    staged = sample.event_transactions(spark, sf_dir)
    return staged.groupBy(F.col("merchant_category").alias("category_code")).agg(
        F.lit("late arrival").alias("category_name"),
        F.lit(False).alias("is_discretionary"),
        F.lit("high").alias("fraud_risk_tier"),
    )


@query
def seed_merchant_category(spark, sf_dir):
    return dimensions.seed_merchant_category(_seen_categories(spark, sf_dir))


@query
def seed_loan_product(spark, sf_dir):
    seen = (
        sample.loans(spark, sf_dir)
        .groupBy("loan_type")
        .agg(
            F.lit("late arrival").alias("product_name"),
            F.max(F.lit(False)).alias("is_secured"),
            F.max("term_months").cast("smallint").alias("typical_term_months"),
        )
    )
    return dimensions.seed_loan_product(seen)


@query
def merge_dim_branch(spark, sf_dir):
    dim = dimensions.unknown_branch(spark)
    for shift in (0, 5):
        dim = dimensions.merge_dim_branch(dim, sample.branches(spark, sf_dir, shift))
    return dim.select("branch_id", "branch_name", "city", "state", "region", "opened_date")


@query
def branch_region(spark, sf_dir):
    rows = sample.branches(spark, sf_dir)
    return rows.select(
        "branch_id", "state", attributes.branch_region(F.col("state")).alias("region")
    )


@query
def merge_dim_account(spark, sf_dir):
    dim = sample.dim_account(spark, sf_dir)
    merged = dimensions.merge_dim_account(dim, sample.accounts_update(spark, sf_dir))
    return merged.select(*ACCOUNT_COLUMNS)


@query
def customer_row_hash(spark, sf_dir):
    rows = history.incoming_customers(sample.customers(spark, sf_dir, 1))
    return rows.select("customer_id", "row_hash")


@query
def credit_band(spark, sf_dir):
    rows = sample.customers(spark, sf_dir, 1)
    band = attributes.credit_band(F.col("credit_score"))
    return rows.groupBy(band.alias("credit_band")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("credit_score").alias("lowest_score"),
        F.max("credit_score").alias("highest_score"),
    )


def _history(spark, sf_dir, batches) -> Store:
    """A published customer history after some merges; each read and wrote the open versions only."""
    store = sample.new_store(spark, "history")
    sample.write_customers(store, sf_dir, "events", batches)
    return store


@query
def scd2_merge_initial(spark, sf_dir):
    return _history(spark, sf_dir, 1).read("dim_customer").select(*CUSTOMER_COLUMNS)


@query
def scd2_merge_noop(spark, sf_dir):
    store = _history(spark, sf_dir, 2)
    again = history.merge_dim_customer(
        store.read_open("dim_customer"), sample.customers(spark, sf_dir, 2), date(2024, 1, 15)
    )
    store.write_history("dim_customer", again)
    return store.read("dim_customer").select(*CUSTOMER_COLUMNS)


@query
def scd2_merge_change(spark, sf_dir):
    return _history(spark, sf_dir, 3).read("dim_customer").select(*CUSTOMER_COLUMNS)


@query
def unknown_members(spark, sf_dir):
    star = _events(spark, sf_dir)
    branches = dimensions.merge_dim_branch(
        dimensions.unknown_branch(spark), sample.branches(spark, sf_dir)
    )
    return quality.unknown_members(
        {
            "dim_customer": (star.customers, "customer_key", "customer_id"),
            "dim_account": (star.accounts, "account_key", "account_id"),
            "dim_branch": (branches, "branch_key", "branch_id"),
            "dim_merchant_category": (star.categories, "merchant_category_key", "category_code"),
            "dim_loan_product": (star.products, "loan_product_key", "loan_type"),
        }
    )


@query
def surrogate_keys(spark, sf_dir):
    """Rows and distinct surrogate keys of each dimension; the two must agree."""
    star = _events(spark, sf_dir)
    keyed = star.customers.select(
        F.lit("dim_customer").alias("dimension"), F.col("customer_key").alias("key")
    ).unionByName(
        star.accounts.select(F.lit("dim_account").alias("dimension"), F.col("account_key").alias("key"))
    )
    return keyed.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("members"), F.countDistinct("key").alias("distinct_keys")
    )


@query
def load_report(spark, sf_dir):
    star = _events(spark, sf_dir)
    return load.load_report(
        {
            "stg_transactions": star.staged,
            "dim_date": star.dates,
            "dim_customer": star.customers,
            "dim_account": star.accounts,
            "dim_merchant_category": star.categories,
            "fact_transactions": star.fact,
        }
    )


# --- facts --------------------------------------------------------------------------------------


@query
def fact_transactions(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    rows = _with_natural_keys(star.load_fact(load_id=1), star).select(*FACT_COLUMNS)
    return _wall_clock(rows, "transaction_ts")


def _before(staged: DataFrame, day: str) -> DataFrame:
    return staged.where(F.col("timestamp") < F.lit(day).cast("timestamp"))


@query
def fact_incremental_append(spark, sf_dir):
    """A second load over everything staged, after one that saw the days before the 16th."""
    star = _events(spark, sf_dir)
    store = star.warehouse()
    load.append_transactions(store, _before(star.staged, "2024-01-16"), 1)
    load.append_transactions(store, star.staged, 2)
    second = store.read_loads("fact_transactions", after=1)
    return _wall_clock(_with_natural_keys(second, star).select(*FACT_COLUMNS), "transaction_ts")


@query
def load_accounting(spark, sf_dir):
    """What became of every staged row in two loads: a calendar that ends early, rows staged twice, rows loaded before."""
    star = _events(spark, sf_dir)
    store = star.warehouse(star.dates.where("full_date <= DATE'2024-01-25'"))
    twice = star.staged.where("is_fraud")
    for n, batch in enumerate([_before(star.staged, "2024-01-16"), star.staged], start=1):
        load.append_transactions(store, batch.unionByName(twice), n)
    return store.read("load_history").select("load_id", "outcome", "rows")


def _in_two_loads(star, name: str, refresh) -> DataFrame:
    """A table refreshed after each of two loads, the second with late rows of months that the first has touched."""
    store = star.warehouse()
    late = F.substring("transaction_id", -1, 1) == "3"
    for n, batch in enumerate([_before(star.staged, "1998-01-01").where(~late), star.staged], start=1):
        load.append_transactions(store, batch, n)
        refresh(store)
    return store.read(name)


@query
def monthly_summary_refreshed(spark, sf_dir):
    """The monthly summary after load, refresh, load, refresh, where the second replaces the touched months only."""
    return _double(_in_two_loads(_lineitem(spark, sf_dir), "mv_monthly_transaction_summary", load.refresh_monthly_summary), "avg_amount")


@query
def fraud_days_refreshed(spark, sf_dir):
    return _in_two_loads(_lineitem(spark, sf_dir), "fact_fraud_daily", load.refresh_fraud_days)


@query
def daily_balances_published(spark, sf_dir):
    """Balances published three times: part of the data, late rows that reopen their month, and a period carried on."""
    star = _events(spark, sf_dir)
    store = star.warehouse()
    late = F.substring("transaction_id", -1, 1) == "3"
    load.append_transactions(store, _before(star.staged, "2024-01-16").where(~late), 1)
    load.publish_daily_balances(store, date(2024, 1, 20))
    load.append_transactions(store, star.staged, 2)
    load.publish_daily_balances(store, date(2024, 1, 31))
    load.publish_daily_balances(store, BALANCES_END)
    return _named_balances(store.read("fact_daily_balances"), star)


@query
def unknown_member_fallback(spark, sf_dir):
    """Rows and money by which of account, customer and category could be looked up."""
    fact = _lineitem(spark, sf_dir).fact
    unknown = {
        c: F.col(f"{c}_key") == UNKNOWN_KEY for c in ("account", "customer", "merchant_category")
    }
    return fact.groupBy(*[u.alias(f"unknown_{c}") for c, u in unknown.items()]).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast(MONEY).alias("amount")
    )


@query
def point_in_time_join(spark, sf_dir):
    """Each event with the segment its user had on that day."""
    users = sample.event_transactions(spark, sf_dir).withColumn(
        "customer_id", F.regexp_replace("account_id", "^ACC_", "CUST_")
    )
    joined = history.point_in_time_join(
        users.select("transaction_id", F.col("customer_id").alias("user_id"), "timestamp", "amount"),
        _events(spark, sf_dir).customers,
        "user_id",
        F.to_date("timestamp"),
        ["segment", "credit_band", "valid_from"],
    )
    return _wall_clock(joined, "timestamp")


@query
def fact_daily_balances(spark, sf_dir):
    star = _events(spark, sf_dir)
    return _named_balances(facts.fact_daily_balances(star.fact, star.accounts, star.customers, BALANCES_END), star)


def _named_balances(balances: DataFrame, star: sample.Star) -> DataFrame:
    named = balances.join(star.accounts.select("account_key", "account_id"), "account_key").join(
        star.customers.select(
            "customer_key",
            F.col("customer_id").alias("owner_id"),
            F.col("valid_from").alias("owner_from"),
        ),
        "customer_key",
    )
    return named.select(
        "date_key",
        "account_id",
        "owner_id",
        "owner_from",
        "closing_balance",
        "total_debits",
        "total_credits",
        "transaction_count",
    )


@query
def fact_loan_monthly(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    products = star.products.select("loan_product_key", "loan_type")
    return (
        star.load_loan_months()
        .join(products, "loan_product_key")
        .join(
            star.customers.select(
                "customer_key", "customer_id", F.col("valid_from").alias("customer_from")
            ),
            "customer_key",
        )
        .select(
            "date_key",
            "loan_id",
            "customer_id",
            "customer_from",
            "loan_type",
            "outstanding_balance",
            "scheduled_payment",
            "principal_paid",
            "interest_paid",
            "days_past_due",
            "delinquency_bucket",
            "is_defaulted",
        )
    )


@query
def dpd_bucket(spark, sf_dir):
    rows = sample.loan_snapshots(spark, sf_dir)
    bucket = attributes.delinquency_bucket(F.col("days_past_due"))
    return rows.groupBy(bucket.alias("delinquency_bucket")).agg(
        F.count(F.lit(1)).alias("loan_months"),
        F.min("days_past_due").alias("lowest_dpd"),
        F.max("days_past_due").alias("highest_dpd"),
    )


# --- views and lookups --------------------------------------------------------------------------


@query
def v_current_customers(spark, sf_dir):
    return views.v_current_customers(_events(spark, sf_dir).customers).drop(
        "customer_key"
    )


@query
def v_customer_history(spark, sf_dir):
    return views.v_customer_history(_events(spark, sf_dir).customers).drop(
        "customer_key"
    )


@query
def v_transaction_enriched(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    flat = views.v_transaction_enriched(
        star.fact, star.dates, star.accounts, star.customers, star.categories
    )
    return _wall_clock(flat, "transaction_ts")


@query
def mv_monthly_transaction_summary(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    summary = views.mv_monthly_transaction_summary(star.fact, star.customers, star.categories)
    return _double(summary, "avg_amount")


@query
def point_in_time_customer(spark, sf_dir):
    """Every customer's profile as of a day between the second and third batch."""
    return history.point_in_time_customer(_events(spark, sf_dir).customers, date(2024, 1, 15))


@query
def fraud_lookup(spark, sf_dir):
    """From the published days; ``fraud_lookup_scan`` reads the transactions."""
    days = _lineitem(spark, sf_dir).fraud_days(199701, 199703)
    return analytics.fraud_lookup_by_day(days, 19970101, 19970331)


@query
def fraud_lookup_scan(spark, sf_dir):
    return analytics.fraud_lookup(_lineitem(spark, sf_dir).fact, 19970101, 19970331)


# --- aggregates ---------------------------------------------------------------------------------


@query
def monthly_volume(spark, sf_dir):
    return _double(analytics.monthly_volume(_lineitem(spark, sf_dir).fact), "avg_amount")


@query
def fraud_rate_by_category(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return _double(
        analytics.fraud_rate_by_category(star.fact, star.categories),
        "fraud_rate_pct",
        "avg_fraud_amount",
        "avg_normal_amount",
    )


@query
def channel_pivot(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return _double(
        analytics.channel_pivot(star.fact, star.customers),
        "pct_online",
        "avg_online_amt",
        "avg_in_person_amt",
    )


@query
def filter_vs_case(spark, sf_dir):
    return analytics.filter_vs_case(_events(spark, sf_dir).fact, 100)


@query
def amount_percentiles(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return _double(
        analytics.amount_percentiles(star.fact, star.customers), "mean", "median", "p90", "p99"
    )


@query
def amount_percentile_disc(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.amount_percentile_disc(star.fact, star.customers)


# --- windows ------------------------------------------------------------------------------------


@query
def running_balance(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.running_balance(star.fact, star.accounts, points=star.window_points)


@query
def window_tour(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    tour = analytics.window_tour(star.fact, star.accounts, limit=None, points=star.window_points)
    return _wall_clock(_double(tour, "moving_avg_7", "pct_of_account_total"), "transaction_ts")


@query
def window_tour_report(spark, sf_dir):
    """The first twenty rows, as the report shows them."""
    star = _lineitem(spark, sf_dir)
    tour = analytics.window_tour(star.fact, star.accounts, limit=20, points=star.window_points)
    return _wall_clock(_double(tour, "moving_avg_7", "pct_of_account_total"), "transaction_ts")


@query
def ranking_ties(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.ranking_ties(star.fact, star.accounts, points=star.window_points)


@query
def last_value_frames(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.last_value_frames(star.fact, star.accounts, points=star.window_points)


@query
def window_row_count(spark, sf_dir):
    star = _events(spark, sf_dir)
    return analytics.window_row_count(star.fact, points=star.window_points)


# --- customers ----------------------------------------------------------------------------------


@query
def monthly_growth(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return _double(analytics.monthly_growth(star.fact, star.customers), "mom_growth_pct")


@query
def top_customers_per_segment(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.top_customers_per_segment(star.fact, star.customers)


@query
def segment_migration(spark, sf_dir):
    return analytics.segment_migration(_lineitem(spark, sf_dir).customers)


@query
def first_last_txn(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    report = analytics.first_last_txn(star.fact, star.customers)
    return _wall_clock(report, "first_txn", "last_txn")


@query
def cohort_retention(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    cohorts = analytics.cohort_retention(star.fact, star.customers, limit=None)
    return _double(cohorts, "retention_pct")


@query
def cohort_retention_by_id(spark, sf_dir):
    """Activity under every version of a customer, not only the current one."""
    star = _lineitem(spark, sf_dir)
    cohorts = analytics.cohort_retention(star.fact, star.customers, limit=None, by="customer_id")
    return _double(cohorts, "retention_pct")


# --- accounts -----------------------------------------------------------------------------------


@query
def third_highest_amount(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.third_highest_amount(star.fact, star.accounts, limit=None)


@query
def dedup_transactions(spark, sf_dir):
    staged = sample.lineitem_transactions(spark, sf_dir)
    kept = analytics.dedup_transactions(
        staged,
        ["transaction_id"],
        facts.TRANSACTION_ORDER,
        ["transaction_id", "account_id", "amount", "timestamp"],
    )
    return _wall_clock(kept, "timestamp")


@query
def latest_txn_per_account(spark, sf_dir):
    star = _events(spark, sf_dir)
    latest = analytics.latest_txn_per_account(star.fact, star.accounts)
    return _wall_clock(latest, "transaction_ts")


@query
def accounts_without_fraud(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.accounts_without_fraud(star.fact, star.accounts, limit=None)


@query
def not_in_null_trap(spark, sf_dir):
    """Customers outside a set, by NOT IN and by anti join; a NULL in the set empties the former."""
    people = sample.customers(spark, sf_dir, 1).select("customer_id", "credit_score")
    defaulted = sample.loans(spark, sf_dir).where("defaulted").select("credit_score_at_origination")
    with_null = people.select("credit_score")
    cases = {
        "not_in_with_null": analytics.not_in(people, "credit_score", with_null, "credit_score"),
        "not_in_without_null": analytics.not_in(
            people, "credit_score", defaulted, "credit_score_at_origination"
        ),
        "anti_join": people.join(
            defaulted.withColumnRenamed("credit_score_at_origination", "credit_score").distinct(),
            "credit_score",
            "left_anti",
        ),
    }
    return load.load_report(cases).withColumnRenamed("step", "form")


@query
def daily_activity(spark, sf_dir):
    star = _events(spark, sf_dir)
    days = analytics.daily_activity(star.fact)
    return days.join(star.accounts.select("account_key", "account_id"), "account_key").select(
        "account_id", "full_date"
    )


@query
def activity_streaks(spark, sf_dir):
    star = _events(spark, sf_dir)
    return analytics.activity_streaks(star.fact, star.accounts)


@query
def inactivity_gaps(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.inactivity_gaps(star.fact, star.accounts, 90)


@query
def dormant_accounts(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    return analytics.dormant_accounts(star.fact, star.accounts, date(2001, 12, 31), 180)


# --- loans --------------------------------------------------------------------------------------


@query
def delinquency_roll_rate(spark, sf_dir):
    return _double(analytics.delinquency_roll_rate(_lineitem(spark, sf_dir).loan_months), "roll_rate_pct")


@query
def vintage_analysis(spark, sf_dir):
    return _double(
        analytics.vintage_analysis(sample.loans(spark, sf_dir)),
        "avg_score_at_origination",
        "default_rate_pct",
        "prior_vintage_default_rate",
        "default_rate_change",
        "score_change",
    )


@query
def vintage_curve(spark, sf_dir):
    curve = analytics.vintage_curve(_lineitem(spark, sf_dir).loan_months, sample.loans(spark, sf_dir))
    return _double(curve, "cumulative_default_pct")


# --- quality checks: run on data that breaks the rule, so that an answer is expected -------------


def _unclosed_versions(spark, sf_dir) -> DataFrame:
    """What appending batches without closing versions would leave behind."""
    batches = [
        history.incoming_customers(sample.customers(spark, sf_dir, n)).withColumns(
            {
                "valid_from": F.lit(effective).cast("date"),
                "valid_to": F.lit("9999-12-31").cast("date"),
                "is_current": F.lit(True),
            }
        )
        for n, effective in enumerate(sample.EFFECTIVE_DATES["events"], start=1)
    ]
    changed = [
        now.join(before.select("customer_id", "row_hash"), ["customer_id", "row_hash"], "left_anti")
        for before, now in zip(batches, batches[1:], strict=False)
    ]
    return reduce(DataFrame.unionByName, changed, batches[0])


@query
def check_one_current(spark, sf_dir):
    return quality.check_one_current(_unclosed_versions(spark, sf_dir))


@query
def check_scd2_overlap(spark, sf_dir):
    return quality.check_scd2_overlap(_unclosed_versions(spark, sf_dir))


@query
def check_validity_order(spark, sf_dir):
    """Versions cut off at the customer's joining date, which for many lies before their start."""
    cut = _lineitem(spark, sf_dir).customers.withColumn(
        "valid_to", F.least("valid_to", "join_date")
    )
    return quality.check_validity_order(cut)


@query
def check_pit_unique(spark, sf_dir):
    staged = sample.event_transactions(spark, sf_dir).select(
        F.regexp_replace("account_id", "^ACC_", "CUST_").alias("user_id"),
        F.to_date("timestamp").alias("event_day"),
    )
    return quality.check_pit_unique(
        _unclosed_versions(spark, sf_dir), staged, "user_id", "event_day"
    )


@query
def check_fact_grain(spark, sf_dir):
    """Transaction ids staged more than once."""
    return quality.check_unique(sample.lineitem_transactions(spark, sf_dir), ["transaction_id"])


@query
def check_foreign_keys(spark, sf_dir):
    star = _lineitem(spark, sf_dir)
    staged = star.staged.withColumn("transaction_date", F.to_date("timestamp"))
    return quality.check_foreign_keys(
        staged,
        {
            "account_id": (star.accounts, "account_id"),
            "merchant_category": (star.categories, "category_code"),
            "transaction_date": (star.dates, "full_date"),
        },
    )


def _day() -> Column:
    return F.col("date_key") % 100


@query
def check_fact_constraints(spark, sf_dir):
    """All constraints of the three facts on rows broken by their day: empty columns, keys nobody has, rows twice."""
    star, events = _lineitem(spark, sf_dir), _events(spark, sf_dir)
    facts_of = {
        "fact_transactions": (star.fact, {"channel": 15, "customer_key": 16}, {"date_key": 17, "account_key": 19}, 18),
        "fact_daily_balances": (
            facts.fact_daily_balances(events.fact, events.accounts, events.customers, BALANCES_END),
            {"closing_balance": 5, "account_key": 6},
            {"customer_key": 7},
            8,
        ),
        "fact_loan_monthly": (star.loan_months, {"delinquency_bucket": 28}, {"loan_product_key": 30}, 31),
    }
    found = []
    for table, (fact, empty, strange, twice) in facts_of.items():
        dims = events if table == "fact_daily_balances" else star
        held = {
            "date_key": (dims.dates, "date_key"),
            "account_key": (dims.accounts, "account_key"),
            "customer_key": (dims.customers, "customer_key"),
            "merchant_category_key": (dims.categories, "merchant_category_key"),
            "loan_product_key": (dims.products, "loan_product_key"),
        }
        # A fact that is not stored is computed once, so rows come twice by an array and not by a union.
        copies = F.explode(F.when(_day() == twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        broken = fact.withColumn("_copy", copies).drop("_copy").withColumns(
            {c: F.when(_day() != day, F.col(c)) for c, day in empty.items()}
            | {c: F.when(_day() == day, F.lit(0)).otherwise(F.col(c)) for c, day in strange.items()}
        )
        rule = quality.FACT_RULES[table]
        found.append(quality.constraint_violations(broken, table, rule, {c: held[c] for c in rule.foreign_keys}))
    return reduce(DataFrame.unionByName, found)


@query
def check_not_null(spark, sf_dir):
    """The unknown member's empty attributes and the missing scores."""
    return quality.check_not_null(_events(spark, sf_dir).customers, CUSTOMER_COLUMNS)


@query
def unknown_member_rate(spark, sf_dir):
    return quality.unknown_member_rate(
        _lineitem(spark, sf_dir).fact, ["account_key", "customer_key", "merchant_category_key"]
    )


@query
def reconcile_totals(spark, sf_dir):
    """Everything staged against the fact: what differs is the repeated transaction ids."""
    star = _lineitem(spark, sf_dir)
    return quality.reconcile_totals(star.staged, star.fact)


