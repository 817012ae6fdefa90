"""Every registered query against its SQL on DuckDB, and the entry points' contract."""

import os

import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import starloom.plans.queries
from starloom import plans
from starloom.operators import quality
from starloom.plans import analytics
from starloom.schemas import FACT_TRANSACTIONS
from starloom.sources import sample

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The corpus subpackage, which may be absent, tests its own queries.
QUERIES = {name: entry_points.queries()[name] for name in plans.queries.QUERIES}
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, name):
    assert oracle.differences(duck, QUERIES[name](spark, SF_DIR), ORACLES[name]) == []


@pytest.mark.parametrize("source", ["events", "lineitem"])
def test_loaded_star_passes_every_check(spark, source):
    star = sample.star(spark, SF_DIR, source)
    fact, dim = star.fact, star.customers
    pairs = fact.join(dim.select("customer_key", "customer_id"), "customer_key").select(
        "customer_id", F.to_date("transaction_ts").alias("day")
    )
    checks = {
        "one current": quality.check_one_current(dim),
        "validity": quality.check_validity_order(dim),
        "overlap": quality.check_scd2_overlap(dim),
        "grain": quality.check_unique(fact, ["transaction_id"]),
        "customer keys": quality.check_unique(dim, ["customer_key"]),
        "account keys": quality.check_unique(star.accounts, ["account_key"]),
        "point in time": quality.check_pit_unique(dim, pairs, "customer_id", "day"),
        "foreign keys": quality.check_foreign_keys(
            fact,
            {
                "date_key": (star.dates, "date_key"),
                "account_key": (star.accounts, "account_key"),
                "customer_key": (dim, "customer_key"),
                "merchant_category_key": (star.categories, "merchant_category_key"),
            },
        ),
        "not null": quality.check_not_null(fact, FACT_TRANSACTIONS.fieldNames()),
    }
    assert {name: df.count() for name, df in checks.items() if df.count()} == {}


def test_hot_accounts_change_no_answer(spark):
    """The whole window tour with every account cut into chunks, against the registered query."""
    star = sample.star(spark, SF_DIR, "lineitem")
    hot = analytics.window_tour(star.fact, star.accounts, limit=None, hot_rows=0)
    plain = analytics.window_tour(star.fact, star.accounts, limit=None)
    assert hot.exceptAll(plain).count() == 0 and hot.count() == plain.count()


def test_loan_and_balance_grain(spark):
    star = sample.star(spark, SF_DIR, "lineitem")
    assert quality.check_unique(star.loan_months, ["date_key", "loan_id"]).count() == 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 11
