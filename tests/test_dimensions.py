"""Calendar, lookups and Type 1 merges."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import attributes
from starloom.operators import dimensions


def calendar_row(spark, day):
    return dimensions.dim_date(spark, day, day).first()


def test_calendar_spans_the_default_range(spark):
    dates = dimensions.dim_date(spark)
    assert dates.count() == (date(2030, 12, 31) - date(2020, 1, 1)).days + 1
    assert dates.schema.fieldNames() == schemas.DIM_DATE.fieldNames()


def test_leap_day(spark):
    row = calendar_row(spark, date(2024, 2, 29))
    assert (row.date_key, row.prior_year_date_key) == (20240229, 20230228)
    assert row.is_month_end and not row.is_quarter_end
    assert (row.month_name, row.day_name) == ("February ", "Thursday ")


@pytest.mark.parametrize(
    "day, fiscal_year, fiscal_quarter",
    [
        (date(2024, 9, 30), 2024, "FY2024-Q4"),
        (date(2024, 10, 1), 2025, "FY2025-Q1"),
        (date(2024, 12, 31), 2025, "FY2025-Q1"),
        (date(2024, 1, 31), 2024, "FY2024-Q2"),
    ],
)
def test_fiscal_calendar(spark, day, fiscal_year, fiscal_quarter):
    row = calendar_row(spark, day)
    assert (row.fiscal_year, row.fiscal_quarter) == (fiscal_year, fiscal_quarter)


def test_year_end_and_weekend(spark):
    row = calendar_row(spark, date(2023, 12, 31))
    assert row.is_month_end and row.is_quarter_end and row.is_year_end
    assert (row.day_of_week, row.is_weekend, row.is_business_day, row.week_of_year) == (7, True, False, 52)


def test_unpadded_names(spark):
    row = dimensions.dim_date(spark, date(2024, 5, 6), date(2024, 5, 6), pad_names=False).first()
    assert (row.month_name, row.day_name) == ("May", "Monday")


@pytest.mark.parametrize(
    "state, region",
    [("CA", "West"), ("TN", "South"), ("MA", "Northeast"), ("MI", "Midwest"), ("HI", "Other"), (None, "Other")],
)
def test_region(spark, state, region):
    df = spark.createDataFrame([(state,)], "state string")
    assert df.select(attributes.branch_region(F.col("state"))).first()[0] == region


@pytest.mark.parametrize(
    "dpd, bucket",
    [(0, "current"), (1, "1-29"), (29, "1-29"), (30, "30-59"), (60, "60-89"), (90, "90+"), (179, "90+"), (180, "charge-off"), (None, "current")],
)
def test_delinquency_ladder(spark, dpd, bucket):
    df = spark.createDataFrame([(dpd,)], "dpd int")
    assert df.select(attributes.delinquency_bucket(F.col("dpd"))).first()[0] == bucket


def accounts(spark, *rows):
    return spark.createDataFrame(
        [(i, c, p, Decimal("0.05"), d, s, Decimal("10.00")) for i, c, p, d, s in rows],
        schemas.STAGING["accounts"],
    )


def test_account_upsert_keeps_customer_and_open_date(spark):
    dim = dimensions.merge_dim_account(
        dimensions.unknown_account(spark), accounts(spark, ("A1", "C1", "checking", date(2020, 1, 1), "active"))
    )
    key = dim.where("account_id = 'A1'").first().account_key
    dim = dimensions.merge_dim_account(
        dim,
        accounts(
            spark,
            ("A1", "C9", "credit_card", date(2024, 1, 1), None),
            ("A2", "C2", "savings", date(2024, 1, 1), "active"),
        ),
    )
    rows = {r.account_id: r for r in dim.collect()}
    assert set(rows) == {"-1", "A1", "A2"}
    assert (rows["A1"].customer_id, rows["A1"].open_date) == ("C1", date(2020, 1, 1))
    assert (rows["A1"].product_family, rows["A1"].status, rows["A1"].account_key) == ("credit", None, key)
    assert rows["A2"].product_family == "deposit"
    assert (rows["-1"].account_key, rows["-1"].product_type) == (-1, "unknown")


def test_branch_upsert_overwrites_everything(spark):
    def staged(*rows):
        return spark.createDataFrame(list(rows), schemas.STAGING["branches"])

    dim = dimensions.unknown_branch(spark)
    dim = dimensions.merge_dim_branch(dim, staged(("B1", "Old", "X", "CA", date(2020, 1, 1))))
    dim = dimensions.merge_dim_branch(dim, staged(("B1", "New", None, "NY", date(2021, 1, 1))))
    row = dim.where("branch_id = 'B1'").first()
    assert (row.branch_name, row.city, row.region, row.opened_date) == ("New", None, "Northeast", date(2021, 1, 1))
    assert dim.count() == 2


def test_duplicate_upsert_key_is_refused(spark):
    twice = accounts(spark, *[("A1", "C1", "checking", date(2020, 1, 1), "active")] * 2)
    with pytest.raises(PySparkException, match="duplicate account_id"):
        dimensions.merge_dim_account(dimensions.unknown_account(spark), twice).collect()


def test_lookups(spark):
    categories = dimensions.merchant_category_seed(spark)
    assert categories.count() == 11
    assert categories.where("merchant_category_key = -1").first().category_code == "unknown"
    assert categories.where("is_discretionary").count() == 5
    products = {r.loan_type: r for r in dimensions.loan_product_seed(spark).collect()}
    assert products["mortgage"].typical_term_months == 360 and products["unknown"].typical_term_months is None
    assert dimensions.seed_merchant_category(categories).count() == 11


def test_conform_refuses_values_that_do_not_fit(spark):
    df = spark.range(1).selectExpr("40000 AS age")
    with pytest.raises(PySparkException, match="CAST_OVERFLOW"):
        df.selectExpr(schemas.typed("age", schemas.DIM_CUSTOMER["age"])).collect()
