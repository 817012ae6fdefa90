"""Published views and the monthly summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions import calendar
from starloom.functions.keys import UNKNOWN_ID
from starloom.functions.ratios import mean

MONEY = "decimal(38,2)"


def v_current_customers(dim: DataFrame) -> DataFrame:
    """Customers as they are today."""
    return dim.where(F.col("is_current") & (F.col("customer_id") != UNKNOWN_ID)).select(
        "customer_key",
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
    )


def v_customer_history(dim: DataFrame) -> DataFrame:
    """Every version, numbered per customer, with the days a closed version lasted."""
    versions = W.partitionBy("customer_id").orderBy("valid_from")
    return dim.where(F.col("customer_id") != UNKNOWN_ID).select(
        "customer_id",
        "customer_key",
        "segment",
        "credit_band",
        "credit_score",
        "valid_from",
        "valid_to",
        "is_current",
        F.when(~F.col("is_current"), F.datediff("valid_to", "valid_from")).alias("days_in_version"),
        F.row_number().over(versions).alias("version_number"),
    )


def v_transaction_enriched(
    fact: DataFrame,
    dates: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """The star joined flat; customer attributes are those of the transaction date.

    No join is hinted: the optimizer broadcasts a dimension whose size it finds below its threshold
    (calendar and categories always are) and otherwise shuffles with skew splitting. A column not
    selected by the reader is never read.
    """
    day = dates.select(
        "date_key", "full_date", "year", "month", "month_name", "day_name", "is_weekend"
    )
    category = categories.select(
        "merchant_category_key",
        F.col("category_name").alias("merchant_category"),
        "is_discretionary",
        "fraud_risk_tier",
    )
    account = accounts.select("account_key", "account_id", "product_type", "product_family")
    customer = customers.select(
        "customer_key",
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("segment").alias("segment_at_txn_time"),
        F.col("credit_band").alias("credit_band_at_txn_time"),
    )
    return (
        fact.join(day, "date_key")
        .join(category, "merchant_category_key")
        .join(account, "account_key")
        .join(customer, "customer_key")
        .select(
            "transaction_id",
            "full_date",
            "year",
            "month",
            "month_name",
            "day_name",
            "is_weekend",
            "transaction_ts",
            "hour_of_day",
            "amount",
            "channel",
            "is_fraud",
            "merchant_category",
            "is_discretionary",
            "fraud_risk_tier",
            "account_id",
            "product_type",
            "product_family",
            "customer_id",
            "customer_name",
            "segment_at_txn_time",
            "credit_band_at_txn_time",
        )
    )


def mv_monthly_transaction_summary(
    fact: DataFrame, customers: DataFrame, categories: DataFrame
) -> DataFrame:
    """Counts and sums by month, segment and category.

    The fact is first summed per (month, customer version, category name), which is all that is shuffled
    and joined; a busy customer shrinks to one row per month and category before it. At that grain each
    customer version occurs once per output group, so the distinct count is a plain count. The few
    categories are named before that sum, so rows need not meet again by name after the customer join;
    their names are broadcast by a hint, as a shuffle by category would gather the fact in a few tasks.
    Year and month come from the date key without a calendar join.
    """
    fraud = F.col("is_fraud")
    category = categories.select(
        "merchant_category_key", F.col("category_name").alias("merchant_category")
    )
    partial = fact.join(F.broadcast(category), "merchant_category_key").groupBy(
        calendar.month_key(F.col("date_key")).alias("_month"), "customer_key", "merchant_category"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("total"),
        F.count(F.when(fraud, 1)).alias("fraud_n"),
        F.sum(F.when(fraud, F.col("amount"))).alias("fraud_total"),
    )
    per_version = partial.join(customers.select("customer_key", "segment"), "customer_key")
    return (
        per_version.groupBy("_month", "segment", "merchant_category")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("total").cast(MONEY).alias("total_amount"),
            F.sum("fraud_n").alias("fraud_count"),
            F.sum("fraud_total").cast(MONEY).alias("fraud_amount"),
            F.count(F.lit(1)).alias("distinct_customers"),
        )
        .select(
            F.floor(F.col("_month") / 100).cast("smallint").alias("year"),
            (F.col("_month") % 100).cast("smallint").alias("month"),
            "segment",
            "merchant_category",
            "transaction_count",
            "total_amount",
            mean(F.col("total_amount"), F.col("transaction_count"), 6).alias("avg_amount"),
            "fraud_count",
            "fraud_amount",
            "distinct_customers",
        )
    )


def fraud_by_day(fact: DataFrame) -> DataFrame:
    """date_key, fraud_count, fraud_amount: the days with fraudulent transactions."""
    return fact.where("is_fraud").groupBy("date_key").agg(
        F.count(F.lit(1)).alias("fraud_count"), F.sum("amount").cast(MONEY).alias("fraud_amount")
    )
