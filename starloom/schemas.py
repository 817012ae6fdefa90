"""Declared schemas of staging, dimension and fact tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def columns(text: str) -> T.StructType:
    """A schema from "name type, name decimal(p,s), ..."; needs no running session."""
    schema = T.StructType()
    for name, kind, size in re.findall(r"(\w+) (\w+)(?:\((\d+,\d+)\))?", text):
        schema.add(name, T.DecimalType(*map(int, size.split(","))) if size else _TYPES[kind])
    return schema


STAGING = {
    "branches": columns(
        "branch_id string, branch_name string, city string, state string, opened_date date"
    ),
    "customers": columns(
        "customer_id string, first_name string, last_name string, age int, "
        "annual_income decimal(14,2), credit_score int, dti decimal(6,3), segment string, "
        "join_date date, home_branch_id string"
    ),
    "accounts": columns(
        "account_id string, customer_id string, product_type string, apr decimal(6,4), "
        "open_date date, status string, initial_balance decimal(16,2)"
    ),
    "transactions": columns(
        "transaction_id string, account_id string, timestamp timestamp, amount decimal(16,2), "
        "merchant_category string, channel string, is_fraud boolean"
    ),
    "loans": columns(
        "loan_id string, customer_id string, loan_type string, principal decimal(16,2), "
        "apr decimal(6,4), term_months int, origination_date date, monthly_payment decimal(16,2), "
        "credit_score_at_origination int, dti_at_origination decimal(6,3), defaulted boolean"
    ),
}

DIM_DATE = columns(
    "date_key int, full_date date, year smallint, quarter smallint, month smallint, "
    "month_name string, week_of_year smallint, day_of_month smallint, day_of_week smallint, "
    "day_name string, is_weekend boolean, is_business_day boolean, is_month_end boolean, "
    "is_quarter_end boolean, is_year_end boolean, fiscal_year smallint, fiscal_quarter string, "
    "prior_year_date_key int, days_from_epoch int"
)

DIM_CUSTOMER = columns(
    "customer_key bigint, customer_id string, first_name string, last_name string, "
    "full_name string, age smallint, annual_income decimal(14,2), credit_score smallint, "
    "credit_band string, dti decimal(6,3), segment string, join_date date, "
    "home_branch_id string, valid_from date, valid_to date, is_current boolean, "
    "row_hash string, created_at timestamp, updated_at timestamp"
)

DIM_ACCOUNT = columns(
    "account_key bigint, account_id string, customer_id string, product_type string, "
    "product_family string, apr decimal(6,4), open_date date, status string, "
    "initial_balance decimal(16,2), created_at timestamp, updated_at timestamp"
)

DIM_BRANCH = columns(
    "branch_key bigint, branch_id string, branch_name string, city string, state string, "
    "region string, opened_date date, created_at timestamp, updated_at timestamp"
)

DIM_MERCHANT_CATEGORY = columns(
    "merchant_category_key bigint, category_code string, category_name string, "
    "is_discretionary boolean, fraud_risk_tier string, created_at timestamp"
)

DIM_LOAN_PRODUCT = columns(
    "loan_product_key bigint, loan_type string, product_name string, is_secured boolean, "
    "typical_term_months smallint, created_at timestamp"
)

FACT_TRANSACTIONS = columns(
    "transaction_key bigint, transaction_id string, date_key int, account_key bigint, "
    "customer_key bigint, merchant_category_key bigint, amount decimal(16,2), "
    "transaction_ts timestamp, hour_of_day smallint, channel string, is_fraud boolean, "
    "load_id bigint, created_at timestamp"
)

FACT_DAILY_BALANCES = columns(
    "balance_key bigint, date_key int, account_key bigint, customer_key bigint, "
    "closing_balance decimal(16,2), total_debits decimal(16,2), total_credits decimal(16,2), "
    "transaction_count int, load_id bigint, created_at timestamp"
)

FACT_LOAN_MONTHLY = columns(
    "loan_month_key bigint, date_key int, loan_id string, customer_key bigint, "
    "loan_product_key bigint, outstanding_balance decimal(16,2), scheduled_payment decimal(16,2), "
    "principal_paid decimal(16,2), interest_paid decimal(16,2), days_past_due int, "
    "delinquency_bucket string, is_defaulted boolean, load_id bigint, created_at timestamp"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the declared columns in their declared order, cast to their declared types.

    Spark's ANSI casts raise on a value that does not fit, as a typed table would.
    """
    return df.selectExpr(*[typed(f"`{f.name}`", f) for f in schema.fields])


def typed(sql: str, field: T.StructField) -> str:
    """SQL for an expression shown under a declared name and type."""
    return f"CAST({sql} AS {field.dataType.simpleString()}) AS `{field.name}`"


def struct_of(schema: T.StructType, cells: dict[str, str], otherwise: str = "NULL") -> str:
    """SQL for a row of ``schema`` from SQL cells; ``otherwise`` may contain {name}."""
    parts = [
        f"'{f.name}', CAST({cells.get(f.name, otherwise.format(name=f.name))} AS "
        f"{f.dataType.simpleString()})"
        for f in schema.fields
    ]
    return f"named_struct({', '.join(parts)})"


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark, schema: T.StructType, rows: list[dict[str, str]]) -> DataFrame:
    """A small constant table from rows of SQL cells."""
    structs = ", ".join(struct_of(schema, row) for row in rows)
    return spark.range(0, 1, 1, 1).selectExpr(f"inline(array({structs}))")
