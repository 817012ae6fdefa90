"""Calendar, lookup and Type 1 dimensions, and the unknown members."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import attributes, calendar
from starloom.functions.keys import (
    BEGINNING_OF_HISTORY,
    END_OF_TIME,
    UNKNOWN_CODE,
    UNKNOWN_ID,
    UNKNOWN_KEY,
)
from starloom.operators.dedup import insert_if_absent, refuse_duplicates

# Calendar range of a default load.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)

# category_code, category_name, is_discretionary, fraud_risk_tier.
MERCHANT_CATEGORIES = [
    ("grocery", "Grocery", False, "low"),
    ("restaurant", "Restaurant", True, "low"),
    ("gas", "Fuel", False, "medium"),
    ("retail", "Retail", True, "medium"),
    ("online", "Online / E-commerce", True, "high"),
    ("utilities", "Utilities", False, "low"),
    ("travel", "Travel", True, "high"),
    ("healthcare", "Healthcare", False, "low"),
    ("entertainment", "Entertainment", True, "medium"),
    ("atm_withdrawal", "ATM Withdrawal", False, "medium"),
    (UNKNOWN_CODE, "Unknown", False, "medium"),
]

# loan_type, product_name, is_secured, typical_term_months.
LOAN_PRODUCTS = [
    ("auto", "Auto Loan", True, 60),
    ("mortgage", "Mortgage", True, 360),
    ("personal", "Personal Loan", False, 36),
    ("student", "Student Loan", False, 120),
    (UNKNOWN_CODE, "Unknown", False, None),
]


# --- calendar -----------------------------------------------------------------------------------


def dim_date(
    spark: SparkSession,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    pad_names: bool = True,
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    bounds = spark.range(0, 1, 1, 1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return dim_date_between(bounds, pad_names)


def dim_date_spanning(days: DataFrame, column: str, pad_names: bool = True) -> DataFrame:
    """The calendar of every whole year that ``column`` touches."""
    bounds = days.agg(
        F.trunc(F.min(column), "year").alias("start"),
        F.date_sub(F.add_months(F.trunc(F.max(column), "year"), 12), 1).alias("end"),
    )
    return dim_date_between(bounds, pad_names)


def dim_date_between(bounds: DataFrame, pad_names: bool = True) -> DataFrame:
    """The calendar of a one-row (start, end) table. Names are blank-padded to nine characters."""
    days = bounds.select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date")
    )
    d = F.col("full_date")
    weekday = calendar.iso_weekday(d)
    month_end = F.last_day(d) == d

    def name(pattern: str) -> Column:
        text = F.date_format(d, pattern)
        return F.rpad(text, 9, " ") if pad_names else text

    columns = {
        "date_key": calendar.date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": name("MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": weekday,
        "day_name": name("EEEE"),
        "is_weekend": weekday >= 6,
        "is_business_day": weekday < 6,
        "is_month_end": month_end,
        "is_quarter_end": month_end & (F.month(d) % 3 == 0),
        "is_year_end": month_end & (F.month(d) == 12),
        "fiscal_year": calendar.fiscal_year(d),
        "fiscal_quarter": calendar.fiscal_quarter(d),
        "prior_year_date_key": calendar.date_key(F.add_months(d, -12)),
        "days_from_epoch": F.unix_date(d),
    }
    return schemas.conform(days.select(*[c.alias(n) for n, c in columns.items()]), schemas.DIM_DATE)


# --- lookups ------------------------------------------------------------------------------------


def merchant_category_seed(spark: SparkSession) -> DataFrame:
    """The merchant category lookup: one row per fixed value, hence safe to broadcast."""
    return _lookup(spark, schemas.DIM_MERCHANT_CATEGORY, MERCHANT_CATEGORIES)


def loan_product_seed(spark: SparkSession) -> DataFrame:
    return _lookup(spark, schemas.DIM_LOAN_PRODUCT, LOAN_PRODUCTS)


def _lookup(spark: SparkSession, schema, rows) -> DataFrame:
    key, code, *attrs, stamp = schema.fieldNames()
    table = []
    for row in rows:
        cells = {n: schemas.sql_literal(v) for n, v in zip([code, *attrs], row)}
        cells[key] = str(UNKNOWN_KEY) if row[0] == UNKNOWN_CODE else f"xxhash64({cells[code]})"
        table.append({**cells, stamp: "current_timestamp()"})
    return schemas.literal_table(spark, schema, table)


def seed_merchant_category(existing: DataFrame) -> DataFrame:
    """Add the fixed categories an existing dimension lacks; its own rows stay as they are."""
    return insert_if_absent(existing, merchant_category_seed(existing.sparkSession), "category_code")


def seed_loan_product(existing: DataFrame) -> DataFrame:
    return insert_if_absent(existing, loan_product_seed(existing.sparkSession), "loan_type")


# --- unknown members ----------------------------------------------------------------------------


def _unknown(spark: SparkSession, schema, **values) -> DataFrame:
    cells = {n: schemas.sql_literal(v) for n, v in values.items()}
    stamps = {n: "current_timestamp()" for n in ("created_at", "updated_at")}
    return schemas.literal_table(spark, schema, [{**stamps, **cells}])


def unknown_customer(spark: SparkSession) -> DataFrame:
    return _unknown(
        spark,
        schemas.DIM_CUSTOMER,
        customer_key=UNKNOWN_KEY,
        customer_id=UNKNOWN_ID,
        first_name="Unknown",
        last_name="Unknown",
        full_name="Unknown Customer",
        valid_from=BEGINNING_OF_HISTORY,
        valid_to=END_OF_TIME,
        is_current=True,
        row_hash="unknown",
    )


def unknown_account(spark: SparkSession) -> DataFrame:
    return _unknown(
        spark,
        schemas.DIM_ACCOUNT,
        account_key=UNKNOWN_KEY,
        account_id=UNKNOWN_ID,
        customer_id=UNKNOWN_ID,
        product_type="unknown",
        product_family="unknown",
    )


def unknown_branch(spark: SparkSession) -> DataFrame:
    return _unknown(
        spark,
        schemas.DIM_BRANCH,
        branch_key=UNKNOWN_KEY,
        branch_id=UNKNOWN_ID,
        branch_name="Unknown Branch",
    )


# --- Type 1 dimensions --------------------------------------------------------------------------


def merge_dim_branch(dim: DataFrame, staged: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Overwrite known branches with the batch, add new ones."""
    incoming = staged.withColumn("region", attributes.branch_region(F.col("state")))
    return _upsert(dim, incoming, "branch_id", "branch_key", schemas.DIM_BRANCH, [], load_ts)


def merge_dim_account(dim: DataFrame, staged: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Like branches, but a known account keeps its customer and its opening date."""
    incoming = staged.withColumn("product_family", attributes.product_family(F.col("product_type")))
    return _upsert(
        dim,
        incoming,
        "account_id",
        "account_key",
        schemas.DIM_ACCOUNT,
        ["customer_id", "open_date"],
        load_ts,
    )


def _upsert(dim, incoming, natural, surrogate, schema, kept, load_ts) -> DataFrame:
    """New snapshot of a Type 1 dimension: one full outer join, so one shuffle of each side.

    A row found on one side only is taken from there. Where both sides have it, the batch wins, except
    for ``kept`` columns.
    """
    stamp = F.current_timestamp() if load_ts is None else load_ts
    batch = refuse_duplicates(incoming, natural, "batch").withColumns(
        {"_staged": F.lit(True), "_stamp": stamp}
    )
    known = dim.withColumn("_known", F.lit(True))
    both = known.alias("d").join(
        batch.alias("i"), F.col(f"d.{natural}") == F.col(f"i.{natural}"), "full_outer"
    )
    cells = {
        natural: f"coalesce(d.{natural}, i.{natural})",
        surrogate: f"coalesce(d.{surrogate}, xxhash64(i.{natural}))",
        "created_at": "if(d._known, d.created_at, i._stamp)",
        "updated_at": "if(i._staged, i._stamp, d.updated_at)",
        **{c: f"if(d._known, d.{c}, i.{c})" for c in kept},
    }
    return both.selectExpr(
        *[
            schemas.typed(cells.get(f.name, f"if(i._staged, i.{f.name}, d.{f.name})"), f)
            for f in schema.fields
        ]
    )
