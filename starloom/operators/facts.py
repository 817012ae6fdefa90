"""Fact builders: transactions, daily account balances, monthly loan snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import attributes, calendar
from starloom.functions.keys import UNKNOWN_KEY, hash_key
from starloom.operators.dedup import first_per_key
from starloom.operators.history import account_owner_periods, gapless_versions, valid_on

# Among staged rows with the same transaction_id the first in this order is loaded. It covers every
# staged column, so rows still tied are equal.
TRANSACTION_ORDER = [
    "timestamp",
    "amount",
    "account_id",
    "merchant_category",
    "channel",
    "is_fraud",
]

# Bytes of staged files for a part of a load, and most parts.
PART_BYTES, PARTS = 128 << 20, 8


def or_unknown(key: Column | str) -> Column:
    """The looked-up key, or the unknown member's."""
    return F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(UNKNOWN_KEY)).cast("bigint")


def in_calendar(staged: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows whose day the calendar holds: a semi-join with a few thousand days."""
    day = dates.select(F.col("full_date").alias("_day"))
    return staged.join(day, F.to_date("timestamp") == F.col("_day"), "left_semi")


def new_transactions(
    staged: DataFrame, dates: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """The staged rows a load has to insert: in the calendar, one per id, not loaded before.

    ``existing`` needs only transaction_id. A load passes none: it meets the ids of before in their buckets
    (``sources.ids``) instead of shuffling them.
    """
    rows = first_per_key(in_calendar(staged, dates), ["transaction_id"], TRANSACTION_ORDER)
    if existing is not None:
        rows = rows.join(existing.select("transaction_id"), "transaction_id", "left_anti")
    return rows


def parts_by_id(staged: DataFrame) -> list[DataFrame]:
    """The staged rows in parts by a hash of their id, each id whole in one: a part is shuffled, the others wait.

    One part for PART_BYTES of the files below, at most PARTS, as each part reads the files.
    """
    leaves = staged._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    n = min(PARTS, size // PART_BYTES + 1)
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(n))
    return [staged.where(part == i) for i in range(n)] if n > 1 else [staged]


def fact_transactions(
    staged: DataFrame,
    dates: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    categories: DataFrame,
    existing: DataFrame | None = None,
    load_id: int | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """Transaction fact rows to append: the rows of ``new_transactions`` with their keys."""
    rows = new_transactions(staged, dates, existing)
    return keyed_transactions(rows, accounts, customers, categories, load_id, load_ts)


def keyed_transactions(
    rows: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    categories: DataFrame,
    load_id: int | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """Fact rows of staged transactions that are to be inserted.

    Each row gets the account, the customer version valid on its day, and the category; what cannot
    be looked up points at the unknown member, so no row is lost. Account and customer come from one
    join on account_id with a validity range. Joins carry no hints: the optimizer broadcasts what it
    measures to be small (calendar and categories are) and splits hot accounts of a shuffled join.
    """
    periods = account_owner_periods(accounts, customers).alias("p")
    day = F.to_date("s.timestamp")
    owned = rows.alias("s").join(
        periods,
        (F.col("s.account_id") == F.col("p.account_id"))
        & valid_on(day, F.col("p.valid_from"), F.col("p.valid_to")),
        "left",
    )
    lookup = categories.select("category_code", "merchant_category_key")
    named = owned.join(lookup, F.col("s.merchant_category") == F.col("category_code"), "left")
    columns = {
        "transaction_key": hash_key(F.col("s.transaction_id")),
        "transaction_id": F.col("s.transaction_id"),
        "date_key": calendar.date_key(day),
        "account_key": or_unknown("p.account_key"),
        "customer_key": or_unknown("p.customer_key"),
        "merchant_category_key": or_unknown("merchant_category_key"),
        "amount": F.col("s.amount"),
        "transaction_ts": F.col("s.timestamp"),
        "hour_of_day": F.hour("s.timestamp"),
        "channel": F.col("s.channel"),
        "is_fraud": F.col("s.is_fraud"),
        "load_id": F.lit(load_id),
        "created_at": F.current_timestamp() if load_ts is None else load_ts,
    }
    return schemas.conform(
        named.select(*[c.alias(n) for n, c in columns.items()]), schemas.FACT_TRANSACTIONS
    )


def _in_days(fact: DataFrame, start: date | None, end: date) -> DataFrame:
    """Fact rows of a range of days; a stored fact reads only the months it touches."""
    for column, pattern in [("date_key", "%Y%m%d"), ("month_key", "%Y%m")]:
        if column in fact.columns:
            fact = fact.where(F.col(column) <= int(end.strftime(pattern)))
            if start is not None:
                fact = fact.where(F.col(column) >= int(start.strftime(pattern)))
    return fact


def fact_daily_balances(
    fact: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    end: date,
    start: date | None = None,
    signed_amount: Column | None = None,
    opening: DataFrame | None = None,
    load_id: int | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """One row per account and day, active or not, from its first day to ``end``.

    The first day is the opening date, or the first transaction where that is unknown; ``start`` cuts
    earlier days off, their movements staying in the balance. A positive ``signed_amount`` (default:
    the amount) is a credit, a negative one a debit.

    To build period by period pass ``opening``, the rows of this fact on the day before ``start``:
    their balances are carried on and only transactions from ``start`` to ``end`` are read.

    Only active days are shuffled, after map-side sums per (account, day); an account has at most one
    row per calendar day there, so no window group is unbounded. Quiet days are produced locally by
    expanding each active day up to the next one, and the customer join runs before that expansion.
    """
    signed = F.col("amount") if signed_amount is None else signed_amount
    zero = F.lit(0).cast("decimal(26,2)")
    fact = _in_days(fact, start if opening is not None else None, end)
    movements = (
        fact.withColumn("_signed", signed)
        .groupBy("account_key", calendar.key_to_date("date_key").alias("day"))
        .agg(
            F.sum(F.greatest(F.col("_signed"), F.lit(0))).alias("credits"),
            F.sum(F.greatest(-F.col("_signed"), F.lit(0))).alias("debits"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    first_active = movements.groupBy("account_key").agg(F.min("day").alias("first_active"))
    opened = accounts.select(
        "account_key", "customer_id", "open_date", F.coalesce("initial_balance", zero).alias("opening")
    ).join(first_active, "account_key", "left")
    first_day = F.coalesce("open_date", "first_active")
    if opening is not None:
        carried = opening.select("account_key", F.col("closing_balance").alias("_carried"))
        known = F.col("_carried").isNotNull()
        opened = opened.join(carried, "account_key", "left").withColumn(
            "opening", F.coalesce("_carried", "opening")
        )
        first_day = F.when(known, F.lit(start).cast("date")).otherwise(first_day)
    if start is not None:
        # An account without a first day has no days; greatest() would pass over the NULL.
        first_day = F.when(first_day.isNotNull(), F.greatest(first_day, F.lit(start).cast("date")))
    opened = opened.withColumn("first_day", first_day).where(
        F.col("first_day") <= F.lit(end).cast("date")
    )
    # Days before the first one are folded into a zero row on it, so every account starts with a row.
    seeds = opened.select(
        "account_key",
        F.col("first_day").alias("day"),
        zero.alias("credits"),
        zero.alias("debits"),
        zero.alias("folded"),
        F.lit(0).cast("bigint").alias("n"),
    )
    counted = F.col("day") >= F.col("first_day")
    moved = (
        movements.join(opened.select("account_key", "first_day"), "account_key")
        .select(
            "account_key",
            F.greatest("day", "first_day").alias("day"),
            F.when(counted, F.col("credits")).otherwise(zero).alias("credits"),
            F.when(counted, F.col("debits")).otherwise(zero).alias("debits"),
            F.when(counted, zero).otherwise(F.col("credits") - F.col("debits")).alias("folded"),
            F.when(counted, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("n"),
        )
    )
    days = (
        moved.unionByName(seeds)
        .groupBy("account_key", "day")
        .agg(*[F.sum(c).alias(c) for c in ("credits", "debits", "folded", "n")])
    )
    order = W.partitionBy("account_key").orderBy("day")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = days.select(
        "*",
        F.sum(F.col("credits") - F.col("debits") + F.col("folded")).over(so_far).alias("moved"),
        F.coalesce(F.lead("day", 1).over(order), F.date_add(F.lit(end).cast("date"), 1)).alias("until"),
    )
    periods = gapless_versions(customers).alias("v")
    owned = spans.join(opened.select("account_key", "customer_id", "opening"), "account_key").alias("s")
    overlap = (
        (F.col("s.customer_id") == F.col("v.customer_id"))
        & (F.col("v.valid_from") < F.col("s.until"))
        & (F.col("v.valid_to") > F.col("s.day"))
    )
    pieces = owned.join(periods, overlap, "left").select(
        "s.*",
        "customer_key",
        F.explode(
            F.sequence(
                F.greatest("s.day", F.coalesce("valid_from", "s.day")),
                F.date_sub(F.least("until", F.coalesce("valid_to", "until")), 1),
                F.expr("interval 1 day"),
            )
        ).alias("balance_day"),
    )
    active = F.col("balance_day") == F.col("day")
    key = calendar.date_key(F.col("balance_day"))
    columns = {
        "balance_key": hash_key(F.col("account_key"), key),
        "date_key": key,
        "account_key": F.col("account_key"),
        "customer_key": or_unknown("customer_key"),
        "closing_balance": F.col("opening") + F.col("moved"),
        "total_debits": F.when(active, F.col("debits")).otherwise(zero),
        "total_credits": F.when(active, F.col("credits")).otherwise(zero),
        "transaction_count": F.when(active, F.col("n")).otherwise(F.lit(0)),
        "load_id": F.lit(load_id),
        "created_at": F.current_timestamp() if load_ts is None else load_ts,
    }
    return schemas.conform(
        pieces.select(*[c.alias(n) for n, c in columns.items()]), schemas.FACT_DAILY_BALANCES
    )


def fact_loan_monthly(
    snapshot: DataFrame,
    loans: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    charge_off_at: int | None = 180,
    load_id: int | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """One row per loan and month from a servicing snapshot.

    ``snapshot`` holds loan_id, snapshot_date, outstanding_balance, days_past_due and is_defaulted,
    and may hold principal_paid and interest_paid. Months missing between two snapshots of a loan
    repeat the earlier one at their month end, with nothing paid, so the fact is dense. Loans are
    joined to their customers' versions first; the snapshot itself takes part in one join. A loan that
    is not among the loans keeps its months, with the unknown customer and product. That join
    is a merge on loan_id, by which the snapshot is partitioned already; the optimizer cannot know how
    many months the expansion makes and might otherwise broadcast them.
    """
    optional = [
        F.coalesce(F.col(c) if c in snapshot.columns else F.lit(None), F.lit(0)).alias(c)
        for c in ("principal_paid", "interest_paid")
    ]
    order = W.partitionBy("loan_id").orderBy("snapshot_date")
    observed = snapshot.select(
        "loan_id",
        "snapshot_date",
        "outstanding_balance",
        F.coalesce("days_past_due", F.lit(0)).alias("days_past_due"),
        F.coalesce("is_defaulted", F.lit(False)).alias("is_defaulted"),
        *optional,
    ).withColumn("_next", F.lead("snapshot_date", 1).over(order))
    gap = calendar.months_apart(F.col("_next"), F.col("snapshot_date"))
    dense = observed.withColumn(
        "_ahead", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce(gap, F.lit(1)) - 1, F.lit(0))))
    )
    repeated = F.col("_ahead") > 0
    day = F.when(
        repeated, F.last_day(F.add_months(calendar.month_start(F.col("snapshot_date")), F.col("_ahead")))
    ).otherwise(F.col("snapshot_date"))
    paid = {
        c: F.when(repeated, F.lit(0)).otherwise(F.col(c)) for c in ("principal_paid", "interest_paid")
    }
    monthly = dense.withColumns({**paid, "day": day}).alias("m")

    kinds = products.select("loan_type", "loan_product_key")
    owned = (
        loans.select("loan_id", "customer_id", "loan_type", "monthly_payment")
        .join(kinds, "loan_type", "left")
        .join(gapless_versions(customers), "customer_id", "left")
        .hint("merge")
        .alias("l")
    )
    rows = monthly.join(
        owned,
        (F.col("m.loan_id") == F.col("l.loan_id"))
        & (F.col("l.customer_key").isNull() | valid_on(F.col("m.day"), "l.valid_from", "l.valid_to")),
        "left",
    )
    key = calendar.date_key(F.col("day"))
    columns = {
        "loan_month_key": hash_key(F.col("m.loan_id"), key),
        "date_key": key,
        "loan_id": F.col("m.loan_id"),
        "customer_key": or_unknown("customer_key"),
        "loan_product_key": or_unknown("loan_product_key"),
        "outstanding_balance": F.col("outstanding_balance"),
        "scheduled_payment": F.col("monthly_payment"),
        "principal_paid": F.col("principal_paid"),
        "interest_paid": F.col("interest_paid"),
        "days_past_due": F.col("days_past_due"),
        "delinquency_bucket": attributes.delinquency_bucket(F.col("days_past_due"), charge_off_at),
        "is_defaulted": F.col("is_defaulted"),
        "load_id": F.lit(load_id),
        "created_at": F.current_timestamp() if load_ts is None else load_ts,
    }
    return schemas.conform(
        rows.select(*[c.alias(n) for n, c in columns.items()]), schemas.FACT_LOAN_MONTHLY
    )
