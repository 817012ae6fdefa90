"""The business questions. Each takes fact and dimension DataFrames and returns the answer.

Shared choices: measures are summed per surrogate key before a dimension is joined, so a hot key is
reduced map-side and the join sees one row per key; year and month come from the date key; orderings
that decide a value or a limit end in a unique column. ``limit=None`` returns the whole answer.
Answers at transaction grain are not globally sorted, the caller may sort what it shows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions import calendar
from starloom.functions.keys import UNKNOWN_ID
from starloom.functions.ratios import mean, percent
from starloom.operators.dedup import first_per_key, latest_per_key
from starloom.operators.percentiles import exact_percentiles, value_counts
from starloom.operators.skew import HOT_ROWS, Columns, window_points, windows, windows_by_part

MONEY = "decimal(38,2)"


def _known(dim: DataFrame, column: str = "customer_id") -> DataFrame:
    return dim.where(F.col(column) != UNKNOWN_ID)


def _top(df: DataFrame, order: list[Column | str], limit: int | None) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def _date_parts(key: str = "date_key") -> list[Column]:
    return [
        calendar.key_year(F.col(key)).cast("smallint").alias("year"),
        calendar.key_month(F.col(key)).cast("smallint").alias("month"),
    ]


# --- aggregates ---------------------------------------------------------------------------------


def fraud_lookup(fact: DataFrame, from_key: int, to_key: int) -> DataFrame:
    """Count and sum of fraudulent transactions in a range of days.

    On a stored fact the month range prunes partitions and the day range row groups.
    """
    rows = fact.where(F.col("is_fraud") & F.col("date_key").between(from_key, to_key))
    if "month_key" in fact.columns:
        rows = rows.where(F.col("month_key").between(from_key // 100, to_key // 100))
    return rows.agg(F.count(F.lit(1)).alias("count"), F.sum("amount").cast(MONEY).alias("sum_amount"))


def fraud_lookup_by_day(days: DataFrame, from_key: int, to_key: int) -> DataFrame:
    """The answer of ``fraud_lookup`` from the published days (``views.fraud_by_day``)."""
    rows = days.where(F.col("date_key").between(from_key, to_key))
    return rows.agg(
        F.coalesce(F.sum("fraud_count"), F.lit(0)).alias("count"), F.sum("fraud_amount").cast(MONEY).alias("sum_amount")
    )


def monthly_volume(fact: DataFrame) -> DataFrame:
    """Transactions, total, average, smallest and largest amount per month."""
    volume = fact.groupBy(*_date_parts()).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").cast(MONEY).alias("total_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    return volume.withColumn(
        "avg_amount", mean(F.col("total_amount"), F.col("txn_count"), 2)
    ).orderBy("year", "month")


def fraud_rate_by_category(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """Where fraud concentrates: rate and average amounts per merchant category."""
    fraud, amount = F.col("is_fraud"), F.col("amount")
    sums = fact.groupBy("merchant_category_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(fraud, 1)).alias("fraud_n"),
        F.sum(F.when(fraud, amount)).alias("fraud_sum"),
        F.count(F.when(~fraud, 1)).alias("normal_n"),
        F.sum(F.when(~fraud, amount)).alias("normal_sum"),
    )
    named = sums.join(
        categories.select("merchant_category_key", "category_name", "fraud_risk_tier"),
        "merchant_category_key",
    )
    totals = named.groupBy("category_name", "fraud_risk_tier").agg(
        *[F.sum(c).alias(c) for c in ("n", "fraud_n", "fraud_sum", "normal_n", "normal_sum")]
    )
    return totals.select(
        "category_name",
        "fraud_risk_tier",
        F.col("n").alias("total_txns"),
        F.col("fraud_n").alias("fraud_txns"),
        percent(F.col("fraud_n"), F.col("n"), 4).alias("fraud_rate_pct"),
        F.round(F.col("fraud_sum"), 2).cast(MONEY).alias("fraud_amount"),
        mean(F.col("fraud_sum"), F.col("fraud_n"), 2).alias("avg_fraud_amount"),
        mean(F.col("normal_sum"), F.col("normal_n"), 2).alias("avg_normal_amount"),
    ).orderBy(F.desc("fraud_rate_pct"), "category_name")


def channel_pivot(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Online against in-person transactions, one row per segment."""
    kinds = {"online": F.col("channel") == "online", "in_person": F.col("channel") == "in_person"}
    measures = [F.count(F.lit(1)).alias("n")]
    for name, chosen in kinds.items():
        measures.append(F.count(F.when(chosen, 1)).alias(f"{name}_n"))
        measures.append(F.sum(F.when(chosen, F.col("amount"))).alias(f"{name}_sum"))
    partial = fact.groupBy("customer_key").agg(*measures)
    summed = ["n", "online_n", "online_sum", "in_person_n", "in_person_sum"]
    per_segment = (
        partial.join(_known(customers).select("customer_key", "segment"), "customer_key")
        .groupBy("segment")
        .agg(*[F.sum(c).alias(c) for c in summed])
    )
    return per_segment.select(
        "segment",
        F.col("n").alias("total_txns"),
        F.col("online_n").alias("online_txns"),
        F.col("in_person_n").alias("in_person_txns"),
        percent(F.col("online_n"), F.col("n"), 1).alias("pct_online"),
        mean(F.col("online_sum"), F.col("online_n"), 2).alias("avg_online_amt"),
        mean(F.col("in_person_sum"), F.col("in_person_n"), 2).alias("avg_in_person_amt"),
    ).orderBy(F.desc("total_txns"), "segment")


def filter_vs_case(fact: DataFrame, threshold: float) -> DataFrame:
    """The same conditional count and sum written with FILTER and with CASE, per channel."""
    above = f"amount > {threshold}"
    return fact.groupBy("channel").agg(
        F.expr(f"count(*) FILTER (WHERE {above})").alias("filter_count"),
        F.expr(f"sum(CASE WHEN {above} THEN 1 ELSE 0 END)").alias("case_count"),
        F.expr(f"sum(amount) FILTER (WHERE {above})").cast(MONEY).alias("filter_sum"),
        F.expr(f"sum(CASE WHEN {above} THEN amount END)").cast(MONEY).alias("case_sum"),
    )


def _segment_amounts(fact: DataFrame, customers: DataFrame) -> DataFrame:
    segments = _known(customers).select("customer_key", "segment")
    return fact.select("customer_key", "amount").join(segments, "customer_key")


def amount_percentiles(fact: DataFrame, customers: DataFrame, approx: bool = False) -> DataFrame:
    """Mean against median, p90 and p99 of the amount per segment; exact unless ``approx``."""
    amounts = _segment_amounts(fact, customers)
    if approx:
        p = F.percentile_approx("amount", [0.5, 0.9, 0.99], 10_000)
        sums = amounts.groupBy("segment").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount").alias("_sum"),
            F.max("amount").alias("max"),
            p.alias("_p"),
        )
        spread = sums.select(
            "segment", "n", "_sum", "max", *[F.col("_p")[i].alias(c) for i, c in enumerate(_MARKS)]
        )
    else:
        counts = value_counts(amounts, "segment", "amount")
        sums = counts.groupBy("segment").agg(
            F.sum("_n").alias("n"),
            F.sum(F.col("amount") * F.col("_n")).alias("_sum"),
            F.max("amount").alias("max"),
        )
        marks = exact_percentiles(counts, "segment", "amount", _MARKS)
        marks = marks.withColumnRenamed("segment", "_segment")
        spread = sums.join(marks, F.col("segment").eqNullSafe(F.col("_segment")))
    return spread.select(
        "segment",
        "n",
        mean(F.col("_sum"), F.col("n"), 2).alias("mean"),
        *[F.round(c, 2).alias(c) for c in _MARKS],
        "max",
    ).orderBy(F.desc("n"), "segment")


# Reported percentiles by column name.
_MARKS = {"median": "0.5", "p90": "0.9", "p99": "0.99"}


def amount_percentile_disc(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """The discrete percentiles per segment: amounts that really occur."""
    counts = value_counts(_segment_amounts(fact, customers), "segment", "amount")
    return exact_percentiles(counts, "segment", "amount", _MARKS, kind="disc").select(
        "segment", *[F.col(c).cast("decimal(16,2)").alias(c) for c in _MARKS]
    )


# --- windows ------------------------------------------------------------------------------------


# The order of an account's transactions, which all windows share.
BY_ACCOUNT = Columns("account_key", "transaction_ts", "transaction_id", "amount")


def fact_window_points(fact: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Where the transactions of hot accounts are cut, for all windows; a load publishes it beside the fact."""
    return window_points(fact.select("account_key", "transaction_ts", "transaction_id", "amount"), BY_ACCOUNT, hot_rows)


def _by_account(fact: DataFrame, accounts: DataFrame, columns: list[str | Column]) -> DataFrame:
    return fact.join(accounts.select("account_key", "account_id"), "account_key").select(
        "account_id", *columns
    )


def running_balance(
    fact: DataFrame, accounts: DataFrame, hot_rows: int = HOT_ROWS, points: DataFrame | None = None
) -> DataFrame:
    """Each transaction with its account's cumulative amount and the amount before it.

    ``points`` are the published split points of the fact's windows (``fact_window_points``), here and below.
    """
    rows = windows(
        fact.select("account_key", "transaction_ts", "transaction_id", "date_key", "amount"),
        BY_ACCOUNT,
        points,
        min_rows=hot_rows,
    )
    return _by_account(
        rows,
        accounts,
        [
            "transaction_id",
            calendar.key_to_date("date_key").alias("full_date"),
            "amount",
            F.col("running").cast(MONEY).alias("running_total"),
            F.col("previous").alias("prior_amount"),
        ],
    )


def window_tour(
    fact: DataFrame,
    accounts: DataFrame,
    limit: int | None = None,
    hot_rows: int = HOT_ROWS,
    points: DataFrame | None = None,
) -> DataFrame:
    """Rank, neighbour, running, moving and share columns of each transaction in its account.

    With a limit only the accounts of the first ``limit`` rows matter: they are found by a
    distributed top-k and only their transactions are windowed.
    """
    key = ["account_key", "transaction_ts", "transaction_id"]
    rows = fact.select(*key, "date_key", "amount")
    order = ["account_id", "transaction_ts", "transaction_id"]
    if limit is not None:
        first = _by_account(rows, accounts, key).orderBy(*order).limit(limit)
        shown = first.select("account_key").distinct()
        rows = rows.join(shown, "account_key", "left_semi")
    points = fact_window_points(rows, hot_rows) if points is None else points
    cold, hot = windows_by_part(rows, BY_ACCOUNT, points, trailing=7, tiles=4)
    columns = [
        "transaction_ts",
        "transaction_id",
        calendar.key_to_date("date_key").alias("full_date"),
        "amount",
        F.col("seq").alias("txn_seq"),
        F.col("value_rank").alias("amount_rank"),
        F.col("value_dense_rank").alias("amount_dense_rank"),
        F.col("tile").alias("amount_quartile"),
        F.col("previous").alias("prev_amount"),
        F.col("following").alias("next_amount"),
        (F.col("amount") - F.col("previous")).alias("change_from_prev"),
        F.col("first").alias("first_txn_amount"),
        F.col("last").alias("last_txn_amount"),
        F.col("running").cast(MONEY).alias("running_total"),
        mean(F.col("trailing_sum"), F.col("trailing_rows"), 2).alias("moving_avg_7"),
        percent(F.col("amount"), F.col("total"), 4).alias("pct_of_account_total"),
    ]
    # Hot accounts are few, so their rows are not shuffled by account.
    busy = F.broadcast(accounts.join(F.broadcast(points.select("account_key")), "account_key", "left_semi"))
    answer = _by_account(cold, accounts, columns).unionByName(_by_account(hot, busy, columns))
    return answer if limit is None else _top(answer, order, limit)


def ranking_ties(
    fact: DataFrame, accounts: DataFrame, hot_rows: int = HOT_ROWS, points: DataFrame | None = None
) -> DataFrame:
    """Position, rank and dense rank of each amount in its account, which differ on ties."""
    rows = windows(
        fact.select("account_key", "transaction_ts", "transaction_id", "amount"),
        BY_ACCOUNT,
        points,
        ordered=False,
        valued=True,
        min_rows=hot_rows,
    )
    return _by_account(
        rows,
        accounts,
        [
            "transaction_id",
            "amount",
            F.col("position").alias("amount_row_number"),
            F.col("value_rank").alias("amount_rank"),
            F.col("value_dense_rank").alias("amount_dense_rank"),
        ],
    )


def last_value_frames(
    fact: DataFrame, accounts: DataFrame, hot_rows: int = HOT_ROWS, points: DataFrame | None = None
) -> DataFrame:
    """The last amount under the default frame (the current row) and under the whole partition."""
    rows = windows(
        fact.select("account_key", "transaction_ts", "transaction_id", "amount"),
        BY_ACCOUNT,
        points,
        min_rows=hot_rows,
    )
    return _by_account(
        rows,
        accounts,
        [
            "transaction_id",
            F.col("amount").alias("default_frame_last"),
            F.col("last").alias("full_frame_last"),
        ],
    )


def window_row_count(
    fact: DataFrame, hot_rows: int = HOT_ROWS, points: DataFrame | None = None
) -> DataFrame:
    """Rows of the fact, rows after a window and groups after a group-by, per channel."""
    windowed = windows(
        fact.select("account_key", "transaction_ts", "transaction_id", "amount", "channel"),
        BY_ACCOUNT,
        points,
        min_rows=hot_rows,
    )
    kept = windowed.groupBy("channel").agg(
        F.count("running").alias("windowed_rows"), F.countDistinct("account_key").alias("groups")
    )
    return fact.groupBy("channel").agg(F.count(F.lit(1)).alias("fact_rows")).join(kept, "channel")


# --- customers ----------------------------------------------------------------------------------


def _segment_months(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Amount per (month, segment), summed per customer version before the join."""
    month = calendar.month_key(F.col("date_key")).alias("_month")
    partial = fact.groupBy(month, "customer_key").agg(F.sum("amount").alias("total"))
    return (
        partial.join(customers.select("customer_key", "segment"), "customer_key")
        .groupBy("_month", "segment")
        .agg(F.sum("total").cast(MONEY).alias("total_amount"))
    )


def monthly_growth(
    fact: DataFrame, customers: DataFrame, strict_calendar: bool = False
) -> DataFrame:
    """Month-over-month growth of each segment.

    The month compared with is the last one present; with ``strict_calendar`` only the month before.
    The window runs over one row per month and segment.
    """
    months = _segment_months(fact, customers).withColumns(
        {
            "year": F.floor(F.col("_month") / 100).cast("smallint"),
            "month": (F.col("_month") % 100).cast("smallint"),
        }
    )
    order = W.partitionBy("segment").orderBy("year", "month")
    prior = F.lag("total_amount").over(order)
    if strict_calendar:
        number = F.col("year") * 12 + F.col("month")
        prior = F.when(number - F.lag(number).over(order) == 1, prior)
    return (
        months.withColumn("prior_month", prior)
        .select(
            "year",
            "month",
            "segment",
            "total_amount",
            "prior_month",
            percent(F.col("total_amount") - F.col("prior_month"), F.col("prior_month"), 2).alias(
                "mom_growth_pct"
            ),
        )
        .orderBy(F.asc_nulls_last("segment"), "year", "month")
    )


def top_customers_per_segment(fact: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """The biggest spenders of each segment; a customer counts in the segment of each version."""
    partial = fact.groupBy("customer_key").agg(
        F.sum("amount").alias("total"), F.count(F.lit(1)).alias("txns")
    )
    who = ["customer_id", "full_name", "segment"]
    spend = (
        partial.join(_known(customers).select("customer_key", *who), "customer_key")
        .groupBy(*who)
        .agg(F.sum("total").cast(MONEY).alias("total_spend"), F.sum("txns").alias("txn_count"))
    )
    best = W.partitionBy("segment").orderBy(F.desc("total_spend"), "customer_id", "full_name")
    return (
        spend.withColumn("rank_in_segment", F.row_number().over(best))
        .where(F.col("rank_in_segment") <= n)
        .orderBy(F.asc_nulls_last("segment"), "rank_in_segment")
    )


def segment_migration(dim: DataFrame) -> DataFrame:
    """How often customers moved from one segment to another between consecutive versions."""
    versions = W.partitionBy("customer_id").orderBy("valid_from")
    moves = _known(dim).select(
        F.col("segment").alias("from_segment"), F.lead("segment").over(versions).alias("to_segment")
    )
    return (
        moves.where(F.col("from_segment") != F.col("to_segment"))
        .groupBy("from_segment", "to_segment")
        .agg(F.count(F.lit(1)).alias("customers_moved"))
        .orderBy(F.desc("customers_moved"), "from_segment", "to_segment")
    )


def first_last_txn(fact: DataFrame, customers: DataFrame, limit: int | None = None) -> DataFrame:
    """First and last transaction of each customer, busiest customers first."""
    partial = fact.groupBy("customer_key").agg(
        F.min("transaction_ts").alias("first_ts"),
        F.max("transaction_ts").alias("last_ts"),
        F.count(F.lit(1)).alias("txns"),
    )
    answer = (
        partial.join(_known(customers).select("customer_key", "customer_id"), "customer_key")
        .groupBy("customer_id")
        .agg(
            F.min("first_ts").alias("first_txn"),
            F.max("last_ts").alias("last_txn"),
            F.sum("txns").alias("total_txns"),
        )
        .select(
            "customer_id",
            "first_txn",
            "last_txn",
            F.datediff(F.to_date("last_txn"), F.to_date("first_txn")).alias("days_active"),
            "total_txns",
        )
    )
    return _top(answer, [F.desc("total_txns"), "customer_id"], limit)


def cohort_retention(
    fact: DataFrame,
    customers: DataFrame,
    max_offset: int = 12,
    limit: int | None = None,
    by: str = "customer_key",
) -> DataFrame:
    """Share of each join-month cohort still transacting 0..max_offset months later.

    Activity is counted for the current version of a customer; ``by="customer_id"`` counts activity
    under every version. (customer, month) pairs are made distinct before any join, and one pass over
    them gives both the cohort size and the counts per offset.
    """
    cohorts = _known(customers).where("is_current AND join_date IS NOT NULL").select(
        "customer_key", "customer_id", calendar.month_start(F.col("join_date")).alias("cohort_month")
    )
    month = calendar.month_key(F.col("date_key")).alias("_month")
    active = fact.select("customer_key", month).distinct()
    if by == "customer_id":
        ids = _known(customers).select("customer_key", "customer_id")
        active = active.join(ids, "customer_key").select("customer_id", "_month").distinct()
    activity_month = F.make_date(
        F.floor(F.col("_month") / 100).cast("int"), (F.col("_month") % 100).cast("int"), F.lit(1)
    )
    offset = calendar.months_apart(activity_month, F.col("cohort_month"))
    per_customer = (
        active.join(cohorts, by)
        .withColumn("month_offset", offset.cast("int"))
        .groupBy("cohort_month", by)
        .agg(F.collect_set("month_offset").alias("offsets"))
    )
    # A customer has at most one offset per calendar month, so the gathered set is small.
    sized = per_customer.select(
        "cohort_month", F.explode(F.concat("offsets", F.array(F.lit(None).cast("int")))).alias("month_offset")
    )
    counts = sized.groupBy("cohort_month", "month_offset").agg(
        F.count(F.lit(1)).alias("active_customers")
    )
    size = F.max(F.when(F.col("month_offset").isNull(), F.col("active_customers"))).over(
        W.partitionBy("cohort_month")
    )
    answer = (
        counts.withColumn("cohort_size", size)
        .where(F.col("month_offset").between(0, max_offset))
        .select(
            "cohort_month",
            "cohort_size",
            "month_offset",
            "active_customers",
            percent(F.col("active_customers"), F.col("cohort_size"), 1).alias("retention_pct"),
        )
    )
    return _top(answer, ["cohort_month", "month_offset"], limit)


# --- accounts -----------------------------------------------------------------------------------


# Equal rows that are made at once.
TIES = 4096


def third_highest_amount(
    fact: DataFrame, accounts: DataFrame, n: int = 3, limit: int | None = None
) -> DataFrame:
    """Every transaction whose amount is its account's n-th highest distinct amount.

    Distinct amounts are counted and ranked (each map task passes on at most n per account). The ties of an
    amount are equal rows, so its count gives them back and the fact is read and shuffled once. They are
    made in pieces of TIES, which bounds what an amount with many ties holds in memory.
    """
    counted = fact.groupBy("account_key", "amount").agg(F.count(F.lit(1)).alias("_ties"))
    order = W.partitionBy("account_key").orderBy(F.desc("amount"))
    nth = counted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    nth = nth.where((F.col("_rank") == n) & F.col("amount").isNotNull()).drop("_rank")
    nth = nth.join(accounts.select("account_key", "account_id"), "account_key")
    if limit is not None:
        nth = nth.orderBy("account_id").limit(limit)
    pieces = nth.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("_ties") - 1) / TIES))))
    of_piece = F.least(F.lit(TIES), F.col("_ties") - F.col("_piece") * TIES)
    ties = pieces.withColumn("_tie", F.explode(F.sequence(F.lit(1), of_piece.cast("int"))))
    answer = ties.select("account_id", "amount", F.lit(n).alias("dense_rank"))
    return answer if limit is None else _top(answer, ["account_id"], limit)


def dedup_transactions(
    df: DataFrame, keys: list[str], order: list[str | Column], columns: list[str]
) -> DataFrame:
    """The earliest row of each key."""
    return first_per_key(df, keys, order).select(*columns)


def latest_txn_per_account(fact: DataFrame, accounts: DataFrame) -> DataFrame:
    """Each account's last transaction."""
    latest = latest_per_key(
        fact, ["account_key"], ["transaction_ts", "transaction_id"], ["amount", "channel"]
    )
    return _by_account(latest, accounts, ["transaction_ts", "transaction_id", "amount", "channel"])


def accounts_without_fraud(
    fact: DataFrame, accounts: DataFrame, limit: int | None = None
) -> DataFrame:
    """Accounts that never had a fraudulent transaction."""
    touched = fact.where("is_fraud").select("account_key").distinct()
    clean = _known(accounts, "account_id").join(touched, "account_key", "left_anti")
    return _top(clean.select("account_id", "product_type"), ["account_id"], limit)


def daily_activity(fact: DataFrame) -> DataFrame:
    """One row per account and day with any transaction."""
    return fact.select("account_key", calendar.key_to_date("date_key").alias("full_date")).distinct()


def activity_streaks(
    fact: DataFrame, accounts: DataFrame, min_days: int = 5, limit: int | None = None
) -> DataFrame:
    """Runs of consecutive active days, longest first.

    Days are made distinct before the window, so an account brings at most one row per calendar day.
    Within a run the date and the row number grow together; their difference names the run.
    """
    order = W.partitionBy("account_key").orderBy("full_date")
    runs = (
        daily_activity(fact)
        .withColumn("_run", F.date_sub("full_date", F.row_number().over(order)))
        .groupBy("account_key", "_run")
        .agg(
            F.min("full_date").alias("streak_start"),
            F.max("full_date").alias("streak_end"),
            F.count(F.lit(1)).alias("consecutive_days"),
        )
        .where(F.col("consecutive_days") >= min_days)
    )
    answer = _by_account(
        runs,
        accounts,
        [
            "streak_start",
            "streak_end",
            "consecutive_days",
            (F.datediff("streak_end", "streak_start") + 1).alias("span_check"),
        ],
    )
    return _top(answer, [F.desc("consecutive_days"), "account_id", "streak_start"], limit)


def inactivity_gaps(fact: DataFrame, accounts: DataFrame, min_days: int) -> DataFrame:
    """Breaks of at least ``min_days`` idle days between two active days of an account."""
    order = W.partitionBy("account_key").orderBy("full_date")
    gaps = (
        daily_activity(fact)
        .withColumn("last_active", F.lag("full_date").over(order))
        .withColumn("idle_days", F.datediff("full_date", "last_active") - 1)
        .where(F.col("idle_days") >= min_days)
    )
    return _by_account(
        gaps, accounts, ["last_active", F.col("full_date").alias("active_again"), "idle_days"]
    )


def dormant_accounts(
    fact: DataFrame, accounts: DataFrame, as_of: date, min_idle_days: int
) -> DataFrame:
    """Accounts idle for ``min_idle_days`` or more on ``as_of``, never-used ones included."""
    day = F.lit(as_of).cast("date")
    seen = fact.groupBy("account_key").agg(F.max("date_key").alias("_last"))
    last = calendar.key_to_date("_last")
    return (
        _known(accounts, "account_id")
        .join(seen, "account_key", "left")
        .select(
            "account_id",
            last.alias("last_active"),
            F.datediff(day, last).alias("idle_days"),
        )
        .where(F.col("last_active").isNull() | (F.col("idle_days") >= min_idle_days))
    )


def not_in(rows: DataFrame, column: str, excluded: DataFrame, excluded_column: str) -> DataFrame:
    """Rows whose value is NOT IN a set, with SQL's NULL rules.

    A NULL in the set leaves nothing, a NULL value is never kept, an empty set keeps everything. The
    set is reduced to one summary row and its distinct values, so neither side has to be broadcast.
    """
    members = excluded.select(F.col(excluded_column).alias(column)).distinct()
    size = members.agg(F.count(F.lit(1)).alias("n")).scalar()
    nulls = members.agg(F.count(F.when(F.col(column).isNull(), 1)).alias("n")).scalar()
    outside = rows.join(members.where(F.col(column).isNotNull()), column, "left_anti")
    return outside.where((size == 0) | ((nulls == 0) & F.col(column).isNotNull()))


# --- loans --------------------------------------------------------------------------------------


def delinquency_roll_rate(fact: DataFrame, strict_calendar: bool = False) -> DataFrame:
    """Share of each delinquency bucket that moved to each bucket a month later.

    A loan has one row per month, which bounds the first window; the second runs over one row per
    month and transition. The row compared with is the loan's last one; with ``strict_calendar`` it
    must be of the month before.
    """
    history = W.partitionBy("loan_id").orderBy("date_key")
    month_number = calendar.key_year(F.col("date_key")) * 12 + calendar.key_month(F.col("date_key"))
    moves = fact.select(
        *_date_parts(),
        month_number.alias("_number"),
        F.lag(month_number).over(history).alias("_prior_number"),
        F.lag("delinquency_bucket").over(history).alias("from_bucket"),
        F.col("delinquency_bucket").alias("to_bucket"),
        F.lag("outstanding_balance").over(history).alias("_balance"),
    ).where(F.col("from_bucket").isNotNull())
    if strict_calendar:
        moves = moves.where(F.col("_number") - F.col("_prior_number") == 1)
    counts = moves.groupBy("year", "month", "from_bucket", "to_bucket").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.round(F.sum("_balance"), 2).cast(MONEY).alias("balance_at_risk"),
    )
    cohort = F.sum("loan_count").over(W.partitionBy("year", "month", "from_bucket"))
    return counts.withColumn("roll_rate_pct", percent(F.col("loan_count"), cohort, 2)).orderBy(
        "year", "month", "from_bucket", "to_bucket"
    )


def vintage_analysis(loans: DataFrame) -> DataFrame:
    """Originations, scores and default rates per quarter, each compared with the quarter before.

    The unpartitioned window runs over one row per quarter.
    """
    vintages = loans.groupBy(
        F.year("origination_date").alias("vintage_year"),
        F.quarter("origination_date").alias("vintage_quarter"),
    ).agg(
        F.count(F.lit(1)).alias("loans_originated"),
        F.round(F.sum("principal"), 2).cast(MONEY).alias("total_originated"),
        F.sum("credit_score_at_origination").alias("_score"),
        F.count("credit_score_at_origination").alias("_scored"),
        F.count(F.when(F.col("defaulted"), 1)).alias("defaults"),
    )
    rated = vintages.select(
        "vintage_year",
        "vintage_quarter",
        "loans_originated",
        "total_originated",
        mean(F.col("_score"), F.col("_scored"), 1).alias("avg_score_at_origination"),
        "defaults",
        percent(F.col("defaults"), F.col("loans_originated"), 2).alias("default_rate_pct"),
    )
    order = W.orderBy("vintage_year", "vintage_quarter")
    rate, score = F.col("default_rate_pct"), F.col("avg_score_at_origination")
    return rated.select(
        "*",
        F.lag(rate).over(order).alias("prior_vintage_default_rate"),
        F.round(rate - F.lag(rate).over(order), 2).alias("default_rate_change"),
        F.round(score - F.lag(score).over(order), 1).alias("score_change"),
    ).orderBy("vintage_year", "vintage_quarter")


def vintage_curve(loan_months: DataFrame, loans: DataFrame) -> DataFrame:
    """Cumulative share of each origination quarter defaulted by each month on book.

    Loans are reduced to their first defaulted month before the join, and the curve is a running sum
    over one row per quarter and month on book.
    """
    reached = loan_months.groupBy("loan_id").agg(
        F.min(F.when(F.col("is_defaulted"), F.col("date_key"))).alias("_defaulted"),
        F.max("date_key").alias("_observed"),
    )
    first_month = F.col("origination_date")
    aged = loans.join(reached, "loan_id").select(
        F.year("origination_date").alias("vintage_year"),
        F.quarter("origination_date").alias("vintage_quarter"),
        calendar.months_apart(calendar.key_to_date("_defaulted"), first_month).alias("_age"),
        calendar.months_apart(calendar.key_to_date("_observed"), first_month).alias("_oldest"),
    )
    cohort = ["vintage_year", "vintage_quarter"]
    by_age = aged.groupBy(*cohort, "_age").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_oldest").alias("_oldest")
    )
    whole = W.partitionBy(*cohort)
    sized = by_age.select(
        *cohort,
        F.col("_age"),
        F.col("_n"),
        F.sum("_n").over(whole).alias("loans"),
        F.max("_oldest").over(whole).alias("_oldest"),
    )
    months = sized.groupBy(*cohort, "loans", "_oldest").agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("_age").isNotNull(), F.struct("_age", "_n")))
        ).alias("_defaults")
    )
    dense = months.select(
        *cohort,
        "loans",
        "_defaults",
        F.explode(F.sequence(F.lit(0), F.col("_oldest"))).alias("months_on_book"),
    )
    so_far = W.partitionBy(*cohort).orderBy("months_on_book").rowsBetween(W.unboundedPreceding, 0)
    at_age = F.coalesce(F.try_element_at("_defaults", F.col("months_on_book")), F.lit(0))
    curve = dense.withColumn("cumulative_defaults", F.sum(at_age).over(so_far))
    return curve.select(
        *cohort,
        "months_on_book",
        "loans",
        "cumulative_defaults",
        percent(F.col("cumulative_defaults"), F.col("loans"), 2).alias("cumulative_default_pct"),
    )


