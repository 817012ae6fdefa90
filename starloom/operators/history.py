"""Type 2 customer history: merge, point-in-time lookup and point-in-time join."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import attributes
from starloom.functions.keys import BEGINNING_OF_HISTORY, END_OF_TIME, UNKNOWN_KEY
from starloom.operators.dedup import refuse_duplicates

_FIRST_DAY = "0001-01-01"


def incoming_customers(staged: DataFrame) -> DataFrame:
    """The batch with its derived attributes and fingerprint."""
    typed = staged.withColumns(
        {
            "full_name": attributes.full_name(F.col("first_name"), F.col("last_name")),
            "age": F.col("age").cast("smallint"),
            "credit_score": F.col("credit_score").cast("smallint"),
            "credit_band": attributes.credit_band(F.col("credit_score")),
        }
    )
    tracked = [F.col(c) for c in attributes.TRACKED_CUSTOMER_COLUMNS]
    return typed.withColumn("row_hash", attributes.customer_row_hash(*tracked))


def merge_dim_customer(
    dim: DataFrame,
    staged: DataFrame,
    effective_date: date,
    initial: bool = False,
    load_ts: Column | None = None,
) -> DataFrame:
    """The next snapshot of the customer dimension.

    A changed customer's current version is closed at ``effective_date`` and a new one opened there;
    a customer never seen gets a version open from ``effective_date`` (from the beginning of history
    when ``initial``); all other rows pass through. Re-merging the same batch changes nothing.

    One full outer join produces every case, so the dimension is read and shuffled once and a chain
    of merges stays linear. History rows never match (they are not current) and pass through.
    Duplicate ids, the reserved id, and an effective date not after the version it would close fail
    the job.
    """
    stamp = F.current_timestamp() if load_ts is None else load_ts
    batch = refuse_duplicates(incoming_customers(staged), "customer_id", "batch")
    d = dim.withColumn("_old", F.lit(True)).alias("d")
    i = batch.withColumns({"_new": F.lit(True), "_stamp": stamp}).alias("i")
    same_customer = F.col("d.customer_id") == F.col("i.customer_id")
    both = d.join(i, same_customer & F.col("d.is_current"), "full_outer")

    day = f"DATE'{effective_date}'"
    changed = "(_old AND _new AND NOT (d.row_hash <=> i.row_hash))"
    refusal = "raise_error(concat('effective date not after valid_from of ', d.customer_id))"
    closing_day = f"if({day} > d.valid_from, {day}, CAST({refusal} AS DATE))"
    first_day = f"DATE'{BEGINNING_OF_HISTORY}'" if initial else day
    opened_on = f"if(_old, {day}, {first_day})"
    closing = {
        "valid_to": f"if({changed}, {closing_day}, d.valid_to)",
        "is_current": f"d.is_current AND NOT coalesce({changed}, false)",
        "updated_at": f"if({changed}, _stamp, d.updated_at)",
    }
    opening = {
        "customer_key": f"xxhash64(i.customer_id, {opened_on})",
        "valid_from": opened_on,
        "valid_to": f"DATE'{END_OF_TIME}'",
        "is_current": "true",
        "created_at": "_stamp",
        "updated_at": "_stamp",
    }
    old_row = schemas.struct_of(schemas.DIM_CUSTOMER, closing, "d.{name}")
    new_row = schemas.struct_of(schemas.DIM_CUSTOMER, opening, "i.{name}")
    versions = f"""array_compact(array(
        if(_old, {old_row}, NULL),
        if(_new AND (_old IS NULL OR {changed}), {new_row}, NULL)))"""
    return both.selectExpr(f"inline({versions})")


# --- point in time ------------------------------------------------------------------------------


def valid_on(day: Column, valid_from: Column | str, valid_to: Column | str) -> Column:
    """Half-open validity: the first day counts, the last does not."""
    start = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    end = F.col(valid_to) if isinstance(valid_to, str) else valid_to
    return (day >= start) & (day < end)


def point_in_time_customer(
    dim: DataFrame, as_of: date | Column, customer_id: str | None = None
) -> DataFrame:
    """The version of each customer (or of one) that was valid on ``as_of``."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    rows = dim.where(valid_on(day, "valid_from", "valid_to"))
    if customer_id is not None:
        rows = rows.where(F.col("customer_id") == customer_id)
    return rows.select(
        "customer_id", "full_name", "segment", "credit_score", "credit_band", "valid_from", "valid_to"
    )


def point_in_time_join(
    rows: DataFrame, dim: DataFrame, id_column: str, day: Column, attributes_: list[str]
) -> DataFrame:
    """Left join each row to the customer version valid on its day.

    An equi-join on the id with the range as a residual: hash or sort-merge, never a nested loop.
    Which one is left to the optimizer's runtime sizes, and a hot id to its skew splitting.
    """
    versions = dim.select(
        F.col("customer_id").alias("_id"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *attributes_,
    )
    match = (F.col(id_column) == F.col("_id")) & valid_on(F.col("_day"), "_from", "_to")
    joined = rows.withColumn("_day", day).join(versions, match, "left")
    return joined.drop("_id", "_from", "_to", "_day")


def gapless_versions(customers: DataFrame) -> DataFrame:
    """customer_id, customer_key, valid_from, valid_to covering every date of each known customer.

    Dates no version covers (before a late customer's first version, or between versions) get the
    unknown key. A join on these periods then always matches a known customer exactly once.
    A customer has at most one version per day, which bounds the window group.
    """
    order = W.partitionBy("customer_id").orderBy("valid_from")
    first_day, end = F.lit(_FIRST_DAY).cast("date"), F.lit(END_OF_TIME).cast("date")

    def period(key: Column, start: Column, stop: Column) -> Column:
        return F.when(
            start < stop,
            F.struct(
                key.cast("bigint").alias("customer_key"),
                start.alias("valid_from"),
                stop.alias("valid_to"),
            ),
        )

    unknown = F.lit(UNKNOWN_KEY)
    neighbours = customers.select(
        "customer_id",
        "customer_key",
        "valid_from",
        "valid_to",
        F.lag("valid_to", 1).over(order).alias("_prior_to"),
        F.lead("valid_from", 1).over(order).alias("_next_from"),
    )
    periods = F.array_compact(
        F.array(
            period(unknown, F.coalesce("_prior_to", first_day), F.col("valid_from")),
            period(F.col("customer_key"), F.col("valid_from"), F.col("valid_to")),
            F.when(F.col("_next_from").isNull(), period(unknown, F.col("valid_to"), end)),
        )
    )
    return neighbours.select("customer_id", F.inline(periods))


def account_owner_periods(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """account_id, account_key, customer_key, valid_from, valid_to covering every date.

    Joining the two dimensions first leaves the fact one join (and at most one shuffle) instead of
    an account lookup followed by a customer lookup.
    """
    owned = accounts.select("account_id", "account_key", "customer_id").join(
        gapless_versions(customers), "customer_id", "left"
    )
    return owned.select(
        "account_id",
        "account_key",
        F.coalesce("customer_key", F.lit(UNKNOWN_KEY)).cast("bigint").alias("customer_key"),
        F.coalesce("valid_from", F.lit(_FIRST_DAY).cast("date")).alias("valid_from"),
        F.coalesce("valid_to", F.lit(END_OF_TIME).cast("date")).alias("valid_to"),
    )
