"""Data-quality checks. Each returns the violating rows; empty means the check passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.keys import UNKNOWN_ID, UNKNOWN_KEY
from starloom.operators.history import valid_on


def check_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values of the grain that occur more than once (NULLs compare equal), with their row count.

    The count is combined map-side, so a key with many copies is no hot spot.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def check_one_current(dim: DataFrame) -> DataFrame:
    """Customers with more than one current version."""
    return check_unique(dim.where("is_current"), ["customer_id"])


def check_validity_order(dim: DataFrame) -> DataFrame:
    """Versions that do not end after they start."""
    return dim.where(~(F.col("valid_to") > F.col("valid_from"))).select(
        "customer_id", "valid_from", "valid_to"
    )


def check_scd2_overlap(dim: DataFrame) -> DataFrame:
    """Customers with two versions covering a common day.

    Versions starting on the same day are combined first, so that a customer brings at most one row
    per day to the window; then each start is compared with the latest end before it. One shuffle,
    where a self-join would need the pairs of each customer.
    """
    starts = dim.groupBy("customer_id", "valid_from").agg(
        F.max("valid_to").alias("valid_to"),
        F.count(F.when(F.col("valid_to") > F.col("valid_from"), 1)).alias("_covering"),
    )
    earlier = (
        W.partitionBy("customer_id").orderBy("valid_from").rowsBetween(W.unboundedPreceding, -1)
    )
    clash = (F.max("valid_to").over(earlier) > F.col("valid_from")) | (F.col("_covering") > 1)
    return (
        starts.withColumn("_clash", F.coalesce(clash, F.col("_covering") > 1))
        .where("_clash")
        .select("customer_id")
        .distinct()
    )


def check_pit_unique(dim: DataFrame, days: DataFrame, id_column: str, day_column: str) -> DataFrame:
    """(customer, day) pairs that do not meet exactly one version, with the number they meet.

    Pairs are made distinct first, so a busy customer costs one row per day.
    """
    pairs = days.select(F.col(id_column).alias("customer_id"), F.col(day_column).alias("day")).distinct()
    versions = dim.select(F.col("customer_id").alias("_id"), "valid_from", "valid_to")
    met = (F.col("customer_id") == F.col("_id")) & valid_on(F.col("day"), "valid_from", "valid_to")
    return (
        pairs.join(versions, met, "left")
        .groupBy("customer_id", "day")
        .agg(F.count("_id").alias("versions"))
        .where(F.col("versions") != 1)
    )


def check_foreign_keys(df: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """fk, key, rows: key values that the referenced column does not hold.

    ``references`` maps a column of ``df`` to (dimension, column). All keys are counted in one scan
    with map-side combining; only distinct keys meet the dimensions.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("key"))
            for fk in references
        ]
    )
    used = df.select(F.inline(pairs)).groupBy("fk", "key").agg(F.count(F.lit(1)).alias("rows"))
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(fk).alias("fk"), F.col(column).cast("string").alias("key"))
            for fk, (dim, column) in references.items()
        ],
    )
    return used.where(F.col("key").isNotNull()).join(known, ["fk", "key"], "left_anti")


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, null_rows for the columns that hold NULLs; one pass over the data."""
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]
    )
    return nulls.select(F.inline(pairs)).where(F.col("null_rows") > 0)


# --- all constraints of a fact at once ------------------------------------------------------------------


@dataclass(frozen=True)
class FactRule:
    """What a fact is declared with: columns that are never empty, its grain, and the keys that dimensions hold."""

    not_null: tuple[str, ...]
    grain: tuple[str, ...]
    foreign_keys: tuple[str, ...]


def _all_but_load(schema) -> tuple[str, ...]:
    return tuple(c for c in schema.fieldNames() if c != "load_id")


FACT_RULES = {
    "fact_transactions": FactRule(
        _all_but_load(schemas.FACT_TRANSACTIONS),
        ("transaction_id",),
        ("date_key", "account_key", "customer_key", "merchant_category_key"),
    ),
    "fact_daily_balances": FactRule(
        _all_but_load(schemas.FACT_DAILY_BALANCES),
        ("date_key", "account_key"),
        ("date_key", "account_key", "customer_key"),
    ),
    "fact_loan_monthly": FactRule(
        _all_but_load(schemas.FACT_LOAN_MONTHLY),
        ("date_key", "loan_id"),
        ("date_key", "customer_key", "loan_product_key"),
    ),
}


# Keys of the calendar and of fixed lookups: a fact has few combinations of them.
FEW_KEYS = ("date_key", "merchant_category_key", "loan_product_key")


def constraint_violations(
    fact: DataFrame,
    table: str,
    rule: FactRule,
    references: dict[str, tuple[DataFrame, str]],
    grain: DataFrame | None = None,
) -> DataFrame:
    """table_name, constraint_name, columns, keys, rows: what breaks the rule, by constraint; empty means all hold.

    One scan: rows are counted by their grain, by their keys of large dimensions, and by those of small ones with which of their
    columns are empty, as grouping sets that are combined map-side by typed values. Single keys are made of these counts, and
    only values that occur meet the dimensions; ``references`` maps a key to (dimension, column). An empty key breaks NOT NULL,
    neither the reference nor the grain. ``keys`` are the distinct values that break a constraint, ``rows`` the rows that have
    them. ``grain`` may hold the grain of the same rows in a layout that groups without a shuffle; it is counted there then,
    not in the fact.
    """
    empty = reduce(lambda x, y: x + y, [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(rule.not_null)])
    counted = rule.grain if grain is None else ()
    by = [*dict.fromkeys([*counted, *rule.foreign_keys]), "_empty"]
    few = [*[c for c in rule.foreign_keys if c in FEW_KEYS], "_empty"]
    many = [c for c in rule.foreign_keys if c not in FEW_KEYS]
    sets = {frozenset(s) for s in [counted, many, few] if s}

    def in_set(*columns: str) -> Column:
        """Whether a count belongs to the set of these columns: the grouping id has a bit for each other column."""
        return F.col("_set") == sum(1 << i for i, c in enumerate(reversed(by)) if c not in columns)

    rows = fact.withColumn("_empty", empty).select(*by)
    used = rows.groupingSets([[F.col(c) for c in by if c in s] for s in sets], *by)
    used = used.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("rows"))
    if counted and set(rule.grain) != set(many):
        # Values of a grain that occur once are gone before anything is made of them.
        used = used.where(~in_set(*rule.grain) | (F.col("rows") > 1))
    text = {c: F.col(c).cast("string") for c in [*by, *rule.grain]}
    whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in rule.grain])
    entry = lambda name, columns, key: F.struct(
        F.lit(name).alias("constraint_name"), F.lit(columns).alias("columns"), key.alias("key"), F.col("rows")
    )
    twice = entry("unique", ",".join(rule.grain), F.concat_ws("|", *[text[c] for c in rule.grain]))
    entries = [F.when(in_set(*rule.grain) & whole & (F.col("rows") > 1), twice)] if counted else []
    among = {c: in_set(*(few if c in few else many)) for c in rule.foreign_keys}
    entries += [F.when(among[c] & F.col(c).isNotNull(), entry("foreign key", c, text[c])) for c in rule.foreign_keys]
    missing = [in_set(*few) & (F.col("_empty").bitwiseAND(F.lit(1 << i)) != 0) for i in range(len(rule.not_null))]
    entries += [F.when(m, entry("not null", c, F.lit(None).cast("string"))) for m, c in zip(missing, rule.not_null)]
    suspects = used.select(F.inline(F.array_compact(F.array(*entries))))
    if grain is not None:
        values = grain.groupBy(*rule.grain).agg(F.count(F.lit(1)).alias("rows")).where(whole & (F.col("rows") > 1))
        suspects = suspects.unionByName(values.select(F.inline(F.array(twice))))
    held = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit("foreign key").alias("constraint_name"), F.lit(c).alias("columns"), F.col(column).cast("string").alias("key"))
            for c, (dim, column) in references.items()
        ],
    )
    # A key was counted beside others; values of a grain were not, and two of them may read alike.
    values = F.when(F.col("constraint_name") == "unique", F.count(F.lit(1))).otherwise(F.lit(1).cast("bigint"))
    once = suspects.groupBy("constraint_name", "columns", "key").agg(F.sum("rows").alias("rows"), values.alias("_values"))
    # Keys of a dimension are joined once.
    broken = once.join(held, ["constraint_name", "columns", "key"], "left_anti")
    return broken.groupBy(F.lit(table).alias("table_name"), "constraint_name", "columns").agg(
        F.sum("_values").alias("keys"), F.sum("rows").alias("rows")
    )


def unknown_member_rate(fact: DataFrame, keys: list[str]) -> DataFrame:
    """fk, unknown_rows, total_rows: how much of the fact points at an unknown member."""
    counts = fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(F.when(F.col(k) == UNKNOWN_KEY, 1)).alias(k) for k in keys],
    )
    pairs = F.array(*[F.struct(F.lit(k).alias("fk"), F.col(k).alias("unknown_rows")) for k in keys])
    return counts.select("total_rows", F.inline(pairs)).select("fk", "unknown_rows", "total_rows")


def reconcile_totals(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """One row comparing rows and money of the source with the fact built from it."""
    sides = staged.select(F.lit("staged").alias("side"), "amount").unionByName(
        fact.select(F.lit("fact").alias("side"), "amount")
    )

    def rows(side: str):
        return F.count(F.when(F.col("side") == side, 1))

    def money(side: str):
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("amount"))), F.lit(0)).cast(
            "decimal(38,2)"
        )

    return sides.agg(
        rows("staged").alias("staged_rows"),
        rows("fact").alias("fact_rows"),
        money("staged").alias("staged_amount"),
        money("fact").alias("fact_amount"),
    ).withColumns(
        {
            "row_difference": F.col("staged_rows") - F.col("fact_rows"),
            "amount_difference": (F.col("staged_amount") - F.col("fact_amount")).cast("decimal(38,2)"),
        }
    )


def unknown_members(dimensions: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """dimension, natural_key, members: the unknown rows of (dimension, key column, natural column)."""
    parts = [
        dim.where(F.col(key) == UNKNOWN_KEY).select(
            F.lit(name).alias("dimension"), F.col(natural).alias("natural_key")
        )
        for name, (dim, key, natural) in dimensions.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("dimension", "natural_key")
        .agg(F.count(F.lit(1)).alias("members"))
    )


__all__ = [
    "UNKNOWN_ID",
    "check_foreign_keys",
    "check_not_null",
    "check_one_current",
    "check_pit_unique",
    "check_scd2_overlap",
    "check_unique",
    "check_validity_order",
    "constraint_violations",
    "reconcile_totals",
    "unknown_member_rate",
    "unknown_members",
]
