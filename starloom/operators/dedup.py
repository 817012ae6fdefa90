"""Keep one row per key, and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in ``order``.

    The optimizer limits each map task to one row per key before the shuffle, so a key with a third
    of all rows sends only one row per task. ``order`` should be total up to equal rows.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """The last row of each key as one map-side combined maximum over (order, kept columns)."""
    latest = df.groupBy(*keys).agg(F.max(F.struct(*order, *keep)).alias("_row"))
    return latest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [*order, *keep]])


def insert_if_absent(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``existing`` plus those of ``rows`` whose key it does not have; existing rows always win."""
    absent = rows.join(existing.select(key), key, "left_anti")
    return existing.unionByName(absent.select(*existing.columns))


def refuse_duplicates(df: DataFrame, key: str, what: str) -> DataFrame:
    """Fail the job on a second row of a key, a missing key, or the reserved unknown id.

    The check filters nothing out: it streams (no group is buffered) and leaves the key column as it is, so its shuffle
    and sort are the ones the following join on the key needs anyway.
    """
    second = F.row_number().over(W.partitionBy(key).orderBy(key)) > 1
    checked = F.expr(
        f"""CASE WHEN {key} IS NULL THEN CAST(raise_error('missing {key} in {what}') AS BOOLEAN)
                 WHEN _second THEN CAST(raise_error(concat('duplicate {key} in {what}: ', {key})) AS BOOLEAN)
                 WHEN {key} = '-1' THEN CAST(raise_error('reserved {key} in {what}') AS BOOLEAN)
                 ELSE true END"""
    )
    return df.withColumn("_second", second).where(checked).drop("_second")
