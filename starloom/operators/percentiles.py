"""Exact percentiles without gathering a group's values in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators.skew import magnitude_chunk

_CHUNK = "_chunk"


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """How often each value (NULLs aside) occurs in each group; combined map-side."""
    present = df.where(F.col(value).isNotNull())
    return present.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))


def exact_percentiles(
    counts: DataFrame, group: str, value: str, fractions: dict[str, str], kind: str = "cont"
) -> DataFrame:
    """One row per group with a decimal column for each named fraction.

    ``counts`` comes from :func:`value_counts`. Value ranges are counted first (some thousand ranges
    per group at most), which tells for each wanted rank the one range that holds it; only the
    distinct values of those ranges are ordered. ``cont`` interpolates between the two ranks around
    the position, ``disc`` takes the first value whose share of rows reaches the fraction.
    """
    ranged = counts.withColumn(_CHUNK, magnitude_chunk(value).cast("bigint"))
    ranges = ranged.groupBy(group, _CHUNK).agg(F.sum("_n").alias("_in_range"))
    order = W.partitionBy(group).orderBy(_CHUNK)
    total = F.sum("_in_range").over(W.partitionBy(group))
    before = F.sum("_in_range").over(order.rowsBetween(W.unboundedPreceding, -1))
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(Decimal(p)).cast("decimal(9,6)").alias("p"))
            for name, p in fractions.items()
        ]
    )
    targets = (
        ranges.select(
            group, _CHUNK, "_in_range", F.coalesce(before, F.lit(0)).alias("_before"), total.alias("_total")
        ).select("*", F.inline(wanted))
    )
    if kind == "cont":
        place = F.col("p") * (F.col("_total") - 1).cast("decimal(20,0)")
        targets = targets.withColumn("_low", F.floor(place).cast("bigint")).withColumns(
            {
                "_part": (place - F.col("_low").cast("decimal(20,0)")).cast("decimal(9,6)"),
                "_high": F.ceil(place).cast("bigint"),
            }
        )
    else:
        rank = F.ceil(F.col("p") * F.col("_total").cast("decimal(20,0)")).cast("bigint")
        targets = targets.withColumn("_low", F.greatest(rank - 1, F.lit(0))).withColumns(
            {"_part": F.lit(0).cast("decimal(9,6)"), "_high": F.col("_low")}
        )
    end = F.col("_before") + F.col("_in_range")
    holds = (F.col("_low") < end) & (F.col("_high") >= F.col("_before"))
    targets = targets.where(holds)

    located = targets.select(group, _CHUNK, "_before").distinct()
    inside = W.partitionBy(group, _CHUNK).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (
        _join_groups(ranged, located, group)
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
        .select(group, _CHUNK, value, (F.col("_upto") - F.col("_n")).alias("_from"), "_upto")
    )
    t = targets.select(group, _CHUNK, "name", "_low", "_high", "_part")
    picked = _join_groups(placed, t, group)

    def at(rank: str):
        return F.max(
            F.when((F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_upto")), F.col(value))
        )

    ends = picked.groupBy(group, "name", "_part").agg(at("_low").alias("_a"), at("_high").alias("_b"))
    answer = F.col("_a") + F.col("_part") * (F.col("_b") - F.col("_a"))
    return ends.groupBy(group).agg(
        *[F.max(F.when(F.col("name") == name, answer)).alias(name) for name in fractions]
    )


def _join_groups(left: DataFrame, right: DataFrame, group: str) -> DataFrame:
    """Join on (group, range) where a NULL group is a group like any other.

    Null-safe on the range too: a plain equality would push a NOT NULL test below the counting on
    this branch only, and the counts would no longer be shared with the other branches.
    """
    r = right.withColumnRenamed(group, "_group").withColumnRenamed(_CHUNK, "_range")
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(_CHUNK).eqNullSafe(F.col("_range"))
    return left.join(r, same).drop("_group", "_range")
