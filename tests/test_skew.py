"""Chunked windows and percentiles against plain ones, with every key forced to be hot."""

import random
from datetime import datetime, timedelta
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators.percentiles import exact_percentiles, value_counts
from starloom.operators.skew import Columns, hot_keys, ordered_windows, value_windows, window_points, windows, with_pieces


@pytest.fixture(scope="module")
def rows(spark):
    """One key with a third of all rows, ties in time and amount, negative amounts."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(900):
        key = 1 if i % 3 == 0 else rng.randrange(2, 40)
        ts = start + timedelta(minutes=20 * rng.randrange(0, 90))
        amount = Decimal(rng.choice([999, 999, 1001, rng.randrange(-3000, 900_000)])) / 100
        data.append((key, ts, f"t{i:04d}", amount))
    return spark.createDataFrame(data, "key bigint, ts timestamp, id string, amount decimal(16,2)").cache()


def plain(df):
    order = W.partitionBy("key").orderBy("ts", "id")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    up = W.partitionBy("key").orderBy("amount", "ts", "id")
    down = W.partitionBy("key").orderBy(F.desc("amount"))
    return df.select(
        "*",
        F.row_number().over(order).alias("seq"),
        F.sum("amount").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("running"),
        F.lag("amount").over(order).alias("previous"),
        F.lead("amount").over(order).alias("following"),
        F.first("amount").over(whole).alias("first"),
        F.last("amount").over(whole).alias("last"),
        F.sum("amount").over(whole).alias("total"),
        F.sum("amount").over(order.rowsBetween(-6, 0)).alias("trailing_sum"),
        F.count("amount").over(order.rowsBetween(-6, 0)).alias("trailing_rows"),
        F.row_number().over(W.partitionBy("key").orderBy(F.desc("amount"), "ts", "id")).alias("position"),
        F.rank().over(down).alias("value_rank"),
        F.dense_rank().over(down).alias("value_dense_rank"),
        F.ntile(4).over(up).alias("tile"),
    )


ORDERED = ["seq", "running", "previous", "following", "first", "last", "total", "trailing_sum", "trailing_rows"]
VALUED = ["position", "value_rank", "value_dense_rank", "tile"]


@pytest.fixture(scope="module")
def gaps(rows):
    """The same rows with every fifth amount missing, one key without any, and times missing."""
    n = F.substring("id", 2, 4).cast("int")
    amount = F.when((n % 5 != 2) & (F.col("key") != 7), F.col("amount"))
    return rows.withColumns({"amount": amount, "ts": F.when(n % 50 != 9, F.col("ts"))}).cache()


@pytest.mark.parametrize("min_rows", [0, 3, 10**6])
def test_windows_over_missing_values_equal_plain_windows(gaps, min_rows):
    want = sorted(map(tuple, plain(gaps).select("id", *ORDERED, *VALUED).collect()))
    ordered = ordered_windows(gaps, "key", "ts", "id", "amount", trailing=7, min_rows=min_rows)
    both = value_windows(ordered, "key", "amount", "ts", "id", min_rows=min_rows)
    assert sorted(map(tuple, both.select("id", *ORDERED, *VALUED).collect())) == want


@pytest.mark.parametrize("min_rows", [0, 100, 10**6])
def test_ordered_windows_equal_plain_windows(rows, min_rows):
    got = ordered_windows(rows, "key", "ts", "id", "amount", trailing=7, min_rows=min_rows)
    keep = ["id", *ORDERED]
    assert sorted(got.select(keep).collect()) == sorted(plain(rows).select(keep).collect())


@pytest.mark.parametrize("min_rows", [0, 30, 100, 10**6])
def test_value_windows_equal_plain_windows(rows, min_rows):
    got = value_windows(rows, "key", "amount", "ts", "id", min_rows=min_rows)
    keep = ["id", *VALUED]
    assert sorted(got.select(keep).collect()) == sorted(plain(rows).select(keep).collect())


COLUMNS = Columns("key", "ts", "id", "amount")


@pytest.mark.parametrize("min_rows", [0, 3, 50, 10**6])
def test_both_orders_at_once_equal_plain_windows(rows, gaps, min_rows):
    for df in (rows, gaps):
        got = windows(df, COLUMNS, valued=True, trailing=7, min_rows=min_rows)
        want = plain(df).select("id", *ORDERED, *VALUED)
        assert sorted(map(tuple, got.select("id", *ORDERED, *VALUED).collect())) == sorted(map(tuple, want.collect()))


def pieces_of(df, points):
    cut = {"t": ("by_time", COLUMNS.by_time()), "v": ("by_value", COLUMNS.by_value())}
    return with_pieces(df, "key", points, cut, "inner")


@pytest.mark.parametrize("same", ["ts", "amount", "both"])
def test_a_key_of_one_timestamp_or_amount_is_cut(spark, same):
    """20,000 rows of one key with one midnight stamp, one fee, or both; pieces are even and answers those of a plain window."""
    stamp = F.lit("2024-01-01").cast("timestamp")
    ts = stamp if same != "amount" else stamp + F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 500)")
    amount = F.lit(9.99) if same != "ts" else (F.col("id") * 7919 % 1000) / 100
    key = F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id"))
    df = spark.range(30_000).select(key.alias("key"), ts.alias("ts"), F.concat(F.lit("t"), "id").alias("id"), amount.cast("decimal(16,2)").alias("amount"))
    points = window_points(df, COLUMNS, 1000).cache()
    for piece in ("t", "v"):
        sizes = [r["count"] for r in pieces_of(df, points).groupBy(piece).count().collect()]
        assert sum(sizes) == 20_000 and 15 <= len(sizes) <= 21 and max(sizes) < 3000
    got = windows(df, COLUMNS, points, valued=True, trailing=7).select("id", *ORDERED, *VALUED)
    want = plain(df).select("id", *ORDERED, *VALUED)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_points_of_an_older_state_change_no_answer(rows):
    points = window_points(rows.where("id < 't0300'"), COLUMNS, 10)
    got = windows(rows, COLUMNS, points, valued=True, trailing=7)
    want = plain(rows).select("id", *ORDERED, *VALUED)
    assert sorted(map(tuple, got.select("id", *ORDERED, *VALUED).collect())) == sorted(map(tuple, want.collect()))


def test_empty_rows_and_no_hot_keys(rows):
    points = window_points(rows, COLUMNS)
    assert points.count() == 0
    assert windows(rows.limit(0), COLUMNS, points, valued=True, trailing=7).count() == 0


def test_only_the_busy_key_is_hot(rows):
    assert [r.key for r in hot_keys(rows, "key", 100).collect()] == [1]


def expected_percentile(values, p, kind):
    values = sorted(values)
    if kind == "disc":
        return values[max(-(-p * len(values) // 1) - 1, 0)]
    place = p * (len(values) - 1)
    low = int(place)
    part = place - low
    return values[low] + part * (values[min(low + 1, len(values) - 1)] - values[low])


@pytest.mark.parametrize("kind", ["cont", "disc"])
def test_percentiles_equal_brute_force(rows, kind):
    marks = {"median": "0.5", "p90": "0.9", "p99": "0.99", "lowest": "0", "highest": "1"}
    counts = value_counts(rows, "key", "amount")
    got = {r.key: r for r in exact_percentiles(counts, "key", "amount", marks, kind).collect()}
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.key, []).append(Fraction(r.amount))
    assert set(got) == set(groups)
    for key, values in groups.items():
        for name, p in marks.items():
            assert Fraction(got[key][name]) == expected_percentile(values, Fraction(p), kind), (key, name)


def test_percentiles_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "g string, v int").withColumn(
        "v", F.col("v").cast("decimal(16,2)")
    )
    got = exact_percentiles(value_counts(df, "g", "v"), "g", "v", {"median": "0.5"}).collect()
    assert {(r.g, float(r.median)) for r in got} == {(None, 2.0), ("a", 5.0)}
