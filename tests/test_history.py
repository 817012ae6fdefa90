"""Type 2 customer history on hand-made batches."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import attributes
from starloom.operators import dimensions, history, quality

ADA_1 = ("CUST_TEST01", "Ada", "L", 36, 80000, 660, 0.30, "mass", date(2020, 1, 15), "BR_1")
ADA_2 = ("CUST_TEST01", "Ada", "L", 36, 145000, 745, 0.20, "affluent", date(2020, 1, 15), "BR_1")
BOB = ("CUST_TEST02", "Bob", "M", None, None, None, None, None, None, None)
END = date(9999, 12, 31)


def batch(spark, *rows):
    cells = [
        (r[0], r[1], r[2], r[3], None if r[4] is None else Decimal(r[4]), r[5],
         None if r[6] is None else Decimal(str(r[6])), *r[7:])
        for r in rows
    ]
    return spark.createDataFrame(cells, schemas.STAGING["customers"])


def merged(spark, *steps):
    """Apply (rows, date, initial) steps to an empty dimension."""
    dim = dimensions.unknown_customer(spark)
    for rows, day, initial in steps:
        dim = history.merge_dim_customer(dim, batch(spark, *rows), day, initial)
    return dim


def versions(dim, customer="CUST_TEST01"):
    rows = dim.where(F.col("customer_id") == customer).orderBy("valid_from").collect()
    return [(r.segment, r.valid_from, r.valid_to, r.is_current) for r in rows]


INITIAL = ([ADA_1], date(2024, 1, 1), True)
UNCHANGED = ([ADA_1], date(2024, 2, 1), False)
CHANGE = ([ADA_2], date(2024, 3, 15), False)


def test_initial_load_is_valid_from_the_beginning(spark):
    assert versions(merged(spark, INITIAL)) == [("mass", date(1900, 1, 1), END, True)]


def test_unchanged_batch_is_a_noop(spark):
    once = merged(spark, INITIAL)
    twice = merged(spark, INITIAL, UNCHANGED)
    assert once.drop("created_at", "updated_at").collect() == twice.drop("created_at", "updated_at").collect()


def test_change_closes_and_opens(spark):
    assert versions(merged(spark, INITIAL, UNCHANGED, CHANGE)) == [
        ("mass", date(1900, 1, 1), date(2024, 3, 15), False),
        ("affluent", date(2024, 3, 15), END, True),
    ]


def test_derived_attributes(spark):
    dim = merged(spark, ([ADA_1, BOB], date(2024, 1, 1), False))
    ada, bob = dim.where("customer_id <> '-1'").orderBy("customer_id").collect()
    assert (ada.full_name, ada.credit_band, bob.credit_band) == ("Ada L", "fair", "poor")
    assert ada.valid_from == date(2024, 1, 1)


def test_customer_absent_from_batch_stays_current(spark):
    dim = merged(spark, ([ADA_1, BOB], date(2024, 1, 1), True), CHANGE)
    assert versions(dim, "CUST_TEST02") == [(None, date(1900, 1, 1), END, True)]


def test_initial_on_known_customer_opens_at_the_effective_date(spark):
    dim = merged(spark, INITIAL, ([ADA_2, BOB], date(2024, 3, 15), True))
    assert versions(dim)[1][1] == date(2024, 3, 15)
    assert versions(dim, "CUST_TEST02")[0][1] == date(1900, 1, 1)
    assert quality.check_scd2_overlap(dim).count() == 0


def test_join_date_alone_is_not_a_change(spark):
    moved = (*ADA_1[:8], date(2021, 1, 1), "BR_1")
    assert len(versions(merged(spark, INITIAL, ([moved], date(2024, 2, 1), False)))) == 1


@pytest.mark.parametrize(
    "rows, day, message",
    [
        ([ADA_2], date(1900, 1, 1), "effective date not after valid_from"),
        ([ADA_1, ADA_2], date(2024, 5, 1), "duplicate customer_id"),
        ([("-1", *ADA_1[1:])], date(2024, 5, 1), "reserved customer_id"),
        ([(None, *ADA_1[1:])], date(2024, 5, 1), "missing customer_id"),
    ],
)
def test_refused_batches(spark, rows, day, message):
    dim = merged(spark, INITIAL, (rows, day, False))
    with pytest.raises(PySparkException, match=message):
        dim.collect()


@pytest.mark.parametrize(
    "day, segment",
    [
        (date(2024, 2, 1), "mass"),
        (date(2024, 3, 14), "mass"),
        (date(2024, 3, 15), "affluent"),
        (date(2024, 12, 1), "affluent"),
    ],
)
def test_point_in_time_gives_exactly_one_version(spark, day, segment):
    dim = merged(spark, INITIAL, CHANGE)
    rows = history.point_in_time_customer(dim, day, "CUST_TEST01").collect()
    assert [r.segment for r in rows] == [segment]


def test_quality_checks_pass_on_merged_and_fail_on_broken_history(spark):
    dim = merged(spark, INITIAL, CHANGE)
    for check in (quality.check_one_current, quality.check_scd2_overlap, quality.check_validity_order):
        assert check(dim).count() == 0
    second = dim.where("is_current").withColumn("customer_key", F.lit(7).cast("bigint"))
    broken = dim.unionByName(second)
    assert {r.customer_id for r in quality.check_one_current(broken).collect()} == {"CUST_TEST01", "-1"}
    assert {r.customer_id for r in quality.check_scd2_overlap(broken).collect()} == {"CUST_TEST01", "-1"}
    upside_down = dim.withColumn("valid_to", F.col("valid_from"))
    assert quality.check_validity_order(upside_down).count() == 3


def test_row_hash_survives_nulls(spark):
    nulls = [F.lit(None).cast("string")] * 8
    row = spark.range(1).select(attributes.customer_row_hash(F.lit("A"), *nulls).alias("h")).first()
    assert row.h is not None and len(row.h) == 32


def test_gapless_versions_cover_every_day_once(spark):
    dim = merged(spark, ([ADA_1], date(2024, 2, 1), False), CHANGE)
    periods = history.gapless_versions(dim.where("customer_id <> '-1'")).orderBy("valid_from").collect()
    assert [(p.customer_key == -1, p.valid_from, p.valid_to) for p in periods] == [
        (True, date(1, 1, 1), date(2024, 2, 1)),
        (False, date(2024, 2, 1), date(2024, 3, 15)),
        (False, date(2024, 3, 15), END),
    ]


def test_segment_migration_counts_moves(spark):
    from starloom.plans.analytics import segment_migration

    back = ([ADA_1], date(2024, 4, 1), False)
    moves = segment_migration(merged(spark, INITIAL, CHANGE, back)).collect()
    assert {(r.from_segment, r.to_segment, r.customers_moved) for r in moves} == {
        ("mass", "affluent", 1),
        ("affluent", "mass", 1),
    }
