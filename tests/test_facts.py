"""Fact builders on small hand-made stars."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import dimensions, facts, history, quality
from starloom.sources import sample

D = Decimal


def transactions(spark, *rows):
    return spark.createDataFrame(
        [(i, a, t, D(str(m)), c, "online", fraud) for i, a, t, m, c, fraud in rows],
        schemas.STAGING["transactions"],
    )


@pytest.fixture(scope="module")
def star(spark):
    """Account A1 of customer C1 (two versions), A2 of C2 (known from 2024-02-01), A3 of nobody."""

    def batch(*rows):
        return spark.createDataFrame(
            [(i, "F", "L", 30, D(1000), score, D("0.1"), segment, date(2023, 1, 1), "B") for i, score, segment in rows],
            schemas.STAGING["customers"],
        )

    customers = dimensions.unknown_customer(spark)
    customers = history.merge_dim_customer(customers, batch(("C1", 700, "mass")), date(2024, 1, 1), True)
    customers = history.merge_dim_customer(
        customers, batch(("C1", 750, "affluent"), ("C2", 600, "mass")), date(2024, 2, 1)
    )
    staged = spark.createDataFrame(
        [
            (a, c, "checking", D("0.01"), opened, "active", opening)
            for a, c, opened, opening in [
                ("A1", "C1", date(2024, 1, 10), D(100)),
                ("A2", "C2", None, None),
                ("A3", "C404", date(2024, 2, 20), D(5)),
            ]
        ],
        schemas.STAGING["accounts"],
    )
    return {
        "dates": dimensions.dim_date(spark),
        "accounts": dimensions.merge_dim_account(dimensions.unknown_account(spark), staged),
        "customers": customers,
        "categories": dimensions.merchant_category_seed(spark),
    }


def named(fact, star):
    """transaction_id -> (account, customer, segment, category, amount)."""
    joined = (
        fact.join(star["accounts"].select("account_key", "account_id"), "account_key")
        .join(star["customers"].select("customer_key", F.col("customer_id").alias("who"), "segment"), "customer_key")
        .join(star["categories"].select("merchant_category_key", "category_code"), "merchant_category_key")
    )
    return {r.transaction_id: (r.account_id, r.who, r.segment, r.category_code, r.amount) for r in joined.collect()}


JAN, FEB = datetime(2024, 1, 31, 23, 59), datetime(2024, 2, 1, 0, 0)


def test_lookups_and_unknown_members(spark, star):
    staged = transactions(
        spark,
        ("t1", "A1", JAN, 1, "grocery", False),
        ("t2", "A1", FEB, 2, "grocery", False),
        ("t3", "A404", FEB, 3, "grocery", False),
        ("t4", "A3", FEB, 4, "grocery", False),
        ("t5", "A1", FEB, 5, "nope", True),
        ("t6", "A2", JAN, 6, "atm_withdrawal", False),
        ("t7", "A2", FEB, 7, None, False),
        ("t8", None, FEB, 8, "gas", False),
        ("t9", "A1", datetime(2019, 12, 31), 9, "gas", False),
    )
    fact = facts.fact_transactions(staged, **star, load_id=42)
    assert named(fact, star) == {
        "t1": ("A1", "C1", "mass", "grocery", D("1.00")),
        "t2": ("A1", "C1", "affluent", "grocery", D("2.00")),
        "t3": ("-1", "-1", None, "grocery", D("3.00")),
        "t4": ("A3", "-1", None, "grocery", D("4.00")),
        "t5": ("A1", "C1", "affluent", "unknown", D("5.00")),
        "t6": ("A2", "-1", None, "atm_withdrawal", D("6.00")),
        "t7": ("A2", "C2", "mass", "unknown", D("7.00")),
        "t8": ("-1", "-1", None, "gas", D("8.00")),
    }
    first = fact.where("transaction_id = 't1'").first()
    assert (first.date_key, first.hour_of_day, first.load_id) == (20240131, 23, 42)
    assert fact.schema.fieldNames() == schemas.FACT_TRANSACTIONS.fieldNames()
    # The day outside the calendar is missing, and reconciliation shows it.
    gap = quality.reconcile_totals(staged, fact).first()
    assert (gap.row_difference, gap.amount_difference) == (1, D("9.00"))


def test_duplicates_keep_the_earliest(spark, star):
    staged = transactions(
        spark,
        ("t1", "A1", FEB, 5, "grocery", False),
        ("t1", "A1", JAN, 7, "grocery", False),
        ("t1", "A1", JAN, 6, "grocery", False),
    )
    assert named(facts.fact_transactions(staged, **star), star)["t1"][4] == D("6.00")


def test_loaded_ids_are_skipped(spark, star):
    first = facts.fact_transactions(transactions(spark, ("t1", "A1", JAN, 1, "gas", False)), **star)
    both = transactions(spark, ("t1", "A1", FEB, 9, "gas", False), ("t2", "A1", FEB, 2, "gas", False))
    again = facts.fact_transactions(both, **star, existing=first)
    assert [r.transaction_id for r in again.collect()] == ["t2"]


def test_plain_point_in_time_join_agrees_with_the_fact(spark, star):
    staged = transactions(
        spark, *[(f"t{d}", "A1", datetime(2024, 1, 1) + timedelta(days=d), d, "gas", False) for d in range(60)]
    )
    fact = facts.fact_transactions(staged, **star).select("transaction_id", "customer_key")
    ids = staged.withColumn("who", F.lit("C1"))
    joined = history.point_in_time_join(ids, star["customers"], "who", F.to_date("timestamp"), ["customer_key"])
    assert sorted(fact.collect()) == sorted(joined.select("transaction_id", "customer_key").collect())


def brute_force_balances(rows, opened, end):
    """account -> day -> (closing, debits, credits, count), by walking every day."""
    answer = {}
    for account, (first_day, opening) in opened.items():
        own = defaultdict(list)
        for a, day, amount in rows:
            if a == account:
                own[day].append(amount)
        if first_day is None:
            if not own:
                continue
            first_day = min(own)
        balance = opening + sum(sum(v) for d, v in own.items() if d < first_day)
        day = first_day
        while day <= end:
            moves = own.get(day, [])
            balance += sum(moves)
            answer[account, day] = (
                balance,
                sum((-m for m in moves if m < 0), D(0)),
                sum((m for m in moves if m > 0), D(0)),
                len(moves),
            )
            day += timedelta(days=1)
    return answer


def test_daily_balances_equal_a_day_by_day_walk(spark, star):
    rng = random.Random(3)
    rows = []
    for n in range(120):
        account = rng.choice(["A1", "A1", "A2", "A404"])
        day = date(2024, 1, 1) + timedelta(days=rng.randrange(0, 70))
        rows.append((account, day, D(rng.randrange(-5000, 5000)) / 100))
    staged = transactions(
        spark,
        *[(f"t{n}", a, datetime(d.year, d.month, d.day, 12), m, "gas", False) for n, (a, d, m) in enumerate(rows)],
    )
    fact = facts.fact_transactions(staged, **star)
    end = date(2024, 3, 5)
    balances = facts.fact_daily_balances(fact, star["accounts"], star["customers"], end)
    assert balances.schema.fieldNames() == schemas.FACT_DAILY_BALANCES.fieldNames()
    assert quality.check_unique(balances, ["date_key", "account_key"]).count() == 0
    got = {}
    owners = defaultdict(set)
    joined = balances.join(star["accounts"].select("account_key", "account_id"), "account_key").join(
        star["customers"].select("customer_key", F.col("customer_id").alias("who"), "valid_from"), "customer_key"
    )
    for r in joined.collect():
        day = datetime.strptime(str(r.date_key), "%Y%m%d").date()
        got[r.account_id, day] = (r.closing_balance, r.total_debits, r.total_credits, r.transaction_count)
        owners[r.account_id].add((r.who, day >= date(2024, 2, 1)))
    opened = {"A1": (date(2024, 1, 10), D(100)), "A2": (None, D(0)), "A3": (date(2024, 2, 20), D(5)), "-1": (None, D(0))}
    moved = [("-1" if a == "A404" else a, d, m) for a, d, m in rows]
    assert got == brute_force_balances(moved, opened, end)
    assert owners["A2"] == {("-1", False), ("C2", True)}
    assert owners["A3"] == {("-1", True)}


def test_daily_balances_from_a_start_day(spark, star):
    staged = transactions(
        spark, ("t1", "A1", datetime(2024, 1, 12), -30, "gas", False), ("t2", "A1", datetime(2024, 2, 2), 5, "gas", False)
    )
    fact = facts.fact_transactions(staged, **star)
    balances = facts.fact_daily_balances(
        fact, star["accounts"], star["customers"], date(2024, 2, 3), start=date(2024, 2, 1)
    )
    a1 = star["accounts"].where("account_id = 'A1'").select("account_key")
    rows = balances.join(a1, "account_key").orderBy("date_key").collect()
    assert [(r.date_key, r.closing_balance, r.transaction_count) for r in rows] == [
        (20240201, D("70.00"), 0),
        (20240202, D("75.00"), 1),
        (20240203, D("75.00"), 0),
    ]


def test_daily_balances_period_by_period(spark, star):
    staged = transactions(
        spark,
        *[
            (f"t{n}", a, datetime(2024, 1, 5) + timedelta(days=3 * n), (-1) ** n * n, "gas", False)
            for n, a in enumerate(["A1", "A2", "A404", "A1"] * 6)
        ],
    )
    fact = facts.fact_transactions(staged, **star)
    parts = (star["accounts"], star["customers"])
    keep = ["date_key", "account_key", "customer_key", "closing_balance", "total_debits", "transaction_count"]
    january = facts.fact_daily_balances(fact, *parts, date(2024, 1, 31))
    later = facts.fact_daily_balances(
        fact,
        *parts,
        date(2024, 3, 20),
        start=date(2024, 2, 1),
        opening=january.where("date_key = 20240131"),
    )
    whole = facts.fact_daily_balances(fact, *parts, date(2024, 3, 20))
    assert sorted(january.unionByName(later).select(keep).collect()) == sorted(whole.select(keep).collect())


def test_loan_months_are_dense(spark, star):
    loans = spark.createDataFrame(
        [
            (i, c, kind, D(3600), D("0.05"), 36, date(2024, 1, 5), D(100), 700, D("0.2"), False)
            for i, c, kind in [("L1", "C1", "auto"), ("L2", "C404", "boat")]
        ],
        schemas.STAGING["loans"],
    )
    snapshot = spark.createDataFrame(
        [
            ("L1", date(2024, 1, 31), D(3600), 0, False, D(10)),
            ("L1", date(2024, 4, 30), D(3300), 95, True, D(100)),
            ("L2", date(2024, 2, 29), D(3000), 31, False, D(0)),
        ],
        "loan_id string, snapshot_date date, outstanding_balance decimal(16,2), days_past_due int, "
        "is_defaulted boolean, principal_paid decimal(16,2)",
    )
    fact = facts.fact_loan_monthly(snapshot, loans, star["customers"], dimensions.loan_product_seed(spark))
    assert quality.check_unique(fact, ["date_key", "loan_id"]).count() == 0
    rows = fact.join(star["customers"].select("customer_key", "segment"), "customer_key").orderBy("loan_id", "date_key")
    got = [
        (r.loan_id, r.date_key, r.outstanding_balance, r.principal_paid, r.delinquency_bucket, r.segment)
        for r in rows.collect()
    ]
    assert got == [
        ("L1", 20240131, D(3600), D(10), "current", "mass"),
        ("L1", 20240229, D(3600), D(0), "current", "affluent"),
        ("L1", 20240331, D(3600), D(0), "current", "affluent"),
        ("L1", 20240430, D(3300), D(100), "90+", "affluent"),
        ("L2", 20240229, D(3000), D(0), "30-59", None),
    ]
    assert fact.where("loan_product_key = -1").count() == 1


def test_a_load_in_parts_gives_the_same_rows(spark, monkeypatch):
    """Each id is whole in one part, also a missing one, and a star loaded part by part has the rows of one load."""
    ids = spark.range(300).selectExpr("if(id % 7 = 0, null, concat('T', id % 40)) AS transaction_id", "id AS n")
    star = sample.Star(spark, "/root/testdata/sf0.001", "lineitem")
    whole = star.load_fact(load_id=1).drop("created_at")
    monkeypatch.setattr(facts, "PART_BYTES", 1)
    monkeypatch.setattr(facts, "PARTS", 3)
    parts = [p.collect() for p in facts.parts_by_id(ids)]
    seen = [{r["transaction_id"] for r in p} for p in parts]
    assert len(parts) == 3 and sum(map(len, seen)) == len(set.union(*seen)) == 41
    assert sorted(r["n"] for p in parts for r in p) == list(range(300))
    got = star.fact
    assert len(star.store.loads("fact_transactions")) == 3
    got = got.select(whole.columns)
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
    assert star.fact.select("created_at").distinct().count() == 1
