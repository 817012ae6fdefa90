"""The load from staged Parquet, its repetition, the summary refresh and the stream."""

import re
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.keys import hash_key
from starloom.operators import dimensions, facts, history, quality
from starloom.plans import load, views
from starloom.sources import ids
from starloom.sources.staged import read_staged
from starloom.sources.store import Store
from starloom.streaming.incremental import load_arriving_transactions

D = Decimal
ROWS = {
    "branches": [("B1", "Main", "Reno", "NV", date(2000, 1, 1))],
    "customers": [
        (f"C{n}", "F", "L", 30, D(1000), 700, D("0.1"), "mass", date(2023, 1, 1), "B1") for n in (1, 2)
    ],
    "accounts": [
        (f"A{n}", f"C{n}", "checking", D("0.01"), date(2023, 1, 1), "active", D(10)) for n in (1, 2)
    ],
    "transactions": [
        (f"t{n}", f"A{n % 3 + 1}", datetime(2024, 1 + n % 3, 5, n), D(n), "gas", "online", n == 4)
        for n in range(9)
    ],
    "loans": [
        ("L1", "C1", "auto", D(100), D("0.01"), 36, date(2024, 1, 1), D(3), 700, D("0.1"), False)
    ],
}


def stage(spark, folder, entity, rows=None, name="part"):
    df = spark.createDataFrame(ROWS[entity] if rows is None else rows, schemas.STAGING[entity])
    df.write.mode("append").parquet(f"{folder}/{entity}/{name}")


@pytest.fixture
def staged(spark, tmp_path):
    folder = str(tmp_path / "staged")
    for entity in ROWS:
        stage(spark, folder, entity)
    return folder


def report_of(df):
    return {r.step: r.rows for r in df.collect()}


def test_load_and_repeat(spark, store, staged):
    report = report_of(load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True, load_id=1))
    assert report == {
        "dim_date": 4018,
        "dim_merchant_category": 11,
        "dim_loan_product": 5,
        "dim_branch": 2,
        "dim_customer": 3,
        "dim_account": 3,
        "stg_loans": 1,
        "fact_transactions": 9,
    }
    fact = store.read("fact_transactions")
    assert fact.where("account_key = -1").count() == 3
    assert fact.where("account_key <> -1 AND customer_key = -1").count() == 0

    again = report_of(load.load_warehouse(spark, store, staged, date(2024, 2, 1), load_id=2))
    assert again["fact_transactions"] == 0 and again["dim_customer"] == 3
    assert store.read("fact_transactions").count() == 9

    stage(spark, staged, "transactions", [("t100", "A1", datetime(2024, 2, 9), D(5), "gas", "online", False)], "more")
    changed = [("C1", "F", "L", 30, D(1000), 760, D("0.1"), "affluent", date(2023, 1, 1), "B1")]
    more = Store(spark, store.root)
    (spark.createDataFrame(changed, schemas.STAGING["customers"])
     .write.parquet(f"{staged}/../changed/customers"))
    third = report_of(load.load_warehouse(spark, more, f"{staged}/../changed", date(2024, 3, 1)))
    assert third["dim_customer"] == 4 and "fact_transactions" not in third and "dim_account" not in third
    fourth = report_of(load.load_warehouse(spark, more, staged, date(2024, 4, 1), load_id=3))
    assert fourth["fact_transactions"] == 1 and fourth["dim_customer"] == 5
    assert sorted(r.load_id for r in more.read("fact_transactions").select("load_id").distinct().collect()) == [1, 3]


def test_refresh_leaves_readers_alone(spark, store, staged):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    rows = load.refresh_monthly_summary(store)
    before = store.read("mv_monthly_transaction_summary")
    expected = views.mv_monthly_transaction_summary(
        store.read("fact_transactions"), store.read("dim_customer"), store.read("dim_merchant_category")
    )
    assert before.count() == rows and sorted(before.collect(), key=str) == sorted(expected.collect(), key=str)
    stage(spark, staged, "transactions", [("t9", "A1", datetime(2024, 5, 9), D(5), "gas", "online", False)], "more")
    load.load_warehouse(spark, store, staged, date(2024, 2, 1))
    assert load.refresh_monthly_summary(store) == rows + 1
    assert before.count() == rows
    assert store.read("mv_monthly_transaction_summary").count() == rows + 1


def test_read_staged_takes_all_files_and_columns(spark, staged):
    stage(spark, staged, "branches", [("B2", "Side", "Reno", "NV", date(2001, 1, 1))], "deeper/part")
    wide = spark.createDataFrame([("B3", 1)], "branch_id string, extra int").selectExpr(
        "extra", "'NV' AS state", "branch_id", "'n' AS branch_name", "'c' AS city", "DATE'2000-01-01' AS opened_date"
    )
    wide.write.parquet(f"{staged}/branches/wide")
    df = read_staged(spark, staged, "branches")
    assert df.columns == schemas.STAGING["branches"].fieldNames()
    assert {r.branch_id for r in df.collect()} == {"B1", "B2", "B3"}
    assert read_staged(spark, f"{staged}/nowhere", "branches") is None


def test_sql_over_published_tables(spark, store, staged):
    from starloom.plans.catalog import register_views

    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    names = register_views(store)
    assert {"fact_transactions", "dim_branch", "v_current_customers", "v_transaction_enriched"} <= set(names)
    rows = spark.sql(
        "SELECT segment_at_txn_time AS segment, count(*) AS n, sum(amount) AS total "
        "FROM v_transaction_enriched GROUP BY 1"
    ).collect()
    assert {(r.segment, r.n, r.total) for r in rows} == {("mass", 6, D(21)), (None, 3, D(15))}
    one = spark.sql(
        "SELECT segment FROM dim_customer WHERE customer_id = :id AND :day >= valid_from AND :day < valid_to",
        args={"id": "C1", "day": date(2024, 6, 1)},
    ).collect()
    assert [r.segment for r in one] == ["mass"]


def test_ids_loaded_before_are_skipped(spark, store, staged):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    again = spark.createDataFrame(
        [*ROWS["transactions"][:3], ("new", "A1", datetime(2024, 2, 7), D(1), "gas", "online", False)],
        schemas.STAGING["transactions"],
    )
    assert load.append_transactions(store, again, 2) == 1
    # The same id in another month is known as well.
    moved = again.withColumn("timestamp", F.lit(datetime(2025, 5, 5)))
    assert load.append_transactions(store, moved, 3) == 0
    assert store.read("fact_transactions").count() == 10
    history = store.read("load_history").where("load_id IN (2, 3)").collect()
    assert {(r.load_id, r.outcome): r.rows for r in history if r.rows} == {
        (2, "staged"): 4, (2, "loaded_before"): 3, (2, "inserted"): 1, (3, "staged"): 4, (3, "loaded_before"): 4,
    }


def transactions(spark, names, day=datetime(2024, 2, 9)):
    return spark.createDataFrame([(n, "A1", day, D(5), "gas", "online", False) for n in names], schemas.STAGING["transactions"])


def test_old_ids_are_not_shuffled(spark, store, staged, monkeypatch):
    """A batch is dealt into the buckets of the ids, is kept from folders out of its range, and folders are merged."""
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    load.append_transactions(store, transactions(spark, [f"u{n}" for n in range(50)]), 2)
    load.append_transactions(store, transactions(spark, [f"v{n}" for n in range(50)]), 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = transactions(spark, [f"u{n}" for n in range(40, 60)])
        new = ids.without_known(store, "fact_transactions", batch, "transaction_id", ("t8", "u59"))
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r.transaction_id for r in new.collect()) == [f"u{n}" for n in range(50, 60)]
    # Ids t0 to t8 and u0 to u9 are opened, v0 to v9 are not; one exchange, that of the batch.
    assert plan.count("Bucketed: true") == 2 and plan.count("LeftAnti") == 2 and plan.count("Exchange") == 1
    monkeypatch.setattr(ids, "MERGE_AFTER", 4)
    assert len(ids.id_folders(store, "fact_transactions")) == 3
    load.append_transactions(store, transactions(spark, ["w1"]), 4)
    assert [f["rows"] for f in ids.id_folders(store, "fact_transactions")] == [110]
    assert load.append_transactions(store, transactions(spark, ["w1", "t3", "u7", "v9", "x"]), 5) == 1
    fresh = Store(spark, store.root)
    assert load.append_transactions(fresh, transactions(spark, ["x", "y"]), 6) == 1


def files_of(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_merges_leave_closed_versions_alone(spark, store):
    """Each merge reads and writes open versions; folders of closed ones stay, and the history equals one merge chain."""
    whole = dimensions.unknown_customer(spark)
    table, closed = "dim_customer", {}
    for n in range(4):
        rows = [(f"C{k}", "F", "L", 30, D(1000), 600 + 10 * n * (k <= n), D("0.1"), "mass", date(2023, 1, 1), "B1") for k in range(5)]
        batch = spark.createDataFrame(rows, schemas.STAGING["customers"])
        day = date(2024, 1 + n, 1)
        now = store.read_open(table) if n else dimensions.unknown_customer(spark)
        merged = history.merge_dim_customer(now, batch, day, initial=n == 0)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "closed=1" not in plan
        with store.load():
            store.write_history(table, merged)
        folders = [e["folder"] for e in store.entries(table) if e["kind"] == "closed"]
        for folder, files in closed.items():
            assert folder in folders and files_of(f"{store.root}/{folder}") == files
        closed = {f: files_of(f"{store.root}/{f}") for f in folders}
        whole = history.merge_dim_customer(whole, batch, day, initial=n == 0)
    keep = [c for c in schemas.DIM_CUSTOMER.fieldNames() if c not in ("created_at", "updated_at")]
    assert sorted(map(str, store.read(table).select(keep).collect())) == sorted(map(str, whole.select(keep).collect()))
    assert store.read(table).count() == store.rows(table) == 15 and len(closed) == 3


def test_a_refresh_reads_and_replaces_touched_months_only(spark, store, staged):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    name = "mv_monthly_transaction_summary"
    load.refresh_monthly_summary(store)
    load.refresh_fraud_days(store)
    before = {m: store.read_months(name, m, m).inputFiles() for m in store.months(name)}
    assert sorted(before) == [202401, 202402, 202403]
    load.append_transactions(store, transactions(spark, ["late"]), 2)
    for _ in range(2):
        load.refresh_monthly_summary(store)
        load.refresh_fraud_days(store)
    after = {m: store.read_months(name, m, m).inputFiles() for m in store.months(name)}
    assert [m for m in after if after[m] != before[m]] == [202402]
    whole = views.mv_monthly_transaction_summary(
        store.read("fact_transactions"), store.read("dim_customer"), store.read("dim_merchant_category")
    )
    assert sorted(store.read(name).collect(), key=str) == sorted(whole.collect(), key=str)
    assert store.read("fact_fraud_daily").count() == 1


def test_balances_published_in_steps_equal_balances_at_once(spark, store, staged):
    """Months carried on from the day before, late rows, a late account, and a period without any transaction."""
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)

    def publish(end):
        load.publish_daily_balances(store, end)
        keep = [c for c in schemas.FACT_DAILY_BALANCES.fieldNames() if c not in ("created_at", "load_id")]
        whole = facts.fact_daily_balances(store.read("fact_transactions"), store.read("dim_account"), store.read("dim_customer"), end)
        got = store.read("fact_daily_balances").select(keep)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(keep).collect()))
        return {m: store.read_months("fact_daily_balances", m, m).inputFiles() for m in store.months("fact_daily_balances")}

    first = publish(date(2024, 1, 20))
    second = publish(date(2024, 3, 10))
    assert second[202312] == first[202312] and second[202401] != first[202401]
    third = publish(date(2024, 4, 5))
    assert [m for m in third if third[m] != second.get(m)] == [202403, 202404]
    load.append_transactions(store, transactions(spark, ["late"], datetime(2024, 2, 3)), 2)
    fourth = publish(date(2024, 4, 5))
    assert [m for m in fourth if fourth[m] != third.get(m)] == [202402, 202403, 202404]
    rows = [("A9", "C1", "checking", D("0.01"), date(2024, 3, 15), "active", D(70))]
    account = spark.createDataFrame(rows, schemas.STAGING["accounts"])
    store.publish("dim_account", dimensions.merge_dim_account(store.read("dim_account"), account))
    fifth = publish(date(2024, 4, 7))
    assert [m for m in fifth if fifth[m] != fourth.get(m)] == [202403, 202404]


def test_figures_where_nothing_is_left(spark, store, staged):
    """Steps that come out empty are cut off by the optimizer; their figures are counted all the same."""
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    for n, batch in enumerate([transactions(spark, []), transactions(spark, ["a", "b", "b"], datetime(1950, 1, 1)), transactions(spark, ["t1", "t1"])], start=2):
        assert load.append_transactions(store, batch, n) == 0
    found = {(r.load_id, r.outcome): r.rows for r in store.read("load_history").where("load_id > 1").collect() if r.rows}
    assert found == {(3, "staged"): 3, (3, "out_of_calendar"): 3, (4, "staged"): 2, (4, "duplicate"): 1, (4, "loaded_before"): 1}


def test_a_load_checks_what_it_adds(spark, store, staged):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    assert store.read("constraint_violations").count() == 0
    broken = store.read("fact_transactions").withColumn("account_key", F.when(F.col("transaction_id") != "t3", F.lit(5)))
    found = load.fact_constraints(store, "fact_transactions", broken.union(broken)).collect()
    assert {(r.constraint_name, r.columns, r["keys"], r.rows) for r in found} == {
        ("unique", "transaction_id", 9, 18), ("foreign key", "account_key", 1, 16), ("not null", "account_key", 1, 2),
    }
    with pytest.raises(ValueError, match="channel"):
        load.append_transactions(store, transactions(spark, ["q"]).withColumn("channel", F.lit(None).cast("string")), 2)
    assert store.read("fact_transactions").count() == 9


def test_constraints_count_typed_values_in_one_scan(spark):
    """Two values of a grain that read alike are not one; a key that is the whole grain breaks both constraints."""
    rows = [("x|y", "z", 1), ("x", "y|z", 1), ("p", "q", 7), ("p", "q", 7), (None, "q", None), (None, None, None)]
    fact = spark.createDataFrame(rows, "a string, b string, k long")
    known = {"k": (spark.createDataFrame([(1,)], "k long"), "k")}

    def broken(grain):
        found = quality.constraint_violations(fact, "f", quality.FactRule(("a", "b", "k"), grain, ("k",)), known)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Expand") == 1 and "Generate" not in plan[plan.index("Expand") :]
        return {(r.constraint_name, r.columns, r["keys"], r.rows) for r in found.collect()}

    rest = {("foreign key", "k", 1, 2), ("not null", "a", 1, 2), ("not null", "b", 1, 1), ("not null", "k", 1, 2)}
    assert broken(("a", "b")) == {("unique", "a,b", 1, 2), *rest}
    assert broken(("k",)) == {("unique", "k", 2, 4), *rest}


def test_keys_are_counted_beside_each_other(spark):
    """A row is counted once with its keys of large dimensions and once with those of small ones; keys stay distinct."""
    rows = [("a", 1, 7, 1, 5), ("b", 1, 7, 2, 5), ("c", 2, 7, 2, 6), ("d", 2, 8, None, 6), (None, None, 1, 1, None)]
    fact = spark.createDataFrame(
        rows, "transaction_id string, date_key int, account_key long, customer_key long, merchant_category_key long"
    )
    names = quality.FACT_RULES["fact_transactions"].foreign_keys
    rule = quality.FactRule(tuple(fact.columns), ("transaction_id",), names)
    known = {c: (spark.createDataFrame([(1,)], f"{c} long"), c) for c in names}
    found = quality.constraint_violations(fact, "f", rule, known, fact.select("transaction_id"))
    expand = re.search(r"Expand \[(\[.*?\])\]", found._jdf.queryExecution().executedPlan().toString()).group(1)
    assert expand.count("[") == 2
    assert {tuple(r)[1:] for r in found.collect()} == {
        ("foreign key", "date_key", 1, 2), ("foreign key", "account_key", 2, 4), ("foreign key", "customer_key", 1, 2),
        ("foreign key", "merchant_category_key", 2, 4), ("not null", "transaction_id", 1, 1),
        ("not null", "date_key", 1, 1), ("not null", "customer_key", 1, 1), ("not null", "merchant_category_key", 1, 1),
    }


def test_loads_do_not_nest(spark, store):
    with pytest.raises(RuntimeError, match="already running"), store.load():
        store.write_snapshot("a", spark.range(3))
        store.publish("b", spark.range(2))
    assert store.tables() == []


def test_uncommitted_writings_are_seen_by_nobody_else(spark, store):
    store.publish("t", spark.range(3))
    store.write_snapshot("t", spark.range(9))
    assert store.read("t").count() == 9
    assert Store(spark, store.root).read("t").count() == 3
    store.commit()
    assert Store(spark, store.root).read("t").count() == 9


def test_unlisted_folder_is_ignored(spark, store):
    store.publish("t", spark.range(3))
    spark.range(50).write.parquet(f"{store.root}/t/v000002-dead")
    assert store.read("t").count() == 3
    assert store.publish("t", spark.range(5)) == 5
    assert store.read("t").count() == 5
    with pytest.raises(LookupError):
        store.read("missing")


def test_fact_range_prunes_month_folders(spark, store, staged):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    from starloom.plans.analytics import fraud_lookup

    answer = fraud_lookup(store.read("fact_transactions"), 20240201, 20240229)
    plan = answer._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(month_key" in scan and "PushedFilters: [" in scan
    assert answer.first()["count"] == 1


def test_stream_loads_arriving_files_once(spark, store, staged, tmp_path):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    checkpoint = str(tmp_path / "progress")
    stage(spark, staged, "transactions", [("t50", "A1", datetime(2024, 2, 9), D(5), "gas", "online", False)], "late")
    for expected in (10, 10):
        load_arriving_transactions(spark, store, staged, checkpoint).awaitTermination()
        assert store.read("fact_transactions").count() == expected
    stage(spark, staged, "transactions", [("t51", "A1", datetime(2024, 2, 9), D(5), "gas", "online", False)], "later")
    load_arriving_transactions(spark, store, staged, checkpoint).awaitTermination()
    assert store.read("fact_transactions").count() == 11
    assert store.read("fact_transactions").where(F.col("account_key") == -1).count() == 3


def test_a_failed_load_is_never_published(spark, store, staged, tmp_path):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    before = {t: store.read(t).count() for t in store.tables()}
    entries = store.log().count()
    for broken in ("twice", "no amount"):
        bad = str(tmp_path / broken.replace(" ", "-"))
        for entity in ("branches", "customers", "accounts", "transactions", "loans"):
            batch = read_staged(spark, staged, entity)
            if batch is None:
                continue
            if broken == "twice" and entity == "accounts":
                batch = batch.union(batch)
            if broken == "no amount" and entity == "transactions":
                batch = batch.withColumn("amount", F.lit(None).cast(batch.schema["amount"].dataType))
            batch.write.parquet(f"{bad}/{entity}")
        with pytest.raises(Exception):
            load.load_warehouse(spark, store, bad, date(2024, 6, 1)).collect()
        assert store.log().count() == entries
    load.refresh_monthly_summary(store)
    fresh = Store(spark, store.root)
    assert {t: fresh.read(t).count() for t in before} == before
    assert fresh.log().count() == entries + 1


def test_a_commit_is_refused_when_the_log_has_moved(spark, store):
    other = Store(spark, store.root)
    other.publish("t", spark.range(2))
    with pytest.raises(RuntimeError, match="another writer"):
        store.publish("t", spark.range(3))
    store.refresh()
    assert store.publish("t", spark.range(3)) == 3 and store.read("t").count() == 3


def test_days_do_not_depend_on_the_session_zone(spark, staged, tmp_path):
    facts = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        store = Store(spark, str(tmp_path / zone.replace("/", "-")))
        load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        facts.append(sorted(map(str, store.read("fact_transactions").select("transaction_id", "date_key", "hour_of_day", "customer_key").collect())))
    assert facts[0] == facts[1] and facts[0]


def test_every_staged_transaction_is_accounted_for(spark, store, staged, tmp_path):
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    more = str(tmp_path / "more")
    for entity in ROWS:
        batch = read_staged(spark, staged, entity)
        if entity == "transactions":
            late = batch.limit(1).withColumns({"transaction_id": F.lit("late"), "timestamp": F.lit(datetime(1950, 1, 1))})
            new = batch.limit(1).withColumn("transaction_id", F.lit("new"))
            batch = batch.union(new).union(new).union(late)
        batch.write.parquet(f"{more}/{entity}")
    load.load_warehouse(spark, store, more, date(2024, 1, 1))
    found = dict(store.read("load_accounting").collect())
    assert found == {"staged": 12, "out_of_calendar": 1, "duplicate": 1, "loaded_before": 9, "inserted": 1}
    total = store.read("fact_transactions").count()
    assert total == 10


def test_a_load_moves_few_ids_to_the_batch_and_each_row_once_by_id(spark, store, staged, monkeypatch):
    """Ids known before are few beside the batch: they are shuffled, the batch is not dealt a second time; else it is dealt once."""
    load.load_warehouse(spark, store, staged, date(2024, 1, 1), initial=True)
    plans, write = [], Store.write_load

    def watched(self, table, df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, table, df, *more)

    monkeypatch.setattr(Store, "write_load", watched)
    names = [*[f"u{n}" for n in range(40)], "u3", "t1"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert load.append_transactions(store, transactions(spark, names), 2) == 40
        monkeypatch.setattr(ids, "MOVED_IDS", 0)
        assert load.append_transactions(store, transactions(spark, [*names, "v1", "v1"]), 3) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_id = [re.findall(r"Exchange hashpartitioning\((transaction_id|_known)#\d+, (\d+)\)", p) for p in plans]
    assert [sorted(c for c, _ in found) for found in by_id] == [["_known", "transaction_id"], ["transaction_id"]]
    assert by_id[1][0][1] == str(ids.LEAST_BUCKETS) and plans[1].count("Bucketed: true") == 2
    found = {(r.load_id, r.outcome): r.rows for r in store.read("load_history").where("load_id > 1").collect() if r.rows}
    assert found == {
        (2, "staged"): 42, (2, "duplicate"): 1, (2, "loaded_before"): 1, (2, "inserted"): 40,
        (3, "staged"): 44, (3, "duplicate"): 2, (3, "loaded_before"): 41, (3, "inserted"): 1,
    }


def test_the_grain_of_a_load_is_counted_where_its_ids_lie(spark, store):
    ids_of = spark.createDataFrame([("a",), ("b",), ("a",), ("c",), ("a",)], "transaction_id string")
    rows = ids_of.select("transaction_id", F.lit(1).cast("bigint").alias("account_key"))
    rule = quality.FactRule(("transaction_id",), ("transaction_id",), ("account_key",))
    accounts = {"account_key": (spark.range(2).toDF("account_key"), "account_key")}
    with store.load():
        grain = ids.write_ids(store, "f", ids_of, 5)
    counted = grain.groupBy("transaction_id").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    found = [sorted(quality.constraint_violations(rows, "f", rule, accounts, g).collect()) for g in (None, grain)]
    assert found[0] == found[1] and [tuple(r) for r in found[1]] == [("f", "unique", "transaction_id", 1, 3)]


def test_keys_made_from_others_are_not_shuffled(spark, store):
    """A load's late columns come after the rows lie by month, with the same names and values."""
    rows = spark.createDataFrame([(f"t{n}", 20240101 + n) for n in range(5)], "transaction_id string, date_key int")
    rows = rows.select(hash_key("transaction_id").alias("transaction_key"), "*")
    store.append("f", rows)
    with store.load():
        store.write_load("g", rows, None, {"transaction_key": hash_key("transaction_id")})
    assert store.read("g").columns == store.read("f").columns
    assert sorted(store.read("g").collect()) == sorted(store.read("f").collect())


def test_a_customer_batch_is_shuffled_once_by_its_key(spark):
    rows = [(f"C{k}", "F", "L", 30, D(1000), 600, D("0.1"), "mass", date(2023, 1, 1), "B1") for k in range(5)]
    batch = spark.createDataFrame(rows, schemas.STAGING["customers"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = history.merge_dim_customer(dimensions.unknown_customer(spark), batch, date(2024, 1, 1))
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(") == 2 and merged.count() == 6
