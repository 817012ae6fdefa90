"""Shapes of the physical plans: what must hold when the tables no longer fit a broadcast."""

import re

import pytest

from starloom import session
from starloom.plans import analytics
from starloom.plans.queries import QUERIES
from starloom.sources import sample

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plan as if no table were small enough for the optimizer to broadcast."""
    for source in ("events", "lineitem"):
        star = sample.star(spark, SF_DIR, source)
        star.fact, star.loan_months  # noqa: B018 - load before the threshold changes
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_or_cartesian_join_in_any_query(spark, no_broadcast):
    offenders = {}
    for name, build in QUERIES.items():
        plan = plan_of(build(spark, SF_DIR))
        found = set(re.findall(r"BroadcastNestedLoopJoin|CartesianProduct|PythonUDF|ArrowEvalPython", plan))
        if found:
            offenders[name] = found
    assert offenders == {}


def test_unpartitioned_windows_only_where_rows_are_few(spark, no_broadcast):
    """A window without partition keys runs in one task; vintages have one row per quarter."""
    unpartitioned = r"windowspecdefinition\((\w+#\d+L? (ASC|DESC)|specifiedwindowframe)"
    found = [n for n, build in QUERIES.items() if re.search(unpartitioned, plan_of(build(spark, SF_DIR)))]
    assert found == ["vintage_analysis"]


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = plan_of(QUERIES["dedup_transactions"](spark, SF_DIR))
    before_shuffle = plan[plan.index("Exchange hashpartitioning(transaction_id") :]
    assert "WindowGroupLimit" in before_shuffle


def test_top_n_limits_rows_before_the_shuffle(spark):
    plan = plan_of(QUERIES["top_customers_per_segment"](spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "name, columns",
    [
        ("monthly_volume", {"date_key", "amount"}),
        ("fraud_rate_by_category", {"merchant_category_key", "amount", "is_fraud"}),
        ("activity_streaks", {"account_key", "date_key"}),
    ],
)
def test_scans_read_only_the_columns_used(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "load=" in line]
    read = {c.split(":")[0] for c in re.search(r"ReadSchema: struct<([^>]*)>", scans[0])[1].split(",") if ":" in c}
    assert len(scans) == 1 and read == columns


def test_measures_are_summed_before_the_customer_join(spark, no_broadcast):
    plan = plan_of(QUERIES["mv_monthly_transaction_summary"](spark, SF_DIR))
    fact_side = plan[: plan.index("load=")]
    assert "HashAggregate" in fact_side[fact_side.rindex("SortMergeJoin") :]


def test_summary_meets_by_customer_once(spark, no_broadcast):
    """Rows summed by customer version and category name are not shuffled by customer and name again."""
    plan = plan_of(QUERIES["mv_monthly_transaction_summary"](spark, SF_DIR))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert [line for line in exchanges if "merchant_category#" in line and "customer_key#" in line and "segment#" in line] == []


def test_point_in_time_join_is_an_equi_join_with_a_range_condition(spark, no_broadcast):
    plan = plan_of(QUERIES["point_in_time_join"](spark, SF_DIR))
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "LeftOuter" in join and "valid_from" not in join.split("LeftOuter")[0] and ">=" in join


@pytest.mark.parametrize("name, scans", [("running_balance", 2), ("window_tour", 3)])
def test_windows_of_hot_accounts_read_the_fact_few_times(spark, no_broadcast, tmp_path, name, scans):
    star = sample.star(spark, SF_DIR, "lineitem")
    analytics.fact_window_points(star.fact, hot_rows=20).write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    assert points.count() > 10
    plan = plan_of(getattr(analytics, name)(star.fact, star.accounts, points=points))
    assert sum("FileScan" in line and "load=" in line for line in plan.splitlines()) == scans


def test_tasks_are_bounded_and_smaller_settings_stay(spark):
    sizes = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k, None) for k in (*sizes, initial, "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set(sizes[0], "64MB")
        spark.conf.set(sizes[1], "1m")
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.unset(initial)
        QUERIES["dpd_bucket"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(sizes[0]) == f"{session.TASK_BYTES}b"
        assert spark.conf.get(sizes[1]) == "1m"
        assert spark.conf.get(initial) == str(session.SHUFFLE_PARTITIONS)
        spark.conf.set(initial, "7")
        session.bound_tasks(spark)
        assert spark.conf.get(initial) == "7"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(("size", "number"), [("64MB", 64 << 20), ("16m", 16 << 20), ("134217728b", 128 << 20), ("1024", 1024), ("2g", 2 << 30)])
def test_sizes_are_read_as_spark_writes_them(size, number):
    assert session._bytes(size) == number


def test_rows_of_cold_accounts_are_shuffled_once_for_all_windows(spark, no_broadcast, tmp_path):
    """Time and value windows and the join with accounts share one shuffle; before, each had its own."""
    star = sample.star(spark, SF_DIR, "lineitem")
    analytics.fact_window_points(star.fact, hot_rows=20).write.parquet(str(tmp_path / "points"))
    plan = plan_of(analytics.window_tour(star.fact, star.accounts, points=spark.read.parquet(str(tmp_path / "points"))))
    cold = plan[plan.index("LeftAnti") - 2000 : plan.index("LeftAnti")]
    above = plan[: plan.index("LeftAnti")]
    assert "Exchange hashpartitioning(account_key" in cold
    assert len(re.findall(r"Exchange hashpartitioning\(", above)) == 1 and above.count("Window [") == 3
