"""The batch load: staged Parquet to published star schema, and the summary refresh."""

from __future__ import annotations

from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import calendar
from starloom.functions.keys import hash_key
from starloom.operators import dimensions, facts, history, quality
from starloom.operators.dedup import first_per_key
from starloom.plans import analytics, views
from starloom.session import bound_tasks, use_utc
from starloom.sources import ids
from starloom.sources.staged import read_staged
from starloom.sources.store import Store


def load_warehouse(
    spark: SparkSession,
    store: Store,
    source_dir: str,
    effective_date: date,
    initial: bool = False,
    load_id: int | None = None,
    calendar_range: tuple[date, date] = (dimensions.CALENDAR_START, dimensions.CALENDAR_END),
) -> DataFrame:
    """Run one load and return its report (step, rows).

    Every dimension is written before the facts read it, so keys are settled. All tables become
    visible together at the end; a load that fails shows nothing, neither then nor later. A load can
    be repeated: merges of an unchanged batch change nothing and loaded transactions are skipped. What
    became of every staged transaction is published as ``load_accounting``, and the checks of the rows
    added as ``constraint_violations``. Days and hours are those of UTC whatever the session's zone.
    """
    use_utc(spark)
    bound_tasks(spark)
    report: list[tuple[str, int]] = []
    with store.load():
        _load(spark, store, source_dir, effective_date, initial, load_id, calendar_range, report)
    return spark.createDataFrame(report, "step string, rows bigint")


def _load(spark, store, source_dir, effective_date, initial, load_id, calendar_range, report) -> None:
    steps = Steps(store, report)
    steps.write("dim_date", dimensions.dim_date(spark, *calendar_range))
    steps.seed("dim_merchant_category", dimensions.merchant_category_seed(spark), "category_code")
    steps.seed("dim_loan_product", dimensions.loan_product_seed(spark), "loan_type")

    staged = {e: read_staged(spark, source_dir, e) for e in schemas.STAGING}
    steps.merge(
        "dim_branch", dimensions.unknown_branch(spark), staged["branches"], dimensions.merge_dim_branch
    )
    steps.merge_history(
        "dim_customer",
        dimensions.unknown_customer(spark),
        staged["customers"],
        lambda open_versions, batch: history.merge_dim_customer(open_versions, batch, effective_date, initial),
    )
    steps.merge(
        "dim_account",
        dimensions.unknown_account(spark),
        staged["accounts"],
        dimensions.merge_dim_account,
    )
    if staged["loans"] is not None:
        steps.write("stg_loans", staged["loans"])
    if staged["transactions"] is not None:
        inserted = write_transactions(store, staged["transactions"], load_id)
        report.append(("fact_transactions", inserted))
        if inserted:
            points = analytics.fact_window_points(store.read("fact_transactions"))
            store.write_snapshot("fact_window_points", points)


# Columns of a staged transaction that a load refuses to find empty; ids that look nothing up are no fault.
REQUIRED = ("transaction_id", "amount", "channel", "is_fraud")
FACT_KEYS = ("date_key", "account_key", "customer_key", "merchant_category_key")


class Watched:
    """Rows whose figures are taken on the way, by whatever job reads them."""

    def __init__(self, df: DataFrame, **figures: Column):
        self._rows, self._figures, self._seen = df, [c.alias(n) for n, c in figures.items()], Observation()
        self.rows = df.observe(self._seen, *self._figures)

    def figures(self) -> dict:
        """After the job. Where the optimizer has cut the rows off, as nothing came of them, they are counted by a job."""
        try:
            return self._seen.get
        except Py4JJavaError:
            return self._rows.agg(*self._figures).first().asDict()


def write_transactions(store: Store, batch: DataFrame, load_id: int | None = None) -> int:
    """Write the batch's new transactions, their ids, and the figures and checks of the load for the next commit.

    The batch goes through one plan: calendar, one row per id, ids of earlier loads taken out bucket by bucket, keys.
    What each step leaves is counted in that plan. Staged rows are the inserted, out-of-calendar, duplicate and
    loaded-before ones together. A NULL in a required column fails the load. Returns the rows inserted.
    """
    rows = F.count(F.lit(1))
    staged = Watched(batch, staged=rows, **{f"no_{c}": F.count_if(F.col(c).isNull()) for c in REQUIRED})
    inside = Watched(facts.in_calendar(staged.rows, store.read("dim_date")), rows=rows)
    span, moved, by_id = None, True, inside.rows
    if ids.id_folders(store, "fact_transactions"):
        first, last, named = batch.agg(*[f("transaction_id") for f in (F.min, F.max, F.count)]).first()
        span = (first, last) if named else None
        moved = ids.few_known(store, "fact_transactions", span, named)
        if not moved:
            by_id = ids.dealt(store, "fact_transactions", by_id, "transaction_id", span)
    single = Watched(first_per_key(by_id, ["transaction_id"], facts.TRANSACTION_ORDER), rows=rows)
    new = ids.without_known(store, "fact_transactions", single.rows, "transaction_id", span, moved)
    keyed = facts.keyed_transactions(
        new, store.read("dim_account"), store.read("dim_customer"), store.read("dim_merchant_category"), load_id
    )
    before = max((e["version"] for e in store.loads("fact_transactions")), default=0)
    inserted = store.write_load("fact_transactions", keyed, load_id, {"transaction_key": hash_key("transaction_id")})
    found = staged.figures()
    missing = {c: found[f"no_{c}"] for c in REQUIRED if found[f"no_{c}"]}
    if missing:
        raise ValueError(f"staged transactions without a value: {missing}")
    known, distinct = inside.figures()["rows"], single.figures()["rows"]
    outcomes = {
        "staged": found["staged"],
        "out_of_calendar": found["staged"] - known,
        "duplicate": known - distinct,
        "loaded_before": distinct - inserted,
        "inserted": inserted,
    }
    accounting = store.spark.createDataFrame(list(outcomes.items()), "outcome string, rows bigint")
    store.write_snapshot("load_accounting", accounting)
    store.write_rows("load_history", accounting.select(F.lit(load_id).cast("bigint").alias("load_id"), "outcome", "rows"), load_id)
    if inserted:
        added = store.read_loads("fact_transactions", before)
        grain = ids.write_ids(store, "fact_transactions", added.select("transaction_id"), inserted)
        ids.merge_folders(store, "fact_transactions")
        violations = fact_constraints(store, "fact_transactions", added, grain)
        store.write_rows("constraint_violations", violations.withColumn("load_id", F.lit(load_id).cast("bigint")), load_id)
    return inserted


def fact_constraints(store: Store, table: str, rows: DataFrame, grain: DataFrame | None = None) -> DataFrame:
    """Violations among rows of a published fact, of every constraint the fact is declared with; one scan.

    ``grain`` may hold the grain of the same rows, laid out by it.
    """
    held = {
        "date_key": ("dim_date", "date_key"),
        "account_key": ("dim_account", "account_key"),
        "customer_key": ("dim_customer", "customer_key"),
        "merchant_category_key": ("dim_merchant_category", "merchant_category_key"),
        "loan_product_key": ("dim_loan_product", "loan_product_key"),
    }
    rule = quality.FACT_RULES[table]
    references = {c: (store.read(held[c][0]), held[c][1]) for c in rule.foreign_keys}
    return quality.constraint_violations(rows, table, rule, references, grain)


def append_transactions(store: Store, batch: DataFrame, load_id: int | None = None) -> int:
    """Append the batch's new transactions to the published fact, with its accounting; returns how many."""
    use_utc(store.spark)
    bound_tasks(store.spark)
    with store.load():
        return write_transactions(store, batch, load_id)


# --- tables kept up from what loads added ---------------------------------------------------------------


def _added_since(store: Store, table: str) -> tuple[int, list[int]]:
    """The version of the fact, and the months that loads touched since a monthly table was computed."""
    loads = store.loads("fact_transactions", store.covered(table))
    months = {int(m) for e in loads for m in e["part"].split(",") if m}
    return max((e["version"] for e in loads), default=store.covered(table)), sorted(months)


def _refresh_months(store: Store, table: str, compute, month: Column) -> int:
    """Compute the touched months of a table anew, reading those months of the fact; returns its rows.

    Readers keep the months they have until the commit, and all other months for good.
    """
    version, months = _added_since(store, table)
    if months or not store.months(table):
        fact = store.read("fact_transactions")
        with store.load():
            store.write_months(table, compute(fact.where(F.col("month_key").isin(months))), month, version)
    return store.read(table).count()


def refresh_monthly_summary(store: Store) -> int:
    """Bring the monthly summary up to the published fact; returns its rows.

    Months are summed apart, so only those that loads have touched since are read and replaced. Versions of a customer
    keep their attributes, so months without new rows cannot change.
    """

    def compute(fact: DataFrame) -> DataFrame:
        return views.mv_monthly_transaction_summary(fact, store.read("dim_customer"), store.read("dim_merchant_category"))

    return _refresh_months(store, "mv_monthly_transaction_summary", compute, F.col("year").cast("int") * 100 + F.col("month"))


def refresh_fraud_days(store: Store) -> int:
    """Bring the day-level roll-up of fraudulent transactions up to the published fact; returns its rows."""
    return _refresh_months(store, "fact_fraud_daily", views.fraud_by_day, calendar.month_key(F.col("date_key")))


def publish_daily_balances(store: Store, end: date) -> int:
    """Bring the published daily balances up to ``end`` and to the fact; returns the rows written.

    The balances of the last published day are the state that is carried on: a new period reads the transactions from
    its first day only. Days are published by month. What arrived late (transactions on published days, accounts opened
    on them) reopens the months from the first such day, carried on from the day before. Customer versions that start on
    published days are taken up where these days are computed again.
    """
    table, accounts = "fact_daily_balances", store.read("dim_account")
    version, _ = _added_since(store, table)
    months = store.months(table)
    opening, start = None, None
    if months:
        latest = store.read_months(table, months[-1], months[-1])
        last_key = latest.agg(F.max("date_key")).first()[0]
        last = date(last_key // 10000, last_key // 100 % 100, last_key % 100)
        balances = latest.where(F.col("date_key") == last_key)
        days = [last + timedelta(days=1)]
        added = store.read_loads("fact_transactions", store.covered(table))
        if added is not None:
            days.append(added.agg(F.min(calendar.key_to_date("date_key"))).first()[0])
        unseen = accounts.join(balances.select("account_key"), "account_key", "left_anti")
        days.append(unseen.agg(F.min("open_date")).first()[0])
        start = min(d for d in days if d is not None).replace(day=1)
        before = start - timedelta(days=1)
        month_before = before.year * 100 + before.month
        if month_before >= months[0]:
            opening = store.read_months(table, month_before, month_before).where(F.col("date_key") == int(before.strftime("%Y%m%d")))
        else:
            start = None
    rows = facts.fact_daily_balances(
        store.read("fact_transactions"), accounts, store.read("dim_customer"), end, start, opening=opening
    )
    with store.load():
        return store.write_months(table, rows, calendar.month_key(F.col("date_key")), version)


def refresh_window_points(store: Store) -> int:
    """Find anew where the transactions of hot accounts are cut; needed only now and then, as older points stay right."""
    return store.publish("fact_window_points", analytics.fact_window_points(store.read("fact_transactions")))


class Steps:
    """Write tables in order and note their row counts."""

    def __init__(self, store: Store, report: list[tuple[str, int]]):
        self.store = store
        self.report = report

    def write(self, table: str, df: DataFrame) -> None:
        self.report.append((table, self.store.write_snapshot(table, df)))

    def seed(self, table: str, rows: DataFrame, code: str) -> None:
        known = self.store.read_if_exists(table)
        if known is not None:
            rows = dimensions.insert_if_absent(known, rows, code)
        self.write(table, rows)

    def merge(self, table: str, empty: DataFrame, batch: DataFrame | None, merge) -> None:
        """Merge a batch into the published dimension, which starts with its unknown member."""
        known = self.store.read_if_exists(table)
        if batch is None:
            if known is None:
                self.write(table, empty)
            return
        self.write(table, merge(empty if known is None else known, batch))
        self._refuse_shared_keys(table)

    def merge_history(self, table: str, empty: DataFrame, batch: DataFrame | None, merge) -> None:
        """Merge a batch into a published history: its open versions are read and written, closed ones stay where they are."""
        known = self.store.read_open(table)
        if batch is None and known is not None:
            return
        now = empty if known is None else known
        self.store.write_history(table, now if batch is None else merge(now, batch))
        self.report.append((table, self.store.rows(table)))
        self._refuse_shared_keys(table)

    def _refuse_shared_keys(self, table: str) -> None:
        """Current members against each other, and against closed versions by the keys of those alone."""
        key = f"{table.removeprefix('dim_')}_key"
        now = self.store.read_open(table)
        clash = quality.check_unique(now, [key]).limit(1).collect()
        closed = self.store.read_closed(table)
        if not clash and closed is not None:
            clash = closed.select(key).join(now.select(key), key, "left_semi").limit(1).collect()
        if clash:
            raise ValueError(f"two members of {table} share the key {clash[0][key]}")


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """step, rows of the given tables, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("step"), "rows")
        for name, df in tables.items()
    ]
    report = counts[0]
    for part in counts[1:]:
        report = report.unionByName(part)
    return report
