"""The sample tables (customer, orders, lineitem, events, ...) mapped to the staging schemas.

Every row of a table is used. A few customers and accounts are staged under a renamed id, so that the
facts referring to them meet the unknown member, as with a dimension that arrives late. Two sets of
transactions exist: ``events`` (one busy month) and ``lineitem`` joined to its orders (several years,
with repeated transaction ids).
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import calendar
from starloom.functions.keys import hash_key
from starloom.operators import dimensions, facts, history
from starloom.plans import analytics, views
from starloom.session import shared_dir
from starloom.sources.store import Store

# State of each nation number.
NATION_STATES = [
    "CA", "WA", "OR", "AZ", "NV", "CO", "TX", "GA", "FL", "NC", "TN", "NY", "NJ",
    "PA", "MA", "IL", "MN", "OH", "MI", "HI", None, "CA", "TX", "NY", "IL",
]

# Category of each event type and loan type of each order priority.
EVENT_CATEGORIES = {
    "view": "grocery",
    "click": "online",
    "signup": "travel",
    "purchase": "retail",
    "error": "nope",
}
PRIORITY_LOAN_TYPES = {
    "1-URGENT": "auto",
    "2-HIGH": "mortgage",
    "3-MEDIUM": "personal",
    "4-NOT SPECIFIED": "student",
    "5-LOW": "boat",
}

# Effective dates of the three customer batches, by set of transactions.
EFFECTIVE_DATES = {
    "events": [date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21)],
    "lineitem": [date(1995, 1, 1), date(1997, 6, 1), date(1999, 6, 1)],
}
CALENDARS = {
    "events": (dimensions.CALENDAR_START, dimensions.CALENDAR_END),
    "lineitem": (date(1995, 1, 1), dimensions.CALENDAR_END),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: str, values: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {column} {cases} END"


def _staged(df: DataFrame, entity: str, columns: dict[str, str]) -> DataFrame:
    """Project SQL expressions and conform to the entity's schema."""
    fields = schemas.STAGING[entity].fields
    return df.selectExpr(*[schemas.typed(columns[f.name], f) for f in fields])


CUSTOMER_ID = "concat('CUST_', c_custkey, if(c_custkey % 50 = 49, '_NEW', ''))"
ACCOUNT_ID = "concat('ACC_', c_custkey, if(c_custkey % 40 = 39, '_NEW', ''))"


def customers(spark: SparkSession, sf_dir: str, batch: int, first_orders: bool = False) -> DataFrame:
    """Customer batch 1, 2 or 3: segments change from batch to batch.

    With ``first_orders`` a customer joined in the month of the first order.
    """
    rows = table(spark, sf_dir, "customer")
    join_date = "date_add(DATE'2023-07-01', cast(c_custkey % 200 as int))"
    if first_orders:
        firsts = (
            table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").alias("first_order"))
        )
        rows = rows.join(firsts, "c_custkey", "left")
        join_date = "coalesce(trunc(cast(first_order as date), 'month'), DATE'1995-01-01')"
    affluent = f"c_custkey % 7 = 0 AND {batch} >= 2"
    private = f"c_custkey % 11 = 0 AND {batch} >= 3"
    return _staged(
        rows,
        "customers",
        {
            "customer_id": CUSTOMER_ID,
            "first_name": "'C'",
            "last_name": "c_name",
            "age": "18 + c_custkey % 60",
            "annual_income": "20000 + (c_custkey * 97) % 180000",
            "credit_score": "if(c_custkey % 97 = 0, NULL, 500 + (c_custkey * 37) % 350)",
            "dti": "cast(c_custkey % 60 as decimal(6,3)) / 100",
            "segment": f"CASE WHEN {affluent} THEN 'affluent' WHEN {private} THEN 'private' ELSE 'mass' END",
            "join_date": join_date,
            "home_branch_id": "concat('BR_', c_nationkey)",
        },
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(
        table(spark, sf_dir, "customer"),
        "accounts",
        {
            "account_id": ACCOUNT_ID,
            "customer_id": "concat('CUST_', c_custkey)",
            "product_type": "element_at(array('checking', 'savings', 'credit_card'), cast(c_custkey % 3 + 1 as int))",
            "apr": "cast(c_custkey % 30 as decimal(6,4)) / 100",
            "open_date": "DATE'2024-01-01'",
            "status": "'active'",
            "initial_balance": "c_acctbal",
        },
    )


def accounts_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second account batch: ids move on by ten, so it updates most accounts and adds ten."""
    return _staged(
        table(spark, sf_dir, "customer"),
        "accounts",
        {
            "account_id": "concat('ACC_', c_custkey + 10)",
            "customer_id": "'CUST_OTHER'",
            "product_type": "element_at(array('credit_card', 'savings', 'checking'), cast(c_custkey % 3 + 1 as int))",
            "apr": "cast(c_custkey % 20 as decimal(6,4)) / 100",
            "open_date": "DATE'2025-06-30'",
            "status": "if(c_custkey % 5 = 0, 'closed', NULL)",
            "initial_balance": "c_acctbal",
        },
    )


def branches(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """Suppliers as branches; ``shift`` moves ids on and so renames branches and adds ``shift`` new."""
    states = ", ".join(map(schemas.sql_literal, NATION_STATES))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return _staged(
        rows,
        "branches",
        {
            "branch_id": f"concat('BR_', s_suppkey + {shift})",
            "branch_name": "s_name",
            "city": "n_name",
            "state": f"get(array({states}), s_nationkey)",
            "opened_date": "date_add(DATE'2000-01-01', cast(s_suppkey % 9000 as int))",
        },
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(
        table(spark, sf_dir, "events"),
        "transactions",
        {
            "transaction_id": "concat('E', event_id)",
            "account_id": "concat('ACC_', user_id)",
            "timestamp": "ts",
            "amount": "value",
            "merchant_category": _choose("event_type", EVENT_CATEGORIES),
            "channel": "if(event_id % 2 = 0, 'online', 'in_person')",
            "is_fraud": "event_id % 37 = 0",
        },
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = [code for code, *_ in dimensions.MERCHANT_CATEGORIES[:10]] + ["nope"]
    categories = ", ".join(map(schemas.sql_literal, codes))
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    return _staged(
        rows,
        "transactions",
        {
            "transaction_id": "concat('L', l_orderkey, '-', l_linenumber)",
            "account_id": "concat('ACC_', o_custkey)",
            "timestamp": "l_shipdate",
            "amount": "l_extendedprice",
            "merchant_category": f"get(array({categories}), cast(l_partkey % 11 as int))",
            "channel": "if(l_linestatus = 'O', 'online', 'in_person')",
            "is_fraud": "(l_orderkey * 7 + l_linenumber) % 667 = 0",
        },
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn(
        "principal", F.col("o_totalprice").cast("decimal(16,2)")
    )
    return _staged(
        rows,
        "loans",
        {
            "loan_id": "concat('LN_', o_orderkey)",
            "customer_id": "concat('CUST_', o_custkey)",
            "loan_type": _choose("o_orderpriority", PRIORITY_LOAN_TYPES),
            "principal": "principal",
            "apr": "0.03 + cast(o_orderkey % 15 as decimal(6,4)) / 100",
            "term_months": "36",
            "origination_date": "cast(o_orderdate as date)",
            "monthly_payment": "cast(cast(principal * 100 as bigint) div 36 as decimal(16,2)) / 100",
            "credit_score_at_origination": "500 + (o_orderkey * 13) % 350",
            "dti_at_origination": "cast(o_orderkey % 60 as decimal(6,3)) / 100",
            "defaulted": "o_orderstatus = 'F' AND o_orderkey % 5 = 0",
        },
    )


def loan_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six month ends of servicing data for each loan, from its origination month on."""
    rows = table(spark, sf_dir, "orders").withColumn(
        "m", F.explode(F.sequence(F.lit(0), F.lit(5)))
    )
    cents = "cast(cast(o_totalprice as decimal(16,2)) * 100 as bigint)"
    return rows.select(
        F.expr("concat('LN_', o_orderkey)").alias("loan_id"),
        F.expr("last_day(add_months(cast(o_orderdate as date), m))").alias("snapshot_date"),
        F.expr(f"cast(cast({cents} * (36 - m) div 36 as decimal(16,2)) / 100 as decimal(16,2))").alias(
            "outstanding_balance"
        ),
        F.expr("cast(greatest((o_orderkey * 31 + m * 17) % 240 - 120, 0) as int)").alias("days_past_due"),
    ).withColumn("is_defaulted", F.col("days_past_due") >= 90)


# --- stars --------------------------------------------------------------------------------------


def write_customers(store: Store, sf_dir: str, source: str, batches: int = 3) -> None:
    """The customer history after the first ``batches`` merges, each written as a load would."""
    spark, table = store.spark, "dim_customer"
    for n, effective in enumerate(EFFECTIVE_DATES[source][:batches], start=1):
        now = store.read_open(table) if n > 1 else dimensions.unknown_customer(spark)
        batch = customers(spark, sf_dir, n, first_orders=source == "lineitem")
        store.write_history(table, history.merge_dim_customer(now, batch, effective, initial=n == 1))


def new_store(spark: SparkSession, name: str) -> Store:
    """A store of its own in the shared folder."""
    return Store(spark, shared_dir(spark, f"sample-{name}-{uuid.uuid4().hex[:8]}"))


def dim_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.merge_dim_account(dimensions.unknown_account(spark), accounts(spark, sf_dir))


class Star:
    """A star schema of one set of sample transactions, written to the shared folder.

    Each table is loaded and written when it is first asked for, as a warehouse load would, so the
    queries read stored tables instead of repeating the load in every plan. The folder belongs to this
    session, hence nothing is committed for others.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, source: str):
        self.spark, self.sf_dir, self.source = spark, sf_dir, source
        self.store = new_store(spark, source)
        self._tables: dict[str, DataFrame] = {}

    def _stored(self, name: str, build, write=None) -> DataFrame:
        if name not in self._tables:
            (write or self.store.write_snapshot)(name, build())
            self._tables[name] = self.store.read(name)
        return self._tables[name]

    @property
    def staged(self) -> DataFrame:
        read = event_transactions if self.source == "events" else lineitem_transactions
        return read(self.spark, self.sf_dir)

    @property
    def dates(self) -> DataFrame:
        return self._stored(
            "dim_date", lambda: dimensions.dim_date(self.spark, *CALENDARS[self.source])
        )

    @property
    def customers(self) -> DataFrame:
        if "dim_customer" not in self._tables:
            write_customers(self.store, self.sf_dir, self.source)
            self._tables["dim_customer"] = self.store.read("dim_customer")
        return self._tables["dim_customer"]

    @property
    def accounts(self) -> DataFrame:
        return self._stored("dim_account", lambda: dim_account(self.spark, self.sf_dir))

    @property
    def categories(self) -> DataFrame:
        return self._stored(
            "dim_merchant_category", lambda: dimensions.merchant_category_seed(self.spark)
        )

    @property
    def products(self) -> DataFrame:
        return self._stored("dim_loan_product", lambda: dimensions.loan_product_seed(self.spark))

    def load_fact(
        self,
        staged: DataFrame | None = None,
        existing: DataFrame | None = None,
        load_id: int | None = None,
        load_ts: Column | None = None,
    ) -> DataFrame:
        """The fact rows a load would append, not stored."""
        return facts.fact_transactions(
            self.staged if staged is None else staged,
            self.dates,
            self.accounts,
            self.customers,
            self.categories,
            existing,
            load_id,
            load_ts,
        )

    @property
    def fact(self) -> DataFrame:
        """Written part by part, so that the disk holds the shuffles of one part at a time."""
        name = "fact_transactions"
        if name not in self._tables:
            now = F.lit(datetime.now(timezone.utc))
            for part in facts.parts_by_id(self.staged):
                rows = self.load_fact(part, load_id=1, load_ts=now)
                self.store.write_load(name, rows, late={"transaction_key": hash_key("transaction_id")})
            self._tables[name] = self.store.read(name)
        return self._tables[name]

    @property
    def window_points(self) -> DataFrame:
        return self._stored("fact_window_points", lambda: analytics.fact_window_points(self.fact))

    def fraud_days(self, first: int, last: int) -> DataFrame:
        """Months of the published day-level roll-up of fraud."""
        if "fact_fraud_daily" not in self._tables:
            days = views.fraud_by_day(self.fact)
            self.store.write_months("fact_fraud_daily", days, calendar.month_key(F.col("date_key")), 1)
            self._tables["fact_fraud_daily"] = self.store.read("fact_fraud_daily")
        return self.store.read_months("fact_fraud_daily", first, last)

    def warehouse(self, dates: DataFrame | None = None) -> Store:
        """A store of its own with the dimensions published and no facts yet; ``dates`` may be another calendar."""
        store = new_store(self.spark, f"{self.source}-warehouse")
        with store.load():
            store.write_snapshot("dim_date", self.dates if dates is None else dates)
            store.write_snapshot("dim_customer", self.customers)
            store.write_snapshot("dim_account", self.accounts)
            store.write_snapshot("dim_merchant_category", self.categories)
        return store

    def load_loan_months(self) -> DataFrame:
        return facts.fact_loan_monthly(
            loan_snapshots(self.spark, self.sf_dir),
            loans(self.spark, self.sf_dir),
            self.customers,
            self.products,
        )

    @property
    def loan_months(self) -> DataFrame:
        return self._stored("fact_loan_monthly", self.load_loan_months, self.store.write_load)


_STARS: dict[tuple[str, str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str, source: str) -> Star:
    """The star of "events" or "lineitem", loaded once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, source)
    if key not in _STARS:
        _STARS[key] = Star(spark, sf_dir, source)
    return _STARS[key]
