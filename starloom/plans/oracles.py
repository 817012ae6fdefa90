"""The queries of ``queries.py`` again, as plain SQL for an independent engine.

Each statement starts from the sample tables, derives customer history by comparing consecutive
batches (not by merging), and rounds ratios in whole numbers, so agreement is not a matter of sharing
code or floating point. Names and types of the result match the Spark query.
"""

from __future__ import annotations

from starloom.operators.dimensions import LOAN_PRODUCTS, MERCHANT_CATEGORIES
from starloom.plans.queries import BALANCES_END
from starloom.sources.sample import (
    CALENDARS,
    EFFECTIVE_DATES,
    EVENT_CATEGORIES,
    NATION_STATES,
    PRIORITY_LOAN_TYPES,
)

# --- fragments ----------------------------------------------------------------------------------


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, int) else f"'{value}'"


def _values(rows) -> str:
    return "(VALUES " + ", ".join(f"({', '.join(map(_literal, r))})" for r in rows) + ")"


def _rate(numerator: str, denominator: str, digits: int, scale: int = 1) -> str:
    """numerator * scale / denominator rounded half away from zero, as a double; whole numbers only."""
    n = f"(CAST({numerator} AS HUGEINT) * {scale * 10**digits})"
    d = f"CAST({denominator} AS HUGEINT)"
    rounded = f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"
    return f"CASE WHEN {denominator} <> 0 THEN CAST({rounded} AS DOUBLE) / {10**digits} END"


def _cents(money: str) -> str:
    return f"CAST({money} * 100 AS HUGEINT)"


def _percent(part: str, whole: str, digits: int) -> str:
    return _rate(part, whole, digits, 100)


def _money_mean(total: str, rows: str, digits: int) -> str:
    """Mean of a money sum; the sum is taken in cents, so the row count is scaled by 100."""
    return _rate(_cents(total), f"({rows} * 100)", digits)


MONEY = "DECIMAL(38,2)"
CUSTOMER_ID = "'CUST_' || c_custkey || CASE WHEN c_custkey % 50 = 49 THEN '_NEW' ELSE '' END"
ACCOUNT_ID = "'ACC_' || c_custkey || CASE WHEN c_custkey % 40 = 39 THEN '_NEW' ELSE '' END"


def _batch(columns: str, source: str, numbers: str) -> str:
    """Customer batches with derived attributes, one row per customer and batch number."""
    if source == "lineitem":
        joined = "coalesce(CAST(date_trunc('month', first_order) AS DATE), DATE '1995-01-01')"
        firsts = (
            "LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1) fo "
            "ON fo.o_custkey = c_custkey"
        )
    else:
        joined = "CAST(DATE '2023-07-01' + CAST(c_custkey % 200 AS INTEGER) AS DATE)"
        firsts = ""
    return f"""
        SELECT {columns}, md5(concat_ws('|', first_name, last_name, CAST(age AS VARCHAR),
                 CAST(annual_income AS VARCHAR), coalesce(CAST(credit_score AS VARCHAR), ''),
                 credit_band, CAST(dti AS VARCHAR), segment, home_branch_id)) AS row_hash
        FROM (
          SELECT *, CASE WHEN credit_score >= 740 THEN 'excellent'
                         WHEN credit_score BETWEEN 670 AND 739 THEN 'good'
                         WHEN credit_score BETWEEN 580 AND 669 THEN 'fair' ELSE 'poor' END AS credit_band
          FROM (
            SELECT n, {CUSTOMER_ID} AS customer_id, 'C' AS first_name, c_name AS last_name,
                   'C ' || c_name AS full_name, CAST(18 + c_custkey % 60 AS SMALLINT) AS age,
                   CAST(20000 + (c_custkey * 97) % 180000 AS DECIMAL(14,2)) AS annual_income,
                   CAST(CASE WHEN c_custkey % 97 <> 0 THEN 500 + (c_custkey * 37) % 350 END
                        AS SMALLINT) AS credit_score,
                   CAST((c_custkey % 60) * CAST(0.01 AS DECIMAL(6,3)) AS DECIMAL(6,3)) AS dti,
                   CASE WHEN c_custkey % 7 = 0 AND n >= 2 THEN 'affluent'
                        WHEN c_custkey % 11 = 0 AND n >= 3 THEN 'private' ELSE 'mass' END AS segment,
                   {joined} AS join_date, 'BR_' || c_nationkey AS home_branch_id
            FROM customer CROSS JOIN (VALUES {numbers}) AS batch(n) {firsts}))
    """


def _versions(source: str, batches: int = 3) -> str:
    """``dimc``: customer history from consecutive batches, plus the unknown member."""
    numbers = ", ".join(f"({n})" for n in range(1, batches + 1))
    opened = " ".join(
        f"WHEN {n} THEN DATE '{d}'"
        for n, d in enumerate(EFFECTIVE_DATES[source][:batches], start=1)
        if n > 1
    )
    opened = f"CASE n {opened} ELSE DATE '1900-01-01' END" if opened else "DATE '1900-01-01'"
    return f"""
    batches AS ({_batch("*", source, numbers)}),
    changes AS (
      SELECT * FROM batches
      QUALIFY lag(row_hash) OVER (PARTITION BY customer_id ORDER BY n) IS DISTINCT FROM row_hash),
    dated AS (SELECT *, {opened} AS valid_from FROM changes),
    dimc AS (
      SELECT customer_id, full_name, age, annual_income, credit_score, credit_band, dti, segment,
             join_date, home_branch_id, valid_from,
             coalesce(lead(valid_from) OVER w, DATE '9999-12-31') AS valid_to,
             lead(valid_from) OVER w IS NULL AS is_current, row_hash
      FROM dated WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)
      UNION ALL
      SELECT '-1', 'Unknown Customer', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
             DATE '1900-01-01', DATE '9999-12-31', true, 'unknown')"""


ACCOUNTS = f"""
    dima AS (
      SELECT {ACCOUNT_ID} AS account_id, 'CUST_' || c_custkey AS customer_id,
             CASE c_custkey % 3 WHEN 0 THEN 'checking' WHEN 1 THEN 'savings' ELSE 'credit_card' END
               AS product_type,
             CASE WHEN c_custkey % 3 = 2 THEN 'credit' ELSE 'deposit' END AS product_family,
             CAST((c_custkey % 30) * CAST(0.01 AS DECIMAL(6,4)) AS DECIMAL(6,4)) AS apr,
             DATE '2024-01-01' AS open_date, 'active' AS status,
             CAST(c_acctbal AS DECIMAL(16,2)) AS initial_balance
      FROM customer
      UNION ALL
      SELECT '-1', '-1', 'unknown', 'unknown', NULL, NULL, NULL, NULL)"""

CATEGORIES = f"""
    dimm AS (
      SELECT * FROM {_values(MERCHANT_CATEGORIES)}
        AS m(category_code, category_name, is_discretionary, fraud_risk_tier))"""


def _case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


EVENTS_STAGED = f"""
    staged AS (
      SELECT 'E' || event_id AS transaction_id, 'ACC_' || user_id AS account_id,
             CAST(ts AS TIMESTAMP) AS timestamp, CAST(value AS DECIMAL(16,2)) AS amount,
             {_case("event_type", EVENT_CATEGORIES)} AS merchant_category,
             CASE event_id % 2 WHEN 0 THEN 'online' ELSE 'in_person' END AS channel,
             event_id % 37 = 0 AS is_fraud
      FROM events)"""

_CODES = [code for code, *_ in MERCHANT_CATEGORIES[:10]] + ["nope"]
LINEITEM_STAGED = f"""
    staged AS (
      SELECT 'L' || l_orderkey || '-' || l_linenumber AS transaction_id,
             'ACC_' || o_custkey AS account_id, CAST(l_shipdate AS TIMESTAMP) AS timestamp,
             CAST(l_extendedprice AS DECIMAL(16,2)) AS amount,
             list_extract({_CODES}, l_partkey % 11 + 1) AS merchant_category,
             CASE l_linestatus WHEN 'O' THEN 'online' ELSE 'in_person' END AS channel,
             (l_orderkey * 7 + l_linenumber) % 667 = 0 AS is_fraud
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def _fact(source: str) -> str:
    """``fact``: one row per transaction with natural keys, and everything it is built from."""
    first, last = CALENDARS[source]
    staged = EVENTS_STAGED if source == "events" else LINEITEM_STAGED
    return f"""{_versions(source)}, {ACCOUNTS}, {CATEGORIES}, {staged},
    fact AS (
      SELECT t.transaction_id, CAST(strftime(t.timestamp, '%Y%m%d') AS INTEGER) AS date_key,
             CAST(t.timestamp AS DATE) AS full_date, coalesce(a.account_id, '-1') AS account_id,
             coalesce(c.customer_id, '-1') AS customer_id,
             coalesce(c.valid_from, DATE '1900-01-01') AS customer_from,
             coalesce(m.category_code, 'unknown') AS category_code, t.amount,
             t.timestamp AS transaction_ts, CAST(hour(t.timestamp) AS SMALLINT) AS hour_of_day,
             t.channel, t.is_fraud
      FROM (SELECT * FROM staged
            WHERE CAST(timestamp AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'
            QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY timestamp, amount,
                                       account_id, merchant_category, channel, is_fraud) = 1) t
      LEFT JOIN dima a ON a.account_id = t.account_id
      LEFT JOIN dimc c ON c.customer_id = a.customer_id
                      AND c.valid_from <= CAST(t.timestamp AS DATE)
                      AND c.valid_to > CAST(t.timestamp AS DATE)
      LEFT JOIN dimm m ON m.category_code = t.merchant_category)"""


_E, _L = _fact("events"), _fact("lineitem")

LOANS = f"""
    stl AS (
      SELECT 'LN_' || o_orderkey AS loan_id, 'CUST_' || o_custkey AS customer_id,
             {_case("o_orderpriority", PRIORITY_LOAN_TYPES)} AS loan_type,
             CAST(o_totalprice AS DECIMAL(16,2)) AS principal,
             CAST(o_orderdate AS DATE) AS origination_date,
             CAST((CAST(CAST(o_totalprice AS DECIMAL(16,2)) * 100 AS BIGINT) // 36)
                  * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(16,2)) AS monthly_payment,
             500 + (o_orderkey * 13) % 350 AS score,
             o_orderstatus = 'F' AND o_orderkey % 5 = 0 AS defaulted, o_orderkey
      FROM orders),
    snaps AS (
      SELECT stl.*, m, last_day(origination_date + to_months(m)) AS snapshot_date,
             CAST(((CAST(principal * 100 AS BIGINT) * (36 - m)) // 36) * CAST(0.01 AS DECIMAL(3,2))
                  AS DECIMAL(16,2)) AS outstanding_balance,
             CAST(greatest((o_orderkey * 31 + m * 17) % 240 - 120, 0) AS INTEGER) AS days_past_due
      FROM stl CROSS JOIN (SELECT CAST(unnest(range(6)) AS INTEGER) AS m)),
    bucketed AS (
      SELECT *, days_past_due >= 90 AS is_defaulted,
             CASE WHEN days_past_due < 1 THEN 'current' WHEN days_past_due < 30 THEN '1-29'
                  WHEN days_past_due < 60 THEN '30-59' WHEN days_past_due < 90 THEN '60-89'
                  WHEN days_past_due < 180 THEN '90+' ELSE 'charge-off' END AS delinquency_bucket
      FROM snaps)"""

CUSTOMER_COLUMNS = """customer_id, full_name, age, annual_income, credit_score, credit_band, dti,
    segment, join_date, home_branch_id, valid_from, valid_to, is_current, row_hash"""
FACT_COLUMNS = """transaction_id, date_key, account_id, customer_id, customer_from, category_code,
    amount, transaction_ts, hour_of_day, channel, is_fraud"""

WEST, SOUTH = "('CA','WA','OR','AZ','NV','CO')", "('TX','GA','FL','NC','TN')"
NORTHEAST, MIDWEST = "('NY','NJ','PA','MA')", "('IL','MN','OH','MI')"


def _branches(shift: int) -> str:
    return f"""
      SELECT 'BR_' || (s_suppkey + {shift}) AS branch_id, s_name AS branch_name, n_name AS city, state,
             CASE WHEN state IN {WEST} THEN 'West' WHEN state IN {SOUTH} THEN 'South'
                  WHEN state IN {NORTHEAST} THEN 'Northeast' WHEN state IN {MIDWEST} THEN 'Midwest'
                  ELSE 'Other' END AS region,
             CAST(DATE '2000-01-01' + CAST(s_suppkey % 9000 AS INTEGER) AS DATE) AS opened_date
      FROM supplier JOIN nation ON n_nationkey = s_nationkey
      JOIN {_values(list(enumerate(NATION_STATES)))} AS st(k, state) ON k = s_nationkey"""


def _rank_columns(key: str = "account_id") -> str:
    return f"""
      WINDOW w AS (PARTITION BY {key} ORDER BY transaction_ts, transaction_id),
             part AS (PARTITION BY {key}),
             high AS (PARTITION BY {key} ORDER BY amount DESC),
             low AS (PARTITION BY {key} ORDER BY amount, transaction_ts, transaction_id)"""


_TOUR_CTES = f"""{_L},
    t AS (
      SELECT account_id, transaction_ts, transaction_id, full_date, amount,
             row_number() OVER w AS txn_seq, rank() OVER high AS amount_rank,
             dense_rank() OVER high AS amount_dense_rank, ntile(4) OVER low AS amount_quartile,
             lag(amount) OVER w AS prev_amount, lead(amount) OVER w AS next_amount,
             min_by(amount, (transaction_ts, transaction_id)) OVER part AS first_txn_amount,
             max_by(amount, (transaction_ts, transaction_id)) OVER part AS last_txn_amount,
             sum(amount) OVER (w ROWS UNBOUNDED PRECEDING) AS running_total,
             sum(amount) OVER (w ROWS 6 PRECEDING) AS near_sum,
             count(*) OVER (w ROWS 6 PRECEDING) AS near_rows, sum(amount) OVER part AS total
      FROM fact {_rank_columns()})"""
_TOUR = f"""
    SELECT account_id, transaction_ts, transaction_id, full_date, amount, txn_seq, amount_rank,
           amount_dense_rank, amount_quartile, prev_amount, next_amount,
           CAST(amount - prev_amount AS DECIMAL(17,2)) AS change_from_prev, first_txn_amount,
           last_txn_amount, CAST(running_total AS {MONEY}) AS running_total,
           {_money_mean("near_sum", "near_rows", 2)} AS moving_avg_7,
           {_percent(_cents("amount"), _cents("total"), 4)} AS pct_of_account_total
    FROM t"""

_UNCLOSED = f"""
    batches AS ({_batch("*", "events", "(1), (2), (3)")}),
    unclosed AS (
      SELECT customer_id, row_hash,
             CASE n WHEN 1 THEN DATE '{EFFECTIVE_DATES["events"][0]}'
                    WHEN 2 THEN DATE '{EFFECTIVE_DATES["events"][1]}'
                    ELSE DATE '{EFFECTIVE_DATES["events"][2]}' END AS valid_from,
             DATE '9999-12-31' AS valid_to
      FROM batches
      QUALIFY n = 1 OR lag(row_hash) OVER (PARTITION BY customer_id ORDER BY n) <> row_hash)"""


def _broken(table: str, rows: str, grain: str, empty: dict, strange: dict, twice: int) -> str:
    """The violations of rows broken by their day, from rows that break nothing."""
    parts = [
        f"SELECT 'unique' AS constraint_name, '{grain}' AS columns, count(*) AS keys, 2 * count(*) AS rows FROM r WHERE d = {twice}"
    ]
    parts += [f"SELECT 'not null', '{c}', 1, count(*) FROM r WHERE d = {day}" for c, day in empty.items()]
    parts += [f"SELECT 'foreign key', '{c}', 1, count(*) FROM r WHERE d = {day}" for c, day in strange.items()]
    return f"""
    SELECT '{table}' AS table_name, constraint_name, columns, CAST(keys AS BIGINT) AS keys, CAST(rows AS BIGINT) AS rows
    FROM (WITH r AS (SELECT date_key % 100 AS d FROM ({rows})) {" UNION ALL ".join(parts)}) WHERE rows > 0"""


def _retention(same: str) -> str:
    """Retention where ``same`` ties a fact to the current version of its customer."""
    return f"""
    WITH {_L},
    pairs AS (
      SELECT DISTINCT CAST(date_trunc('month', c.join_date) AS DATE) AS cohort_month, c.customer_id,
             date_diff('month', date_trunc('month', c.join_date), date_trunc('month', f.full_date)) AS k
      FROM dimc c JOIN fact f ON f.customer_id = c.customer_id {same}
      WHERE c.is_current AND c.customer_id <> '-1'),
    sizes AS (SELECT cohort_month, count(DISTINCT customer_id) AS size FROM pairs GROUP BY 1)
    SELECT cohort_month, size AS cohort_size, CAST(k AS INTEGER) AS month_offset,
           count(*) AS active_customers, {_percent("count(*)", "size", 1)} AS retention_pct
    FROM pairs JOIN sizes USING (cohort_month)
    WHERE k BETWEEN 0 AND 12 GROUP BY 1, 2, 3"""


_UNION_STAR = "JOIN dimc c ON c.customer_id = f.customer_id AND c.valid_from = f.customer_from"

# --- statements ---------------------------------------------------------------------------------

ORACLES: dict[str, str] = {
    "stage_transactions": f"WITH {LINEITEM_STAGED} SELECT * FROM staged",
    "dim_date": """
    WITH span AS (SELECT date_trunc('year', min(l_shipdate)) AS a,
                         date_trunc('year', max(l_shipdate)) + INTERVAL 1 YEAR AS b FROM lineitem),
    days AS (SELECT CAST(unnest(range(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
           CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
           CAST(month(d) AS SMALLINT) AS month, rpad(monthname(d), 9, ' ') AS month_name,
           CAST(strftime(d, '%V') AS SMALLINT) AS week_of_year,
           CAST(day(d) AS SMALLINT) AS day_of_month, CAST(isodow(d) AS SMALLINT) AS day_of_week,
           rpad(dayname(d), 9, ' ') AS day_name, isodow(d) > 5 AS is_weekend,
           isodow(d) <= 5 AS is_business_day, day(d + 1) = 1 AS is_month_end,
           day(d + 1) = 1 AND month(d) IN (3, 6, 9, 12) AS is_quarter_end,
           strftime(d, '%m-%d') = '12-31' AS is_year_end,
           CAST(year(d) + CASE WHEN month(d) > 9 THEN 1 ELSE 0 END AS SMALLINT) AS fiscal_year,
           'FY' || (year(d) + CASE WHEN month(d) > 9 THEN 1 ELSE 0 END) || '-Q'
             || CASE quarter(d) WHEN 4 THEN 1 ELSE quarter(d) + 1 END AS fiscal_quarter,
           CAST(strftime(d - INTERVAL 1 YEAR, '%Y%m%d') AS INTEGER) AS prior_year_date_key,
           CAST(d - DATE '1970-01-01' AS INTEGER) AS days_from_epoch
    FROM days""",
    "seed_merchant_category": f"""
    WITH {CATEGORIES}, {EVENTS_STAGED}, seen AS (SELECT DISTINCT merchant_category AS code FROM staged)
    SELECT code AS category_code, 'late arrival' AS category_name, false AS is_discretionary,
           'high' AS fraud_risk_tier FROM seen
    UNION ALL SELECT * FROM dimm WHERE category_code NOT IN (SELECT code FROM seen)""",
    "seed_loan_product": f"""
    WITH {LOANS}, seen AS (SELECT DISTINCT loan_type FROM stl)
    SELECT loan_type, 'late arrival' AS product_name, false AS is_secured,
           CAST(36 AS SMALLINT) AS typical_term_months FROM seen
    UNION ALL
    SELECT loan_type, product_name, is_secured, CAST(term AS SMALLINT)
    FROM {_values(LOAN_PRODUCTS)} AS p(loan_type, product_name, is_secured, term)
    WHERE loan_type NOT IN (SELECT loan_type FROM seen)""",
    "merge_dim_branch": f"""
    WITH a AS ({_branches(0)}), b AS ({_branches(5)})
    SELECT * FROM b
    UNION ALL SELECT * FROM a WHERE branch_id NOT IN (SELECT branch_id FROM b)
    UNION ALL SELECT '-1', 'Unknown Branch', NULL, NULL, NULL, NULL""",
    "branch_region": f"SELECT branch_id, state, region FROM ({_branches(0)})",
    "merge_dim_account": f"""
    WITH {ACCOUNTS},
    b AS (
      SELECT 'ACC_' || (c_custkey + 10) AS account_id,
             CASE c_custkey % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'savings' ELSE 'checking' END
               AS product_type,
             CASE WHEN c_custkey % 3 = 0 THEN 'credit' ELSE 'deposit' END AS product_family,
             CAST((c_custkey % 20) * CAST(0.01 AS DECIMAL(6,4)) AS DECIMAL(6,4)) AS apr,
             CASE WHEN c_custkey % 5 = 0 THEN 'closed' END AS status,
             CAST(c_acctbal AS DECIMAL(16,2)) AS initial_balance
      FROM customer)
    SELECT b.account_id, coalesce(a.customer_id, 'CUST_OTHER') AS customer_id, b.product_type,
           b.product_family, b.apr, coalesce(a.open_date, DATE '2025-06-30') AS open_date, b.status,
           b.initial_balance
    FROM b LEFT JOIN dima a USING (account_id)
    UNION ALL SELECT * FROM dima WHERE account_id NOT IN (SELECT account_id FROM b)""",
    "customer_row_hash": f"SELECT customer_id, row_hash FROM ({_batch('*', 'events', '(1)')})",
    "credit_band": f"""
    SELECT credit_band, count(*) AS customers, CAST(min(credit_score) AS INTEGER) AS lowest_score,
           CAST(max(credit_score) AS INTEGER) AS highest_score
    FROM ({_batch("*", "events", "(1)")}) GROUP BY 1""",
    "scd2_merge_initial": f"WITH {_versions('events', 1)} SELECT {CUSTOMER_COLUMNS} FROM dimc",
    "scd2_merge_noop": f"WITH {_versions('events', 2)} SELECT {CUSTOMER_COLUMNS} FROM dimc",
    "scd2_merge_change": f"WITH {_versions('events')} SELECT {CUSTOMER_COLUMNS} FROM dimc",
    "unknown_members": """
    SELECT * FROM (VALUES ('dim_customer', '-1', CAST(1 AS BIGINT)), ('dim_account', '-1', 1),
      ('dim_branch', '-1', 1), ('dim_merchant_category', 'unknown', 1),
      ('dim_loan_product', 'unknown', 1)) AS u(dimension, natural_key, members)""",
    "surrogate_keys": f"""
    WITH {_versions("events")}, {ACCOUNTS}
    SELECT 'dim_customer' AS dimension, count(*) AS members,
           count(DISTINCT (customer_id, valid_from)) AS distinct_keys FROM dimc
    UNION ALL SELECT 'dim_account', count(*), count(DISTINCT account_id) FROM dima""",
    "load_report": f"""
    WITH {_E}
    SELECT 'stg_transactions' AS step, count(*) AS rows FROM staged
    UNION ALL SELECT 'dim_date', DATE '{CALENDARS["events"][1]}' - DATE '{CALENDARS["events"][0]}' + 1
    UNION ALL SELECT 'dim_customer', count(*) FROM dimc
    UNION ALL SELECT 'dim_account', count(*) FROM dima
    UNION ALL SELECT 'dim_merchant_category', count(*) FROM dimm
    UNION ALL SELECT 'fact_transactions', count(*) FROM fact""",
    "fact_transactions": f"WITH {_L} SELECT {FACT_COLUMNS}, CAST(1 AS BIGINT) AS load_id FROM fact",
    "fact_incremental_append": f"""
    WITH {_E} SELECT {FACT_COLUMNS}, CAST(2 AS BIGINT) AS load_id FROM fact
    WHERE transaction_ts >= TIMESTAMP '2024-01-16 00:00:00'""",
    "load_accounting": f"""
    WITH {_E}, numbered AS (
      SELECT 1 AS load_id, * FROM staged WHERE timestamp < TIMESTAMP '2024-01-16 00:00:00'
      UNION ALL SELECT 2, * FROM staged
      UNION ALL SELECT n, s.* FROM staged s, (VALUES (1), (2)) AS loads(n) WHERE is_fraud),
    marked AS (
      SELECT load_id, transaction_id, CAST(timestamp AS DATE) <= DATE '2024-01-25' AS inside,
             min(load_id) FILTER (CAST(timestamp AS DATE) <= DATE '2024-01-25') OVER (PARTITION BY transaction_id) AS loaded_by
      FROM numbered),
    counted AS (
      SELECT load_id, count(*) AS staged, count(*) FILTER (NOT inside) AS out_of_calendar,
             count(*) FILTER (inside) - count(DISTINCT transaction_id) FILTER (inside) AS duplicate,
             count(DISTINCT transaction_id) FILTER (inside AND loaded_by < load_id) AS loaded_before,
             count(DISTINCT transaction_id) FILTER (inside AND loaded_by = load_id) AS inserted
      FROM marked GROUP BY 1)
    SELECT CAST(load_id AS BIGINT) AS load_id, outcome, rows
    FROM (UNPIVOT counted ON staged, out_of_calendar, duplicate, loaded_before, inserted INTO NAME outcome VALUE rows)""",
    "fraud_days_refreshed": f"""
    WITH {_L} SELECT date_key, count(*) AS fraud_count, CAST(sum(amount) AS {MONEY}) AS fraud_amount
    FROM fact WHERE is_fraud GROUP BY 1""",
    "unknown_member_fallback": f"""
    WITH {_L} SELECT account_id = '-1' AS unknown_account, customer_id = '-1' AS unknown_customer,
      category_code = 'unknown' AS unknown_merchant_category, count(*) AS rows,
      CAST(sum(amount) AS {MONEY}) AS amount
    FROM fact GROUP BY 1, 2, 3""",
    "point_in_time_join": f"""
    WITH {_versions("events")}, {EVENTS_STAGED}
    SELECT transaction_id, replace(s.account_id, 'ACC_', 'CUST_') AS user_id, timestamp, amount,
           segment, credit_band, valid_from
    FROM staged s LEFT JOIN dimc c ON c.customer_id = replace(s.account_id, 'ACC_', 'CUST_')
      AND CAST(timestamp AS DATE) >= valid_from AND CAST(timestamp AS DATE) < valid_to""",
    "fact_daily_balances": f"""
    WITH {_E},
    opened AS (
      SELECT account_id, customer_id, coalesce(initial_balance, 0) AS opening,
             coalesce(open_date, (SELECT min(full_date) FROM fact f WHERE f.account_id = a.account_id))
               AS first_day
      FROM dima a),
    grid AS (
      SELECT *, CAST(unnest(generate_series(first_day, DATE '{BALANCES_END}', INTERVAL 1 DAY)) AS DATE) AS d
      FROM opened),
    daily AS (
      SELECT account_id, full_date AS d, sum(amount) AS net,
             sum(CASE WHEN amount < 0 THEN -amount ELSE 0 END) AS debits,
             sum(CASE WHEN amount >= 0 THEN amount ELSE 0 END) AS credits, count(*) AS n
      FROM fact GROUP BY 1, 2)
    SELECT CAST(strftime(g.d, '%Y%m%d') AS INTEGER) AS date_key, g.account_id,
           coalesce(c.customer_id, '-1') AS owner_id,
           coalesce(c.valid_from, DATE '1900-01-01') AS owner_from,
           CAST(opening + coalesce(sum(net) OVER (PARTITION BY g.account_id ORDER BY g.d), 0)
                AS DECIMAL(16,2)) AS closing_balance,
           CAST(coalesce(debits, 0) AS DECIMAL(16,2)) AS total_debits,
           CAST(coalesce(credits, 0) AS DECIMAL(16,2)) AS total_credits,
           CAST(coalesce(n, 0) AS INTEGER) AS transaction_count
    FROM grid g LEFT JOIN daily USING (account_id, d)
    LEFT JOIN dimc c ON c.customer_id = g.customer_id AND g.d >= c.valid_from AND g.d < c.valid_to""",
    "fact_loan_monthly": f"""
    WITH {_versions("lineitem")}, {LOANS}
    SELECT CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS date_key, loan_id,
           coalesce(c.customer_id, '-1') AS customer_id,
           coalesce(c.valid_from, DATE '1900-01-01') AS customer_from,
           CASE loan_type WHEN 'boat' THEN 'unknown' ELSE loan_type END AS loan_type,
           outstanding_balance, monthly_payment AS scheduled_payment,
           CAST(0 AS DECIMAL(16,2)) AS principal_paid, CAST(0 AS DECIMAL(16,2)) AS interest_paid,
           days_past_due, delinquency_bucket, is_defaulted
    FROM bucketed b LEFT JOIN dimc c ON c.customer_id = b.customer_id
      AND snapshot_date >= c.valid_from AND snapshot_date < c.valid_to""",
    "dpd_bucket": f"""
    WITH {LOANS} SELECT delinquency_bucket, count(*) AS loan_months,
      min(days_past_due) AS lowest_dpd, max(days_past_due) AS highest_dpd FROM bucketed GROUP BY 1""",
    "v_current_customers": f"""
    WITH {_versions("events")}
    SELECT customer_id, full_name, age, annual_income, credit_score, credit_band, dti, segment,
           join_date, home_branch_id
    FROM dimc WHERE is_current AND customer_id <> '-1'""",
    "v_customer_history": f"""
    WITH {_versions("events")}
    SELECT customer_id, segment, credit_band, credit_score, valid_from, valid_to, is_current,
           CASE WHEN NOT is_current THEN CAST(valid_to - valid_from AS INTEGER) END AS days_in_version,
           CAST(count(*) OVER (PARTITION BY customer_id ORDER BY valid_from) AS INTEGER)
             AS version_number
    FROM dimc WHERE customer_id <> '-1'""",
    "v_transaction_enriched": f"""
    WITH {_L}
    SELECT transaction_id, full_date, CAST(year(full_date) AS SMALLINT) AS year,
           CAST(month(full_date) AS SMALLINT) AS month,
           rpad(monthname(full_date), 9, ' ') AS month_name,
           rpad(dayname(full_date), 9, ' ') AS day_name, isodow(full_date) IN (6, 7) AS is_weekend,
           transaction_ts, hour_of_day, amount, channel, is_fraud, category_name AS merchant_category,
           is_discretionary, fraud_risk_tier, f.account_id, product_type, product_family,
           f.customer_id, full_name AS customer_name, segment AS segment_at_txn_time,
           credit_band AS credit_band_at_txn_time
    FROM fact f {_UNION_STAR} JOIN dima a ON a.account_id = f.account_id
    JOIN dimm m ON m.category_code = f.category_code""",
    "mv_monthly_transaction_summary": f"""
    WITH {_L}
    SELECT CAST(date_key // 10000 AS SMALLINT) AS year,
           CAST(date_key // 100 % 100 AS SMALLINT) AS month, segment,
           category_name AS merchant_category, count(*) AS transaction_count,
           CAST(sum(amount) AS {MONEY}) AS total_amount,
           {_money_mean("sum(amount)", "count(*)", 6)} AS avg_amount,
           count(*) FILTER (is_fraud) AS fraud_count,
           CAST(sum(amount) FILTER (is_fraud) AS {MONEY}) AS fraud_amount,
           count(DISTINCT (f.customer_id, f.customer_from)) AS distinct_customers
    FROM fact f {_UNION_STAR} JOIN dimm m ON m.category_code = f.category_code
    GROUP BY 1, 2, 3, 4""",
    "point_in_time_customer": f"""
    WITH {_versions("events")}
    SELECT customer_id, full_name, segment, credit_score, credit_band, valid_from, valid_to
    FROM dimc WHERE valid_from <= DATE '2024-01-15' AND valid_to > DATE '2024-01-15'""",
    "fraud_lookup": f"""
    WITH {_L} SELECT count(*) AS count, CAST(sum(amount) AS {MONEY}) AS sum_amount
    FROM fact WHERE is_fraud AND full_date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'""",
    "monthly_volume": f"""
    WITH {_L}
    SELECT CAST(year(full_date) AS SMALLINT) AS year, CAST(month(full_date) AS SMALLINT) AS month,
           count(*) AS txn_count, CAST(sum(amount) AS {MONEY}) AS total_amount,
           min(amount) AS min_amount, max(amount) AS max_amount,
           {_money_mean("sum(amount)", "count(*)", 2)} AS avg_amount
    FROM fact GROUP BY 1, 2""",
    "fraud_rate_by_category": f"""
    WITH {_L}
    SELECT category_name, fraud_risk_tier, count(*) AS total_txns,
           count(*) FILTER (is_fraud) AS fraud_txns,
           {_percent("count(*) FILTER (is_fraud)", "count(*)", 4)} AS fraud_rate_pct,
           CAST(sum(amount) FILTER (is_fraud) AS {MONEY}) AS fraud_amount,
           {_money_mean("sum(amount) FILTER (is_fraud)", "count(*) FILTER (is_fraud)", 2)}
             AS avg_fraud_amount,
           {_money_mean("sum(amount) FILTER (NOT is_fraud)", "count(*) FILTER (NOT is_fraud)", 2)}
             AS avg_normal_amount
    FROM fact f JOIN dimm m ON m.category_code = f.category_code GROUP BY 1, 2""",
    "channel_pivot": f"""
    WITH {_L}
    SELECT segment, count(*) AS total_txns, count(*) FILTER (channel = 'online') AS online_txns,
           count(*) FILTER (channel = 'in_person') AS in_person_txns,
           {_percent("count(*) FILTER (channel = 'online')", "count(*)", 1)} AS pct_online,
           {_money_mean("sum(amount) FILTER (channel = 'online')",
                        "count(*) FILTER (channel = 'online')", 2)} AS avg_online_amt,
           {_money_mean("sum(amount) FILTER (channel = 'in_person')",
                        "count(*) FILTER (channel = 'in_person')", 2)} AS avg_in_person_amt
    FROM fact f {_UNION_STAR} WHERE f.customer_id <> '-1' GROUP BY 1""",
    "filter_vs_case": f"""
    WITH {_E}
    SELECT channel, count(*) FILTER (amount > 100) AS filter_count,
           count(CASE WHEN amount > 100 THEN 1 END) AS case_count,
           CAST(sum(amount) FILTER (amount > 100) AS {MONEY}) AS filter_sum,
           CAST(sum(CASE WHEN amount > 100 THEN amount END) AS {MONEY}) AS case_sum
    FROM fact GROUP BY 1""",
    "amount_percentiles": f"""
    WITH {_L},
    ranked AS (
      SELECT segment, CAST(amount AS DECIMAL(28,10)) AS v,
             row_number() OVER (PARTITION BY segment ORDER BY amount) - 1 AS r,
             count(*) OVER (PARTITION BY segment) AS n
      FROM fact f {_UNION_STAR} WHERE f.customer_id <> '-1'),
    ends AS (
      SELECT segment, p, n, (p * (n - 1)) % 100 AS part,
             max(v) FILTER (r = (p * (n - 1)) // 100) AS a,
             max(v) FILTER (r = (p * (n - 1) + 99) // 100) AS b
      FROM ranked CROSS JOIN (VALUES (50), (90), (99)) AS marks(p) GROUP BY 1, 2, 3),
    marks AS (SELECT segment, p, {_rate("CAST(a * 100 AS HUGEINT) * 100 + part * CAST((b - a) * 100 AS HUGEINT)", "10000", 2)} AS q
              FROM ends),
    totals AS (SELECT segment, count(*) AS n, sum(amount) AS s, max(amount) AS m
               FROM fact f {_UNION_STAR} WHERE f.customer_id <> '-1' GROUP BY 1)
    SELECT t.segment, t.n, {_money_mean("s", "t.n", 2)} AS mean,
           max(q) FILTER (p = 50) AS median, max(q) FILTER (p = 90) AS p90,
           max(q) FILTER (p = 99) AS p99, m AS max
    FROM totals t JOIN marks USING (segment) GROUP BY t.segment, t.n, s, m""",
    "amount_percentile_disc": f"""
    WITH {_L}
    SELECT segment, quantile_disc(amount, 0.5) AS median, quantile_disc(amount, 0.9) AS p90,
           quantile_disc(amount, 0.99) AS p99
    FROM fact f {_UNION_STAR} WHERE f.customer_id <> '-1' GROUP BY 1""",
    "running_balance": f"""
    WITH {_L}
    SELECT account_id, transaction_id, full_date, amount,
           CAST(sum(amount) OVER (w ROWS UNBOUNDED PRECEDING) AS {MONEY}) AS running_total,
           lag(amount) OVER w AS prior_amount
    FROM fact WINDOW w AS (PARTITION BY account_id ORDER BY transaction_ts, transaction_id)""",
    "window_tour": f"WITH {_TOUR_CTES} {_TOUR}",
    "window_tour_report": f"""
    WITH {_TOUR_CTES} {_TOUR} ORDER BY account_id, transaction_ts, transaction_id LIMIT 20""",
    "ranking_ties": f"""
    WITH {_L}
    SELECT account_id, transaction_id, amount,
           row_number() OVER (PARTITION BY account_id
             ORDER BY amount DESC, transaction_ts, transaction_id) AS amount_row_number,
           rank() OVER high AS amount_rank, dense_rank() OVER high AS amount_dense_rank
    FROM fact WINDOW high AS (PARTITION BY account_id ORDER BY amount DESC)""",
    "last_value_frames": f"""
    WITH {_L}
    SELECT account_id, transaction_id, last_value(amount) OVER w AS default_frame_last,
           last_value(amount) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
             AS full_frame_last
    FROM fact WINDOW w AS (PARTITION BY account_id ORDER BY transaction_ts, transaction_id)""",
    "window_row_count": f"""
    WITH {_E}
    SELECT channel, count(*) AS fact_rows, count(s) AS windowed_rows,
           count(DISTINCT account_id) AS groups
    FROM (SELECT *, sum(amount) OVER (PARTITION BY account_id) AS s FROM fact) GROUP BY 1""",
    "monthly_growth": f"""
    WITH {_L},
    months AS (
      SELECT year(full_date) AS y, month(full_date) AS m, segment, sum(amount) AS total
      FROM fact f {_UNION_STAR} GROUP BY 1, 2, 3),
    pairs AS (SELECT *, lag(total) OVER (PARTITION BY segment ORDER BY y, m) AS prior FROM months)
    SELECT CAST(y AS SMALLINT) AS year, CAST(m AS SMALLINT) AS month, segment,
           CAST(total AS {MONEY}) AS total_amount, CAST(prior AS {MONEY}) AS prior_month,
           {_percent(_cents("(total - prior)"), _cents("prior"), 2)} AS mom_growth_pct
    FROM pairs""",
    "top_customers_per_segment": f"""
    WITH {_L},
    spend AS (
      SELECT f.customer_id, full_name, segment, sum(amount) AS total, count(*) AS n
      FROM fact f {_UNION_STAR} WHERE f.customer_id <> '-1' GROUP BY 1, 2, 3)
    SELECT customer_id, full_name, segment, CAST(total AS {MONEY}) AS total_spend, n AS txn_count,
           CAST(row_number() OVER (PARTITION BY segment ORDER BY total DESC, customer_id, full_name)
                AS INTEGER) AS rank_in_segment
    FROM spend QUALIFY rank_in_segment <= 5""",
    "segment_migration": f"""
    WITH {_versions("lineitem")}
    SELECT a.segment AS from_segment, b.segment AS to_segment, count(*) AS customers_moved
    FROM dimc a JOIN dimc b ON b.customer_id = a.customer_id AND b.valid_from = a.valid_to
    WHERE a.customer_id <> '-1' AND a.segment <> b.segment GROUP BY 1, 2""",
    "first_last_txn": f"""
    WITH {_L}
    SELECT customer_id, min(transaction_ts) AS first_txn, max(transaction_ts) AS last_txn,
           CAST(max(full_date) - min(full_date) AS INTEGER) AS days_active, count(*) AS total_txns
    FROM fact WHERE customer_id <> '-1' GROUP BY 1 ORDER BY total_txns DESC, customer_id""",
    "cohort_retention": _retention("AND f.customer_from = c.valid_from"),
    "cohort_retention_by_id": _retention(""),
    "third_highest_amount": f"""
    WITH {_L}
    SELECT account_id, amount, CAST(r AS INTEGER) AS dense_rank
    FROM (SELECT *, dense_rank() OVER (PARTITION BY account_id ORDER BY amount DESC) AS r FROM fact)
    WHERE r = 3""",
    "dedup_transactions": f"""
    WITH {LINEITEM_STAGED}
    SELECT transaction_id, account_id, amount, timestamp FROM staged
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY timestamp, amount, account_id,
                               merchant_category, channel, is_fraud) = 1""",
    "latest_txn_per_account": f"""
    WITH {_E}
    SELECT DISTINCT ON (account_id) account_id, transaction_ts, transaction_id, amount, channel
    FROM fact ORDER BY account_id, transaction_ts DESC, transaction_id DESC""",
    "accounts_without_fraud": f"""
    WITH {_L}
    SELECT account_id, product_type FROM dima
    WHERE account_id <> '-1' AND account_id NOT IN (SELECT account_id FROM fact WHERE is_fraud)""",
    "not_in_null_trap": f"""
    WITH people AS ({_batch("*", "events", "(1)")}), {LOANS},
    bad AS (SELECT score FROM stl WHERE defaulted)
    SELECT 'not_in_with_null' AS form, count(*) AS rows FROM people
    WHERE credit_score NOT IN (SELECT credit_score FROM people)
    UNION ALL SELECT 'not_in_without_null', count(*) FROM people
    WHERE credit_score NOT IN (SELECT score FROM bad)
    UNION ALL SELECT 'anti_join', count(*) FROM people p
    WHERE NOT EXISTS (SELECT 1 FROM bad WHERE score = p.credit_score)""",
    "daily_activity": f"WITH {_E} SELECT DISTINCT account_id, full_date FROM fact",
    "activity_streaks": f"""
    WITH {_E},
    days AS (SELECT DISTINCT account_id, full_date AS d FROM fact),
    marked AS (SELECT *, CASE WHEN d - lag(d) OVER w = 1 THEN 0 ELSE 1 END AS opens
               FROM days WINDOW w AS (PARTITION BY account_id ORDER BY d)),
    runs AS (SELECT *, sum(opens) OVER (PARTITION BY account_id ORDER BY d) AS run FROM marked)
    SELECT account_id, min(d) AS streak_start, max(d) AS streak_end, count(*) AS consecutive_days,
           CAST(max(d) - min(d) + 1 AS INTEGER) AS span_check
    FROM runs GROUP BY account_id, run HAVING count(*) >= 5
    ORDER BY consecutive_days DESC, account_id, streak_start""",
    "inactivity_gaps": f"""
    WITH {_L}, days AS (SELECT DISTINCT account_id, full_date AS d FROM fact)
    SELECT account_id, lag(d) OVER w AS last_active, d AS active_again,
           CAST(d - lag(d) OVER w - 1 AS INTEGER) AS idle_days
    FROM days WINDOW w AS (PARTITION BY account_id ORDER BY d) QUALIFY idle_days >= 90""",
    "dormant_accounts": f"""
    WITH {_L}
    SELECT a.account_id, max(full_date) AS last_active,
           CAST(DATE '2001-12-31' - max(full_date) AS INTEGER) AS idle_days
    FROM dima a LEFT JOIN fact f USING (account_id) WHERE a.account_id <> '-1' GROUP BY 1
    HAVING max(full_date) IS NULL OR DATE '2001-12-31' - max(full_date) >= 180""",
    "delinquency_roll_rate": f"""
    WITH {LOANS},
    moves AS (
      SELECT year(b.snapshot_date) AS y, month(b.snapshot_date) AS m, a.delinquency_bucket AS fb,
             b.delinquency_bucket AS tb, count(*) AS n, sum(a.outstanding_balance) AS risk
      FROM bucketed a JOIN bucketed b ON b.loan_id = a.loan_id AND b.m = a.m + 1 GROUP BY 1, 2, 3, 4)
    SELECT CAST(x.y AS SMALLINT) AS year, CAST(x.m AS SMALLINT) AS month, fb AS from_bucket,
           tb AS to_bucket, n AS loan_count, CAST(risk AS {MONEY}) AS balance_at_risk,
           {_percent("n", "whole", 2)} AS roll_rate_pct
    FROM moves x JOIN (SELECT y, m, fb, sum(n) AS whole FROM moves GROUP BY 1, 2, 3) USING (y, m, fb)""",
    "vintage_analysis": f"""
    WITH {LOANS},
    q AS (
      SELECT CAST(year(origination_date) AS INTEGER) AS y,
             CAST(quarter(origination_date) AS INTEGER) AS q, count(*) AS n, sum(principal) AS total,
             sum(score) AS score, count(*) FILTER (defaulted) AS bad
      FROM stl GROUP BY 1, 2),
    r AS (SELECT *, {_rate("score", "n", 1)} AS s, {_percent("bad", "n", 2)} AS rate FROM q)
    SELECT y AS vintage_year, q AS vintage_quarter, n AS loans_originated,
           CAST(total AS {MONEY}) AS total_originated, s AS avg_score_at_origination,
           bad AS defaults, rate AS default_rate_pct, lag(rate) OVER w AS prior_vintage_default_rate,
           round(rate - lag(rate) OVER w, 2) AS default_rate_change,
           round(s - lag(s) OVER w, 1) AS score_change
    FROM r WINDOW w AS (ORDER BY y, q)""",
    "vintage_curve": f"""
    WITH {LOANS},
    firsts AS (
      SELECT year(origination_date) AS y, quarter(origination_date) AS q, loan_id,
             min(m) FILTER (is_defaulted) AS age
      FROM bucketed GROUP BY 1, 2, 3)
    SELECT CAST(y AS INTEGER) AS vintage_year, CAST(q AS INTEGER) AS vintage_quarter,
           k AS months_on_book, count(*) AS loans, count(*) FILTER (age <= k) AS cumulative_defaults,
           {_percent("count(*) FILTER (age <= k)", "count(*)", 2)} AS cumulative_default_pct
    FROM firsts CROSS JOIN (SELECT CAST(unnest(range(6)) AS INTEGER) AS k) GROUP BY 1, 2, 3""",
    "check_one_current": f"""
    WITH {_UNCLOSED} SELECT customer_id, count(*) AS rows FROM unclosed GROUP BY 1 HAVING count(*) > 1""",
    "check_scd2_overlap": f"""
    WITH {_UNCLOSED}
    SELECT DISTINCT a.customer_id FROM unclosed a JOIN unclosed b
      ON b.customer_id = a.customer_id AND b.row_hash <> a.row_hash
     AND a.valid_from < b.valid_to AND b.valid_from < a.valid_to""",
    "check_validity_order": f"""
    WITH {_versions("lineitem")}
    SELECT customer_id, valid_from, least(valid_to, join_date) AS valid_to
    FROM dimc WHERE least(valid_to, join_date) <= valid_from""",
    "check_pit_unique": f"""
    WITH {_UNCLOSED}, {EVENTS_STAGED},
    pairs AS (SELECT DISTINCT replace(account_id, 'ACC_', 'CUST_') AS customer_id,
                     CAST(timestamp AS DATE) AS day FROM staged)
    SELECT p.customer_id, day, count(u.customer_id) AS versions
    FROM pairs p LEFT JOIN unclosed u ON u.customer_id = p.customer_id
      AND day >= valid_from AND day < valid_to
    GROUP BY 1, 2 HAVING count(u.customer_id) <> 1""",
    "check_fact_grain": f"""
    WITH {LINEITEM_STAGED}
    SELECT transaction_id, count(*) AS rows FROM staged GROUP BY 1 HAVING count(*) > 1""",
    "check_foreign_keys": f"""
    WITH {_L}
    SELECT 'account_id' AS fk, account_id AS key, count(*) AS rows FROM staged
    WHERE account_id NOT IN (SELECT account_id FROM dima) GROUP BY 2
    UNION ALL SELECT 'merchant_category', merchant_category, count(*) FROM staged
    WHERE merchant_category NOT IN (SELECT category_code FROM dimm) GROUP BY 2
    UNION ALL SELECT 'transaction_date', strftime(timestamp, '%Y-%m-%d'), count(*) FROM staged
    WHERE CAST(timestamp AS DATE) NOT BETWEEN DATE '{CALENDARS["lineitem"][0]}'
          AND DATE '{CALENDARS["lineitem"][1]}' GROUP BY 2""",
    "check_not_null": f"""
    WITH {_versions("events")},
    nulls AS (
      SELECT unnest([{", ".join(f"'{c.strip()}'" for c in CUSTOMER_COLUMNS.split(","))}]) AS column_name,
             unnest([{", ".join(f"count(*) - count({c.strip()})" for c in CUSTOMER_COLUMNS.split(","))}])
               AS null_rows
      FROM dimc)
    SELECT * FROM nulls WHERE null_rows > 0""",
    "unknown_member_rate": f"""
    WITH {_L}
    SELECT 'account_key' AS fk, count(*) FILTER (account_id = '-1') AS unknown_rows,
           count(*) AS total_rows FROM fact
    UNION ALL SELECT 'customer_key', count(*) FILTER (customer_id = '-1'), count(*) FROM fact
    UNION ALL SELECT 'merchant_category_key', count(*) FILTER (category_code = 'unknown'), count(*)
    FROM fact""",
    "reconcile_totals": f"""
    WITH {_L}, s AS (SELECT count(*) AS n, sum(amount) AS total FROM staged),
    f AS (SELECT count(*) AS n, sum(amount) AS total FROM fact)
    SELECT s.n AS staged_rows, f.n AS fact_rows, CAST(s.total AS {MONEY}) AS staged_amount,
           CAST(f.total AS {MONEY}) AS fact_amount, s.n - f.n AS row_difference,
           CAST(s.total - f.total AS {MONEY}) AS amount_difference
    FROM s CROSS JOIN f""",
}

ORACLES["fraud_lookup_scan"] = ORACLES["fraud_lookup"]
ORACLES["monthly_summary_refreshed"] = ORACLES["mv_monthly_transaction_summary"]
ORACLES["daily_balances_published"] = ORACLES["fact_daily_balances"]
ORACLES["check_fact_constraints"] = " UNION ALL ".join(
    [
        _broken("fact_transactions", f"WITH {_L} SELECT date_key FROM fact", "transaction_id", {"channel": 15, "customer_key": 16}, {"date_key": 17, "account_key": 19}, 18),
        _broken("fact_daily_balances", ORACLES["fact_daily_balances"], "date_key,account_key", {"closing_balance": 5, "account_key": 6}, {"customer_key": 7}, 8),
        _broken("fact_loan_monthly", ORACLES["fact_loan_monthly"], "date_key,loan_id", {"delinquency_bucket": 28}, {"loan_product_key": 30}, 31),
    ]
)
