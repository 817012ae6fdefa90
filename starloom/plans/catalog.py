"""SQL access: published tables and views under their names in the session."""

from __future__ import annotations

from starloom.plans import views
from starloom.session import use_utc
from starloom.sources.store import Store


def register_views(store: Store) -> list[str]:
    """Register every published table, and the views that can be built from them, for ``spark.sql``.

    Names point at the versions current now; call again after a load.
    """
    use_utc(store.spark)
    tables = {
        name: found for name in store.tables() if (found := store.read_if_exists(name)) is not None
    }
    if "dim_customer" in tables:
        tables["v_current_customers"] = views.v_current_customers(tables["dim_customer"])
        tables["v_customer_history"] = views.v_customer_history(tables["dim_customer"])
    star = ["fact_transactions", "dim_date", "dim_account", "dim_customer", "dim_merchant_category"]
    if all(name in tables for name in star):
        tables["v_transaction_enriched"] = views.v_transaction_enriched(*[tables[n] for n in star])
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
