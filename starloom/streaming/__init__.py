"""Incremental loading of transactions as files arrive."""
