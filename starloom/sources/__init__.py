"""Staged Parquet, the published-table store, and the sample tables mapped to staging."""
