"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unknown member's surrogate and natural key, and the open and first dates.
UNKNOWN_KEY = -1
UNKNOWN_ID = "-1"
UNKNOWN_CODE = "unknown"
BEGINNING_OF_HISTORY = "1900-01-01"
END_OF_TIME = "9999-12-31"


def hash_key(*natural: Column | str) -> Column:
    """64-bit hash of the natural key: the same on every run, no shuffle, no global counter.

    Two natural keys may share a hash (about one chance in forty at a billion rows), so a table is
    published only after ``quality.check_unique`` on the key.
    """
    return F.xxhash64(*natural)
