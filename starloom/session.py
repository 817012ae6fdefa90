"""One place for the session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Do not record the Python call site of every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Calendar dates of timestamps are UTC dates, whatever the session default is."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# Compressed bytes that a task reads from files or shuffles, where the session allows more, and least partitions of a
# shuffle where it has Spark's own number. A task sorts several times these bytes; at Spark's 64 and 128 MB its sorts
# and maps outgrow the memory of a task and spill all they hold.
TASK_BYTES = 16 << 20
SHUFFLE_PARTITIONS = 600


def bound_tasks(spark: SparkSession) -> None:
    """Keep the work of one task small whatever the size of the tables; settings that are smaller already stay."""
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        if _bytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, f"{TASK_BYTES}b")
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(initial, None) is None and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set(initial, str(SHUFFLE_PARTITIONS))


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each query that starts inside drops its shuffle files when it ends, not when the driver next collects its garbage.

    For queries whose rows are written: nothing reads their shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _bytes(size: str) -> int:
    """A size as Spark writes it: 64MB, 16m, 134217728b."""
    text = size.strip().lower().removesuffix("b")
    units = {u: 1 << 10 * n for n, u in enumerate("kmgtp", start=1)}
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder every executor can reach: under ``spark.checkpoint.dir`` where the cluster sets it.

    Where it is unset a scratch folder stands in, but only for a session that runs in one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="starloom-")
    return os.path.join(base, name)
