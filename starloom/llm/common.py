"""What the corpus operators share: column handling, the shared folder, written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import dropping_shuffles

# Words of the corpus contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """All words of a text, in order; none for an empty one."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; a scratch folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="starloom-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/starloom-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table written to the shared folder: it cuts the lineage and survives lost executors."""
    return written_at(df, new_path(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    """As `written`, at a path of `new_path`; what was shuffled for the rows is dropped."""
    spark = df.sparkSession
    with dropping_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of `written_at` that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Return what a task has freed to the system; called at the end of tasks, as the worker lives on."""
    pa.default_memory_pool().release_unused()


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows of an Arrow batch for what runs inside: bounds the texts that a Python worker holds at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Python workers outlive their tasks, and Spark keeps idle ones: large arrays go back to the system when they are freed.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "2"}


def find_package(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it; elsewhere ship it with --py-files.

    Settings of WORKER_MEMORY hold for these workers where the session sets none of its own.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
