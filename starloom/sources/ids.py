"""The ids a fact holds, laid out so that a batch meets them without moving them.

Each load leaves one folder of ids, bucketed by their hash. A batch is dealt into the same buckets and anti-joined with
the folders one after the other, so only the batch is shuffled. Where the ids near a batch are few beside its rows they
are shuffled instead, as an id is a fifth of a row or less and the batch already lies by id once it is deduplicated. The log keeps the smallest and largest id of a folder: a
folder whose range does not meet the batch's is not opened, and within a folder the range skips row groups. Folders are
merged when there are many, so an id is written again about once for every power of MERGE_AFTER loads.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom.sources.store import Store

# A bucket has about this many ids; few ids still get LEAST_BUCKETS, into which a large batch can be dealt.
BUCKET_IDS = 4_000_000
LEAST_BUCKETS = 32
MERGE_AFTER = 16
# As many ids for a row of a batch are moved rather than the row.
MOVED_IDS = 4


def write_ids(store: Store, table: str, ids: DataFrame, rows: int, merged: bool = False) -> DataFrame:
    """Note the ids of a load for the next commit. ``ids`` has one column, each id once; ``rows`` are about as many.

    Returns the ids as written, which Spark groups by id without a shuffle.
    """
    (name,) = ids.columns
    buckets = max(LEAST_BUCKETS, 1 << math.ceil(math.log2(max(1, rows / BUCKET_IDS))))
    version, folder = store.new_folder(f"{table}_ids", "v")
    found = Observation()
    watched = ids.observe(found, F.count(F.lit(1)).alias("rows"), F.min(name).alias("first"), F.max(name).alias("last"))
    entry = f"starloom_ids_{uuid.uuid4().hex}"
    writer = watched.repartition(buckets, name).write.format("parquet").bucketBy(buckets, name).sortBy(name)
    writer.option("path", f"{store.root}/{folder}").saveAsTable(entry)
    store.spark.sql(f"DROP TABLE {entry}")  # the files stay; readers name their buckets themselves
    part = json.dumps({"column": name, "buckets": buckets, "first": found.get["first"], "last": found.get["last"]})
    store.note(f"{table}_ids", "merged" if merged else "load", version, folder, found.get["rows"], part=part)
    return _bucketed(store, {"folder": folder, "column": name, "buckets": buckets})


def id_folders(store: Store, table: str) -> list[dict]:
    """Folders not merged into a later one, with what the log says of each."""
    entries = store.entries(f"{table}_ids")
    start = max((i for i, e in enumerate(entries) if e["kind"] == "merged"), default=0)
    return [e | json.loads(e["part"]) for e in entries[start:] if e["rows"]]


def _bucketed(store: Store, folder: dict) -> DataFrame:
    """A folder as a table that Spark knows to be bucketed."""
    entry, column = f"starloom_ids_{uuid.uuid4().hex}", folder["column"]
    path = f"{store.root}/{folder['folder']}".replace("'", "\\'")
    store.spark.sql(
        f"CREATE TABLE {entry} ({column} STRING) USING parquet "
        f"CLUSTERED BY ({column}) SORTED BY ({column}) INTO {folder['buckets']} BUCKETS LOCATION '{path}'"
    )
    found = store.spark.table(entry)
    store.spark.sql(f"DROP TABLE {entry}")
    return found


def _near(store: Store, table: str, span: tuple[str, str]) -> list[dict]:
    """Folders whose ids may be among the batch's, those with the fewest buckets first."""
    first, last = span
    near = [f for f in id_folders(store, table) if f["first"] <= last and first <= f["last"]]
    return sorted(near, key=lambda f: f["buckets"])


def few_known(store: Store, table: str, span: tuple[str, str] | None, rows: int) -> bool:
    """Whether the ids near a batch of so many rows are better moved than its rows."""
    return span is None or sum(f["rows"] for f in _near(store, table, span)) <= MOVED_IDS * rows


def dealt(store: Store, table: str, rows: DataFrame, column: str, span: tuple[str, str]) -> DataFrame:
    """The rows in the buckets that ``without_known`` meets first, so that work by id done before it is not dealt again."""
    near = _near(store, table, span)
    return rows.repartition(near[0]["buckets"], column) if near else rows


def without_known(
    store: Store, table: str, rows: DataFrame, column: str, span: tuple[str, str] | None, moved: bool = False
) -> DataFrame:
    """The rows whose id no load has brought yet. ``span`` is the smallest and largest id of the rows, None without any.

    With ``moved`` the ids come to the rows, wherever these lie.
    """
    if span is None:
        return rows
    first, last = span
    near, buckets = _near(store, table, span), 0
    if moved and near:
        known = store.spark.read.parquet(*[f"{store.root}/{f['folder']}" for f in near])
        known = known.select(F.col(column).alias("_known")).where(F.col("_known").between(first, last))
        return rows.join(known, F.col(column) == F.col("_known"), "left_anti")
    for folder in near:
        if folder["buckets"] != buckets:
            buckets = folder["buckets"]
            rows = rows.repartition(buckets, column)
        known = _bucketed(store, folder).where(F.col(folder["column"]).between(first, last))
        known = known.withColumnRenamed(folder["column"], "_known")
        rows = rows.join(known, F.col(column) == F.col("_known"), "left_anti")
    return rows


def merge_folders(store: Store, table: str) -> bool:
    """Write one folder in place of many, at the next commit; readers keep theirs."""
    folders = id_folders(store, table)
    if len(folders) < MERGE_AFTER:
        return False
    ids = store.spark.read.parquet(*[f"{store.root}/{f['folder']}" for f in folders])
    write_ids(store, table, ids, sum(f["rows"] for f in folders), merged=True)
    return True
