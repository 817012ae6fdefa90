"""Published tables as plain Parquet folders and a log of what was published.

Without a table format there is no MERGE and no atomic overwrite, so nothing is ever overwritten:
a dimension is written as a whole new folder, a fact load as one more folder, and one append to the
log makes everything written since the last commit visible at once. A reader resolves the log once
and then reads folders that never change, so a refresh does not disturb it; a load that dies before
its commit leaves unlisted folders and is simply run again. A commit is refused where another writer
has published since this store last looked.

Tables grow in one of four ways: a snapshot replaces the one before; a load is added to the others; a history is a
snapshot of its open versions plus every folder of versions closed by a merge, which is never written again; a monthly
table has one folder for each month, and a new one replaces the months it was computed for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import calendar
from starloom.schemas import columns
from starloom.session import dropping_shuffles

# Rows of a published table, and which writing they belong to.
_ENTRY = columns(
    "table string, kind string, version bigint, folder string, rows bigint, load_id bigint, part string"
)
_LOG = T.StructType([*_ENTRY.fields, T.StructField("published_at", T.TimestampType())])


def _listed(months: list[int]) -> str:
    return ",".join(str(m) for m in sorted(months))


class Store:
    """Tables below one root folder, which must be reachable from every executor."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._loading = False
        # An existing log is left alone; a new store starts with an empty one.
        spark.createDataFrame([], _LOG).write.mode("ignore").parquet(f"{self.root}/_published")
        self.refresh()

    # --- reading ------------------------------------------------------------------------------

    def log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/_published")

    def refresh(self) -> None:
        """Look again at what other sessions published; uncommitted writings are forgotten."""
        self._listed = [tuple(r) for r in self.log().select(*_ENTRY.fieldNames()).collect()]
        self._written: list[tuple] = []

    def entries(self, table: str) -> list[dict]:
        """Log rows of a table, oldest first: one per publication, never data."""
        named = [dict(zip(_ENTRY.fieldNames(), e)) for e in self._listed + self._written]
        return sorted((e for e in named if e["table"] == table), key=lambda e: e["version"])

    def tables(self) -> list[str]:
        return sorted({e[0] for e in self._listed + self._written})

    def read(self, table: str) -> DataFrame:
        """The newest snapshot, or all appended loads."""
        found = self.read_if_exists(table)
        if found is None:
            raise LookupError(f"{table} has not been published")
        return found

    def read_if_exists(self, table: str) -> DataFrame | None:
        entries = self.entries(table)
        snapshots = [e for e in entries if e["kind"] == "snapshot"]
        if snapshots:
            return self._read(table, [snapshots[-1], *[e for e in entries if e["kind"] == "closed"]])
        if any(e["kind"] == "months" for e in entries):
            return self.read_months(table)
        return self._read(table, [e for e in entries if e["kind"] == "load"])

    def read_months(self, table: str, first: int | None = None, last: int | None = None) -> DataFrame | None:
        """The months of a monthly table from ``first`` to ``last``; folders of others are not opened."""
        newest = {int(m): e for e in self.entries(table) if e["kind"] == "months" for m in e["part"].split(",") if m}
        folders = {m: newest[m] | {"folder": f"{newest[m]['folder']}/part_month={m}"} for m in sorted(newest)}
        wanted = [e for m, e in folders.items() if (first or m) <= m <= (last or m)]
        if folders and not wanted:
            return self._read(table, list(folders.values())[:1]).where(F.lit(False))
        return self._read(table, wanted)

    def months(self, table: str) -> list[int]:
        """The months a monthly table has."""
        return sorted({int(m) for e in self.entries(table) if e["kind"] == "months" for m in e["part"].split(",") if m})

    def read_open(self, table: str) -> DataFrame | None:
        """The open versions of a history: one folder, however long the history is."""
        snapshots = [e for e in self.entries(table) if e["kind"] == "snapshot"]
        return self._read(table, snapshots[-1:])

    def read_closed(self, table: str) -> DataFrame | None:
        """The versions that merges have closed."""
        return self._read(table, [e for e in self.entries(table) if e["kind"] == "closed"])

    def rows(self, table: str) -> int:
        """Rows of a snapshot or a history, as noted when they were written."""
        entries = self.entries(table)
        newest = [e["rows"] for e in entries if e["kind"] == "snapshot"][-1:]
        return sum(newest + [e["rows"] for e in entries if e["kind"] == "closed"])

    def read_loads(self, table: str, after: int = 0) -> DataFrame | None:
        """What the loads of a fact after a version added."""
        return self._read(table, self.loads(table, after))

    def loads(self, table: str, after: int = 0) -> list[dict]:
        """Log rows of the loads of a fact after a version, oldest first; ``part`` lists the months of each."""
        return [e for e in self.entries(table) if e["kind"] == "load" and e["version"] > after]

    def covered(self, table: str) -> int:
        """The version of the fact that a monthly table was last computed from."""
        return max((e["load_id"] for e in self.entries(table) if e["kind"] == "months"), default=0)

    def _read(self, table: str, entries: list[dict]) -> DataFrame | None:
        # A fact exists from its first row on: a folder split by month has no files without rows.
        folders = [f"{self.root}/{e['folder']}" for e in entries if e["rows"] or e["part"] is None]
        if not folders:
            return None
        if "load=" not in folders[0]:
            return self.spark.read.parquet(*folders)
        found = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*folders)
        return found.drop("load", "closed", "part_month")

    # --- writing ------------------------------------------------------------------------------

    def write_snapshot(self, table: str, df: DataFrame) -> int:
        """Write a whole new version, seen by this store only until the commit; returns its rows."""
        version, folder, found = self._write(table, "v", df, [])
        self.note(table, "snapshot", version, folder, found["rows"])
        return found["rows"]

    def write_load(self, table: str, df: DataFrame, load_id: int | None = None, late: dict[str, Column] | None = None) -> int:
        """Write one load of a fact stored by month, to be added at the commit.

        Columns named in ``late`` are made from the others once the rows lie by month, so they are not shuffled.
        """
        monthly = df.withColumn("month_key", calendar.month_key(F.col("date_key")))
        version, folder, found = self._write_by_month(table, monthly, "month_key", late)
        self.note(table, "load", version, folder, found["rows"], load_id, _listed(found["months"]))
        return found["rows"]

    def write_rows(self, table: str, df: DataFrame, load_id: int | None = None) -> int:
        """Write rows to be added to a small table at the commit."""
        version, folder, found = self._write(table, "load=", df, [])
        self.note(table, "load", version, folder, found["rows"], load_id)
        return found["rows"]

    def write_months(self, table: str, df: DataFrame, month: Column, covers: int) -> int:
        """Write months that replace those of before at the commit; ``covers`` is the version of the fact they include.

        Returns the rows. A month without rows keeps its old folder.
        """
        version, folder, found = self._write_by_month(table, df.withColumn("part_month", month), "part_month")
        self.note(table, "months", version, folder, found["rows"], covers, _listed(found["months"]))
        return found["rows"]

    def write_history(self, table: str, df: DataFrame) -> int:
        """Write the open versions anew, and versions just closed into a folder that stays as it is; returns both.

        ``df`` holds what a merge of the open versions gives: versions closed by earlier merges are not among it.
        """
        marked = df.withColumn("closed", (~F.col("is_current")).cast("int"))
        version, folder, found = self._write(table, "load=", marked, ["closed"], {"shut": F.sum("closed")})
        shut = found["shut"] or 0
        self.note(table, "snapshot", version, f"{folder}/closed=0", found["rows"] - shut)
        if shut:
            self.note(table, "closed", version, f"{folder}/closed=1", shut)
        return found["rows"]

    @contextmanager
    def load(self) -> Iterator[None]:
        """What is written inside becomes visible together at the end, or, after any error, never."""
        if self._loading:
            raise RuntimeError("a load of this store is already running; write into it")
        self._written, self._loading = [], True
        try:
            yield
            self.commit()
        finally:
            self._written, self._loading = [], False

    def commit(self) -> None:
        """Make everything written visible with one append of one file.

        Versions were numbered after what this store has seen, so a log that has moved is refused.
        """
        if self._written:
            if self.log().count() != len(self._listed):
                self._written = []
                raise RuntimeError("another writer has published meanwhile: refresh and run again")
            (
                self.spark.createDataFrame(self._written, _ENTRY)
                .coalesce(1)
                .withColumn("published_at", F.current_timestamp())
                .write.mode("append")
                .parquet(f"{self.root}/_published")
            )
            self._listed += self._written
            self._written = []

    def publish(self, table: str, df: DataFrame) -> int:
        with self.load():
            return self.write_snapshot(table, df)

    def append(self, table: str, df: DataFrame, load_id: int | None = None) -> int:
        with self.load():
            return self.write_load(table, df, load_id)

    def new_folder(self, table: str, prefix: str) -> tuple[int, str]:
        version = max((e["version"] for e in self.entries(table)), default=0) + 1
        return version, f"{table}/{prefix}{version:06d}-{uuid.uuid4().hex[:8]}"

    def _write(self, table, prefix, df, partitions, also=None) -> tuple[int, str, dict]:
        """Write a folder and count its rows, and what else is asked for, on the way."""
        version, folder = self.new_folder(table, prefix)
        counted = Observation()
        more = [c.alias(n) for n, c in (also or {}).items()]
        watched = df.observe(counted, F.count(F.lit(1)).alias("rows"), *more)
        with dropping_shuffles(self.spark):
            watched.write.partitionBy(*partitions).parquet(f"{self.root}/{folder}")
        return version, folder, counted.get

    def _write_by_month(self, table: str, df: DataFrame, month: str, late: dict[str, Column] | None = None) -> tuple[int, str, dict]:
        """The rebalance hint gives each month its own files and splits a month too big for one task.

        Sorting within files keeps their statistics narrow, so day ranges skip row groups.
        """
        order = [month, *[c for c in ("date_key",) if c in df.columns]]
        late = late or {}
        monthly = df.drop(*late).hint("rebalance", month).sortWithinPartitions(*order)
        monthly = monthly.withColumns(late).select(*df.columns) if late else monthly
        return self._write(table, "load=", monthly, [month], {"months": F.collect_set(month)})

    def note(self, table, kind, version, folder, rows, load_id=None, part=None) -> None:
        self._written.append((table, kind, version, folder, rows, load_id, part))
