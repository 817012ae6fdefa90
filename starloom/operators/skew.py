"""Window functions that keep working when one key holds a large share of all rows.

A plain window puts every row of a key into one task. Here the rows of *hot* keys are cut into pieces of about equal
size by split points: places in the order of the window, taken from a sample of the key's rows, so that a key whose rows
all have one timestamp or one amount is cut as well (by what breaks the tie). Each piece is windowed by itself; what lies
outside it (rows, totals and values before it, the neighbours, the last few values) comes from one scan over the pieces
of a key, a table of one row per piece. Results equal the plain window's; rows are never dropped.

Cold keys have no points and a NULL piece, so for them the plan is the plain window: one shuffle by (key, piece).
Split points depend on the rows, not on the query: ``window_points`` finds them once, a load publishes them beside its
fact, and the queries read them. Points of an older state of the rows still give right answers, only less even pieces.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A key is hot when it has more rows than HOT_ROWS and more than HOT_SHARE of all rows. At most
# 1 / HOT_SHARE keys can pass the second test whatever the data, which bounds what is broadcast.
HOT_ROWS = 1_000_000
HOT_SHARE = 1e-5
# Pieces have about HOT_ROWS rows, or the MAX_PIECES-th part of all rows where that is more; so all hot keys together
# have at most MAX_PIECES + 1 / HOT_SHARE pieces.
MAX_PIECES = 20_000
# Sampled rows for each piece, and points in a group: a row is compared with the groups, then with the points of one.
SAMPLED = 64
GROUP = 64


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """The hot values of ``key`` with their rows and pieces: at most 1 / HOT_SHARE of them, by a map-side combined count."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("double")).scalar()
    size = F.greatest(F.lit(float(max(min_rows, 1))), total / MAX_PIECES)
    hot = (F.col("_rows") > min_rows) & (F.col("_rows") > total * HOT_SHARE)
    return counts.where(hot).select(key, "_rows", F.ceil(F.col("_rows") / size).alias("_pieces"))


def magnitude_chunk(value: str) -> Column:
    """Monotone steps about 0.4 % wide: some 8,000 for each sign over all of DECIMAL(16,2)."""
    v = F.col(value).cast("double")
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * 256)


def split_points(df: DataFrame, key: str, places: dict[str, Column], min_rows: int = HOT_ROWS) -> DataFrame:
    """(key, one column of points for each place): where the rows of each hot key are to be cut, in ascending order.

    A place is a struct that ascends along a window and ends in a unique column. The sample is chosen by hash, so the
    points are the same on every run; it has about SAMPLED rows a piece, which bounds the rows of a key in one task by
    SAMPLED * MAX_PIECES. Points are grouped: an array of (first, points) with up to GROUP points each.
    """
    hot = hot_keys(df, key, min_rows)
    every = F.greatest(F.lit(1), F.floor(F.col("_rows") / F.col("_pieces") / SAMPLED)).cast("bigint")
    sample = df.join(F.broadcast(hot), key).where(F.pmod(F.xxhash64(*places.values()), every) == 0)
    cuts = []
    for name, place in places.items():
        rows = sample.select(key, "_pieces", place.alias("_place"))
        order = W.partitionBy(key).orderBy("_place")
        step = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(W.partitionBy(key)) / F.col("_pieces"))).cast("bigint")
        ranked = rows.withColumns({"_n": F.row_number().over(order), "_step": step})
        picked = ranked.where(F.col("_n") % F.col("_step") == 0).withColumn("_group", F.expr(f"(_n div _step - 1) div {GROUP}"))
        groups = picked.groupBy(key, "_group").agg(F.array_sort(F.collect_list("_place")).alias("points"))
        first = F.struct(F.element_at("points", 1).alias("first"), "points")
        cuts.append(groups.groupBy(key).agg(F.array_sort(F.collect_list(first)).alias(name)))
    return reduce(lambda a, b: a.join(b, key), cuts)


def _piece(points: Column, place: Column) -> Column:
    """How many points are at or below a place; NULL without points."""
    upto = F.size(F.filter(points, lambda g: g["first"] <= place))
    here = F.size(F.filter(F.get(points, upto - 1)["points"], lambda p: p <= place))
    return F.when(points.isNull(), None).when(upto == 0, 0).otherwise((upto - 1) * GROUP + here)


def with_pieces(
    df: DataFrame, key: str, points: DataFrame, pieces: dict[str, tuple[str, Column]], how: str = "left"
) -> DataFrame:
    """Add a column for each (points, place): the piece of the row, from 0, and NULL for cold keys.

    Only the points are broadcast, whose number is bounded whatever the data. ``how="inner"`` keeps hot keys alone.
    """
    named = points.select(F.col(key).alias("_key"), *[F.col(column).alias(f"_points_{n}") for n, (column, _) in pieces.items()])
    joined = df.join(F.broadcast(named), F.col(key) == F.col("_key"), how)
    found = {n: _piece(F.col(f"_points_{n}"), place) for n, (_, place) in pieces.items()}
    return joined.select(*[F.col(c) for c in df.columns], *[c.alias(n) for n, c in found.items()])


# --- windows in the order of time and of value --------------------------------------------------------


@dataclass(frozen=True)
class Columns:
    """The columns a window is about: rows of ``key`` in (ts, tiebreak) order, and their ``value``."""

    key: str
    ts: str
    tiebreak: str
    value: str

    def by_time(self) -> Column:
        return F.struct(F.col(self.ts), F.col(self.tiebreak))

    def by_value(self) -> Column:
        """Highest value first, missing ones last, equal ones in time order."""
        value = F.col(self.value)
        return F.struct(value.isNull().alias("missing"), (-value).alias("value"), F.col(self.ts), F.col(self.tiebreak))


def window_points(df: DataFrame, columns: Columns, min_rows: int = HOT_ROWS) -> DataFrame:
    """(key, by_time, by_value): the split points of all windows over these columns."""
    return split_points(df, columns.key, {"by_time": columns.by_time(), "by_value": columns.by_value()}, min_rows)


def _added(here: Column, before: Column) -> Column:
    """A sum over two parts, NULL only where neither part has a value."""
    return F.when(here.isNull(), before).otherwise(here + F.coalesce(before, F.lit(0)))


def windows(
    df: DataFrame,
    columns: Columns,
    points: DataFrame | None = None,
    ordered: bool = True,
    valued: bool = False,
    trailing: int | None = None,
    tiles: int = 4,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add window columns over each key.

    ``ordered``: seq, running, previous, following, first, last, total in (ts, tiebreak) order; with ``trailing`` also
    trailing_sum and trailing_rows over the current row and the ``trailing - 1`` rows before it. ``valued``: position
    (1 = highest value), value_rank, value_dense_rank and tile (1 = lowest values), equal values in (ts, tiebreak) order.
    Columns the caller does not use are pruned by the optimizer. ``points`` are those of ``window_points``, found here
    if not given. The rows are read once, those of hot keys once more for the table of pieces; both orders at once read
    them once more, see ``windows_by_part``.
    """
    key = columns.key
    points = window_points(df, columns, min_rows) if points is None else points
    if ordered and valued:
        return DataFrame.unionByName(*windows_by_part(df, columns, points, trailing, tiles))
    places = {}
    if ordered:
        places["_time"] = ("by_time", columns.by_time())
    if valued:
        places["_rank"] = ("by_value", columns.by_value())
    rows = with_pieces(df, key, points, places)
    if ordered:
        rows = _local_ordered(rows, columns, trailing)
    if valued:
        rows = _local_valued(rows, columns)
    hot = with_pieces(df, key, points, places, "inner")
    carried = _carried(hot, columns, points, ordered, valued, trailing).withColumnRenamed(key, "_hot")
    joined = rows.join(F.broadcast(carried), F.col(key) == F.col("_hot"), "left")
    result = {}
    if ordered:
        result |= _whole_ordered(trailing)
    if valued:
        result |= _whole_valued(columns, tiles)
    return joined.select(*[F.col(c) for c in df.columns], *[c.alias(n) for n, c in result.items()])


def windows_by_part(
    df: DataFrame, columns: Columns, points: DataFrame, trailing: int | None = None, tiles: int = 4
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``windows`` in both orders: those of cold keys, and those of the hot keys of ``points``.

    Rows of cold keys are shuffled once, by key, for both orders and for a join on the key that follows; only those of hot
    keys are shuffled by their piece in time and again by their piece in value.
    """
    key = columns.key
    places = {"_time": ("by_time", columns.by_time()), "_rank": ("by_value", columns.by_value())}
    hot = with_pieces(df, key, points, places, "inner")
    carried = _carried(hot, columns, points, True, True, trailing).withColumnRenamed(key, "_hot")
    known = points.select(F.col(key).alias("_hot"))
    cold = df.join(F.broadcast(known), F.col(key) == F.col("_hot"), "left_anti")
    cold = _local_valued(_local_ordered(cold, columns, trailing, ()), columns, ())
    cold = cold.withColumns({n: F.lit(None).cast(hot.schema[n].dataType) for n in places})
    cold = cold.withColumns({n: F.lit(None).cast(carried.schema[n].dataType) for n in ("_timed", "_valued")})
    hot = _local_valued(_local_ordered(hot, columns, trailing), columns)
    hot = hot.join(F.broadcast(carried), F.col(key) == F.col("_hot"), "left")
    result = _whole_ordered(trailing) | _whole_valued(columns, tiles)
    cold, hot = (part.select(*[F.col(c) for c in df.columns], *[c.alias(n) for n, c in result.items()]) for part in (cold, hot))
    return cold, hot


def ordered_windows(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: str,
    value: str,
    trailing: int | None = None,
    min_rows: int = HOT_ROWS,
    points: DataFrame | None = None,
) -> DataFrame:
    """The columns of ``windows`` in (ts, tiebreak) order."""
    return windows(df, Columns(key, ts, tiebreak, value), points, trailing=trailing, min_rows=min_rows)


def value_windows(
    df: DataFrame,
    key: str,
    value: str,
    ts: str,
    tiebreak: str,
    tiles: int = 4,
    min_rows: int = HOT_ROWS,
    points: DataFrame | None = None,
) -> DataFrame:
    """The columns of ``windows`` in the order of value."""
    return windows(df, Columns(key, ts, tiebreak, value), points, ordered=False, valued=True, tiles=tiles, min_rows=min_rows)


def _local_ordered(rows: DataFrame, columns: Columns, trailing: int | None, by: tuple[str, ...] = ("_time",)) -> DataFrame:
    order = W.partitionBy(columns.key, *by).orderBy(columns.ts, columns.tiebreak)
    to_here = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    v = F.col(columns.value)
    local = {
        "_seq": F.row_number().over(order),
        "_running": F.sum(v).over(to_here),
        "_previous": F.lag(v).over(order),
        "_following": F.lead(v).over(order),
        "_first": F.first(v).over(whole),
        "_last": F.last(v).over(whole),
        "_total": F.sum(v).over(whole),
        "_rows": F.count(F.lit(1)).over(whole),
    }
    if trailing:
        near = order.rowsBetween(-(trailing - 1), W.currentRow)
        local["_near_sum"] = F.sum(v).over(near)
        local["_near_rows"] = F.count(v).over(near)
    return rows.withColumns(local)


def _local_valued(rows: DataFrame, columns: Columns, by: tuple[str, ...] = ("_rank",)) -> DataFrame:
    place = W.partitionBy(columns.key, *by).orderBy(F.desc(columns.value), columns.ts, columns.tiebreak)
    by_value = W.partitionBy(columns.key, *by).orderBy(F.desc(columns.value))
    equal = by_value.rangeBetween(W.currentRow, W.currentRow)
    whole = place.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return rows.withColumns(
        {
            "_position": F.row_number().over(place),
            "_number": F.count(F.lit(1)).over(whole),
            "_value_rank": F.rank().over(by_value),
            "_value_dense": F.dense_rank().over(by_value),
            "_equal": F.count(F.lit(1)).over(equal),
        }
    )


def _carried(
    hot: DataFrame, columns: Columns, points: DataFrame, ordered: bool, valued: bool, trailing: int | None
) -> DataFrame:
    """(key, _timed, _valued): for each hot key, what its pieces need to know of the others, an entry for each piece.

    Both tables of pieces come from one aggregation: rows count once for their piece in time and once for their piece in
    value, there by exact value. It is combined map-side, but for ``trailing``, where rows are ranked in their piece first.
    """
    key, value = columns.key, F.col(columns.value)
    kind = hot.schema[columns.value].dataType
    entries = []
    if ordered:
        entries.append(F.struct(F.lit(True).alias("timed"), F.col("_time").alias("piece"), F.lit(None).cast(kind).alias("exact")))
    if valued:
        entries.append(F.struct(F.lit(False).alias("timed"), F.col("_rank").alias("piece"), value.alias("exact")))
    place = columns.by_time()
    rows = hot.select(key, value.alias("_v"), place.alias("_place"), F.inline(F.array(*entries)))
    last = []
    if ordered and trailing:
        # Rows keep their rank from the end of the piece, so only trailing - 1 rows a piece are gathered.
        newest = W.partitionBy(key, "timed", "piece").orderBy(F.desc("_place"))
        rows = rows.withColumn("_nth", F.row_number().over(newest))
        near = F.col("timed") & (F.col("_nth") < trailing)
        last = [F.collect_list(F.when(near, F.struct("_nth", F.col("_v").alias("v")))).alias("tail")]
    counted = rows.groupBy(key, "timed", "piece", "exact").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_v").alias("s"),
        F.min_by("_v", "_place").alias("first"),
        F.max_by("_v", "_place").alias("last"),
        *last,
    )
    at = F.struct(F.col("exact").alias("v"))
    pieces = counted.groupBy(key, "timed", "piece").agg(
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        F.max("first").alias("first"),
        F.max("last").alias("last"),
        F.count(F.lit(1)).alias("distinct"),
        F.max(at).alias("highest"),
        F.min(at).alias("lowest"),
        F.max_by("n", at).alias("n_highest"),
        F.min_by("n", at).alias("n_lowest"),
        *[F.array_sort(F.first("tail"))["v"].alias("tail") for _ in last],
    )
    tail = []
    if ordered and trailing:
        tail = [F.slice(F.flatten(F.reverse(F.collect_list("tail").over(W.partitionBy(key, "timed").orderBy("piece").rowsBetween(-(trailing - 1), -1)))), 1, trailing - 1).alias("tail")]

    # Along the pieces of a key: sums before, neighbours, and where the run of equal values at each border starts and ends.
    along = W.partitionBy(key, "timed").orderBy("piece")
    before, upto, after = (along.rowsBetween(a, b) for a, b in ((W.unboundedPreceding, -1), (W.unboundedPreceding, 0), (1, W.unboundedFollowing)))
    whole = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    pieces = pieces.withColumns({"rows": F.coalesce(F.sum("n").over(before), F.lit(0)), "above": F.lag("lowest").over(along)})
    pieces = pieces.withColumn("goes_on", F.col("above").isNotNull() & F.col("highest").eqNullSafe(F.col("above")))
    many = F.col("distinct") > 1
    pieces = pieces.withColumns(
        {
            "starts": F.when(many, F.col("rows") + F.col("n") - F.col("n_lowest") + 1).when(~F.col("goes_on"), F.col("rows") + 1),
            "ends": F.when(~F.col("goes_on"), F.col("rows")).when(many, F.col("rows") + F.col("n_highest")),
        }
    )
    pieces = pieces.withColumn("lowest_rank", F.last("starts", ignorenulls=True).over(upto))
    timed = F.struct(
        "piece",
        "rows",
        F.sum("s").over(before).alias("sum"),
        F.lag("last").over(along).alias("previous"),
        F.lead("first").over(along).alias("following"),
        F.first("first").over(whole).alias("first"),
        F.last("last").over(whole).alias("last"),
        F.sum("s").over(whole).alias("total"),
        *tail,
    )
    ranked = F.struct(
        "piece",
        "rows",
        "n_highest",
        F.col("highest.v").alias("highest"),
        F.col("lowest.v").alias("lowest"),
        F.when(F.col("goes_on"), F.lag("lowest_rank").over(along)).otherwise(F.col("rows") + 1).alias("highest_rank"),
        "lowest_rank",
        F.coalesce(F.first("ends", ignorenulls=True).over(after), F.sum("n").over(whole)).alias("lowest_end"),
        (1 + F.coalesce(F.sum("distinct").over(before), F.lit(0)) - F.sum(F.col("goes_on").cast("int")).over(upto)).alias("dense"),
        F.sum("n").over(whole).alias("total"),
    )
    # Pieces without rows get an empty entry, so that a piece is found by its number.
    named = pieces.select(key, "timed", "piece", timed.alias("_t"), ranked.alias("_v"))
    slots = [
        points.select(key, F.lit(is_timed).alias("timed"), F.explode(F.sequence(F.lit(0), _number_of(name))).alias("piece"))
        for is_timed, name, used in ((True, "by_time", ordered), (False, "by_value", valued))
        if used
    ]
    every = reduce(DataFrame.unionByName, slots).join(named, [key, "timed", "piece"], "left")
    return every.groupBy(key).agg(_by_piece("_t", F.col("timed")).alias("_timed"), _by_piece("_v", ~F.col("timed")).alias("_valued"))


def _number_of(points: str) -> Column:
    return (F.size(points) - 1) * GROUP + F.size(F.element_at(points, -1)["points"])


def _by_piece(entry: str, wanted: Column) -> Column:
    listed = F.array_sort(F.collect_list(F.when(wanted, F.struct("piece", F.col(entry).alias("entry")))))
    return listed["entry"]


def _whole_ordered(trailing: int | None) -> dict[str, Column]:
    around, hot = F.get("_timed", F.col("_time")), F.col("_time").isNotNull()
    zero = F.lit(0)
    starts, ends = F.col("_seq") == 1, F.col("_seq") == F.col("_rows")
    result = {
        "seq": F.col("_seq") + F.coalesce(around["rows"], zero),
        "running": _added(F.col("_running"), around["sum"]),
        "previous": F.when(starts, around["previous"]).otherwise(F.col("_previous")),
        "following": F.when(ends, around["following"]).otherwise(F.col("_following")),
        "first": F.when(hot, around["first"]).otherwise(F.col("_first")),
        "last": F.when(hot, around["last"]).otherwise(F.col("_last")),
        "total": F.when(hot, around["total"]).otherwise(F.col("_total")),
    }
    if trailing:
        missing = F.greatest(F.lit(trailing) - F.col("_seq"), zero)
        reached = F.when(around["tail"].isNotNull() & (missing > 0), F.slice(around["tail"], F.lit(1), missing))
        # Sums and counts pass over NULL, as those of a window do.
        known = F.filter(reached, lambda x: x.isNotNull())
        carried = F.aggregate(known, F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x).cast("decimal(38,2)"))
        result["trailing_sum"] = _added(F.col("_near_sum"), F.when(F.size(known) > 0, carried))
        result["trailing_rows"] = F.col("_near_rows") + F.coalesce(F.size(known), zero)
    return result


def _whole_valued(columns: Columns, tiles: int) -> dict[str, Column]:
    """A value at the border of a piece has the rank of its run, which may have begun pieces before."""
    around, hot, value = F.get("_valued", F.col("_rank")), F.col("_rank").isNotNull(), F.col(columns.value)
    at_top, at_bottom = value.eqNullSafe(around["highest"]), value.eqNullSafe(around["lowest"])
    position = F.col("_position") + F.coalesce(around["rows"], F.lit(0))
    rank = F.when(~hot, F.col("_value_rank")).when(at_top, around["highest_rank"]).otherwise(F.col("_value_rank") + around["rows"])
    dense = F.col("_value_dense") + F.coalesce(around["dense"] - 1, F.lit(0))
    # Rows of the run, and from them the place of the row when the lowest value comes first.
    run = F.when(~hot, F.col("_equal")).when(at_bottom, around["lowest_end"] - rank + 1).when(at_top, around["rows"] + around["n_highest"] - rank + 1).otherwise(F.col("_equal"))
    total = F.coalesce(around["total"], F.col("_number"))
    ascending = total - (rank - 1) - run + (position - rank + 1)
    return {"position": position, "value_rank": rank, "value_dense_rank": dense, "tile": _tile(ascending, total, tiles)}


def _tile(row: Column, total: Column, tiles: int) -> Column:
    """Bucket of a row when ``total`` rows fill ``tiles`` buckets, the first ones one row longer."""
    size = F.floor(total / tiles)
    longer = total % tiles
    in_longer = longer * (size + 1)
    return F.when(row <= in_longer, F.ceil(row / (size + 1))).otherwise(
        longer + F.ceil((row - in_longer) / F.nullif(size, F.lit(0)))
    )
