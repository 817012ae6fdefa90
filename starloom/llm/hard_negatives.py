"""Hard negatives by inner product: anchor clusters share lists of candidates sorted by an angular upper bound.

Anchors are clustered by direction. For a cluster with centre c and widest member angle r, no member u scores a row v
above |u| |v| cos(max(0, angle(v, c) - r)). So |v| cos(...) orders one list of candidates that all members share: each
walks it from the top and stops where |u| times the bound of the next row is below the least score that could still
enter its answer. That proves the answer complete.

A list is cut into levels of falling bound, a level into parts of bounded size, the members of a cluster into blocks. A
turn walks a range of levels, each (block, level, part) in a task of its own, for those members only whose answer is not
yet proven. Ranges grow turn by turn, and what a turn finds tightens the limits of the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import give_back, written

CLUSTERS = 64  # at most; a list is a copy of the rows, so this bounds the copies
CLUSTER_ANCHORS = 512  # fewer clusters where they would hold fewer anchors than this
SAMPLE = 4096  # anchors that the centres are learnt from, the first by hash
PART = 8192  # rows of a part of a level
BLOCK = 2048  # members of a cluster that walk together
LEVELS = 1024  # steps of the bound, at most as many levels
STEP = 512  # rows of a list scored at once
NONE = -(2**63)

MEMBER = "query_id long, mark long, label int, vector array<long>, norm double, cluster int, upper array<long>, lower array<long>"
KEYS = ["cluster", "level", "part", "block"]
FOUND = "query_id long, mark long, upper long, vec_id long, other long, score long, copies long"


def whole_numbers(vectors: DataFrame, scale: float, vec_id: str = "vec_id", label: str = "label", column: str = "embedding") -> DataFrame:
    """(vec_id, label, vector): floor(scale * x) of each component, x as double; rows that can take part only."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    ids, marks = F.col(vec_id).cast("long"), F.col(label).cast("int")
    usable = ids.isNotNull() & marks.isNotNull() & F.col(column).isNotNull() & ~bad
    return vectors.filter(usable).select(ids.alias("vec_id"), marks.alias("label"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of whole numbers."""
    flat = [c.flatten() for c in column.chunks]
    return np.concatenate([np.asarray(f, dtype=np.int64) for f in flat] or [np.zeros(0, np.int64)]).reshape(len(column), dim)


def _exact(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where their inner products are exact in them, else as whole numbers of any size."""
    top = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (left, right)]
    kind = float if top[0] * top[1] * max(left.shape[1], 1) < 2**53 else object
    return left.astype(kind), right.astype(kind)


@dataclass(frozen=True)
class Lists:
    """Centres and widest angles of the clusters, and how the shared lists are cut."""

    dim: int
    centres: np.ndarray
    radius: np.ndarray
    top: float  # the largest norm of a row
    level: np.ndarray | None = None  # [cluster, step of the bound] -> level
    tops: np.ndarray | None = None  # [cluster, level] -> upper end of its bounds
    parts: np.ndarray | None = None  # [cluster, level] -> parts

    def angles(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Of every row to every centre; 0 for rows of length 0."""
        cosine = (vectors.astype(float) @ self.centres.T) / np.where(norms > 0, norms, 1)[:, None]
        return np.where(norms[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0)

    def bounds(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bound of u.v / |u| over the members u, for every row and cluster, with room for rounding."""
        away = np.maximum(0, self.angles(vectors, norms) - self.radius - 1e-6)
        return norms[:, None] * np.cos(away) + 1e-9 * (1 + norms[:, None])

    def steps(self, bounds: np.ndarray) -> np.ndarray:
        """Steps of the bound, 0 for the highest."""
        share = (1 - bounds / max(self.top, 1e-300)) / 2
        return np.clip((share * LEVELS).astype(np.int64), 0, LEVELS - 1)


def _learnt(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Unit centres: k-means by direction from the first rows, eight turns."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0][:, None]
    centres = unit[:clusters].copy()
    for _ in range(8):
        nearest = np.argmax(unit @ centres.T, axis=1) if len(centres) else np.zeros(0, int)
        for c in range(len(centres)):
            mean = unit[nearest == c].sum(axis=0)
            if (length := np.linalg.norm(mean)) > 0:
                centres[c] = mean / length
    return centres if len(centres) else np.zeros((1, sample.shape[1]))


def _batches(function):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for table in function(pa.Table.from_batches([batch])):
                    yield from table.to_batches()
        give_back()

    return run


def _assigned(anchors: DataFrame, lists: Lists) -> DataFrame:
    """Add each anchor's cluster and its angle to the centre."""

    def assign(rows: pa.Table) -> Iterator[pa.Table]:
        angles = lists.angles(_vectors(rows["vector"], lists.dim), rows["norm"].to_numpy())
        nearest = angles.argmin(axis=1)
        yield rows.append_column("cluster", pa.array(nearest.astype(np.int32))).append_column("angle", pa.array(angles[np.arange(len(nearest)), nearest]))

    return anchors.mapInArrow(_batches(assign), "query_id long, mark long, label int, vector array<long>, norm double, cluster int, angle double")


def _cut(base: DataFrame, lists: Lists) -> Lists:
    """Levels of at least half a part, from the counts of rows by (cluster, step), which are bounded by parameters."""

    def count(rows: pa.Table) -> Iterator[pa.Table]:
        steps = lists.steps(lists.bounds(_vectors(rows["vector"], lists.dim), rows["norm"].to_numpy()))
        key, n = np.unique(steps + np.arange(steps.shape[1]) * LEVELS, return_counts=True)
        yield pa.table({"key": key, "n": n.astype(np.int64)})

    counted = base.select("vector", "norm").mapInArrow(_batches(count), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    rows = np.zeros((len(lists.centres), LEVELS), np.int64)
    for r in counted:
        rows[divmod(r["key"], LEVELS)] = r["n"]
    level, tops, parts = np.zeros_like(rows), np.full(rows.shape, -np.inf), np.ones_like(rows)
    for c in range(len(rows)):
        now, held = 0, 0
        for step in range(LEVELS):
            # A level ends before a step that would make it larger than a part, and after one that fills half of it.
            if held and (held + rows[c, step] > PART or held >= PART // 2):
                now, held = now + 1, 0
            if not held:
                tops[c, now] = lists.top * (1 - 2 * step / LEVELS) + 1e-6 * (1 + lists.top)
            level[c, step], held = now, held + rows[c, step]
            parts[c, now] = max(1, math.ceil(held / PART))
    return Lists(lists.dim, lists.centres, lists.radius, lists.top, level, tops, parts)


def _dealt(base: DataFrame, lists: Lists, blocks: np.ndarray, first: int, last: np.ndarray) -> DataFrame:
    """Rows of the walked levels of every list, a copy for each block of the cluster."""

    def deal(rows: pa.Table) -> Iterator[pa.Table]:
        norms, hashes = rows["norm"].to_numpy(), rows["other"].to_numpy()
        bounds = lists.bounds(_vectors(rows["vector"], lists.dim), norms)
        levels = np.take_along_axis(lists.level, lists.steps(bounds).T, axis=1).T
        for c in np.nonzero(blocks)[0]:
            at = np.nonzero((levels[:, c] >= first) & (levels[:, c] <= last[c]))[0]
            level, copy = levels[at, c], rows.take(pa.array(at))
            for block in range(blocks[c]):
                out = copy
                for name, x in zip(KEYS, (np.full(len(at), c), level, hashes[at] % lists.parts[c, level], np.full(len(at), block)), strict=True):
                    out = out.append_column(name, pa.array(x.astype(np.int32)))
                yield out.append_column("bound", pa.array(bounds[at, c]))

    schema = "vec_id long, label int, vector array<long>, norm double, other long, copies long, cluster int, level int, part int, block int, bound double"
    return base.mapInArrow(_batches(deal), schema)


def _placed(members: DataFrame, lists: Lists, blocks: np.ndarray, first: int, last: np.ndarray) -> DataFrame:
    """Members once for every part of the levels they may have to walk."""

    def place(rows: pa.Table) -> Iterator[pa.Table]:
        cluster, norms, marks = rows["cluster"].to_numpy(), rows["norm"].to_numpy(), rows["mark"].to_numpy()
        need = np.array([min(x) if x else np.inf for x in rows["lower"].to_pylist()], float)
        for i, c in enumerate(cluster):
            reached = [x for x in range(first, last[c] + 1) if _may_reach(norms[i], lists.tops[c, x], need[i])]
            level = np.repeat(reached, lists.parts[c, reached]).astype(np.int32)
            part = np.concatenate([np.arange(n) for n in lists.parts[c, reached]] or [level]).astype(np.int32)
            out = rows.take(pa.array(np.full(len(level), i)))
            for name, x in (("level", level), ("part", part), ("block", np.full(len(level), marks[i] % blocks[c], np.int32))):
                out = out.append_column(name, pa.array(x))
            yield out

    return members.mapInArrow(_batches(place), MEMBER + ", level int, part int, block int")


def _may_reach(norms, bound, need):
    return (norms * bound) * (1 + 1e-9) + 1e-6 >= need


def _walker(dim: int, same: bool, k: int):
    """Every member of a block walks a part of the shared list; FOUND rows, at most k of each answer."""

    def walk(members: pa.Table, listed: pa.Table) -> pa.Table:
        names = FOUND.replace(" long", "").split(", ")
        if not (members.num_rows and listed.num_rows):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        ours, theirs = _exact(_vectors(members["vector"], dim), _vectors(listed["vector"], dim))
        norms, bound = members["norm"].to_numpy(), listed["bound"].to_numpy()
        ids, labels = members["query_id"].to_numpy(), members["label"].to_numpy()
        other_ids, other_labels, others = (listed[n].to_numpy() for n in ("vec_id", "label", "other"))
        uppers, lowers = members["upper"].to_pylist(), members["lower"].to_pylist()
        width = max(map(len, uppers))
        # An answer that is not there has limits that nothing meets.
        upper = np.array([u + [NONE] * (width - len(u)) for u in uppers], np.int64).reshape(len(uppers), width)
        lower = np.array([x + [2**62] * (width - len(x)) for x in lowers], np.int64).reshape(len(lowers), width)
        order = np.argsort(-bound, kind="stable")
        best = [np.zeros(0, np.int64) for _ in range(3)]  # answer, score, row
        for start in range(0, len(order), STEP):
            rows = order[start : start + STEP]
            awake = np.nonzero(_may_reach(norms, bound[rows[0]], lower.min(axis=1).astype(float)))[0]
            if not len(awake):
                break
            scores = ours[awake] @ theirs[rows].T
            if scores.dtype == object and np.abs(scores).max() >= 2**62:
                raise OverflowError("an inner product does not fit 64 bits")
            fits = (labels[awake][:, None] == other_labels[rows]) == same
            fits &= ids[awake][:, None] != other_ids[rows]
            new = [best]
            for j in range(width):
                inside = fits & (scores >= lower[awake, j][:, None]) & (scores <= upper[awake, j][:, None])
                at, row = np.nonzero(inside)
                new.append([awake[at] * width + j, scores[at, row].astype(np.int64), rows[row]])
            answer, score, row = (np.concatenate([x[i] for x in new]) for i in range(3))
            if not len(answer):
                continue
            sort = np.lexsort((others[row], other_ids[row], -score, answer))
            answer, score, row = answer[sort], score[sort], row[sort]
            begins = np.r_[True, answer[1:] != answer[:-1]]
            rank = np.arange(len(answer)) - np.maximum.accumulate(np.where(begins, np.arange(len(answer)), 0))
            best = [x[rank < k] for x in (answer, score, row)]
            full = rank == k - 1
            limits = lower.reshape(-1)
            limits[answer[full]] = np.maximum(limits[answer[full]], score[full])
        answer, score, row = best
        columns = [ids[answer // width], members["mark"].to_numpy()[answer // width], upper.reshape(-1)[answer], other_ids[row], others[row], score, listed["copies"].to_numpy()[row]]
        return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns, strict=True)})

    return walk


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k first rows of each answer: highest score, then smallest vec_id."""
    order = Window.partitionBy("query_id", "mark", "upper").orderBy(F.desc("score"), "vec_id", "other")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _searched(members: DataFrame, base: DataFrame, lists: Lists, same: bool, k: int) -> DataFrame:
    """FOUND rows, k of each answer of each member: rows of the same or of other labels with lower <= score <= upper.

    Turns walk level 0, then eight times as many levels each; a member drops out where no further level can add to it.
    """
    first, width, found, walk = 0, 1, None, _walker(lists.dim, same, k)
    levels = lists.level.max(axis=1)
    state = members
    while first <= levels.max():
        reach = F.array(*[F.array(*map(F.lit, t)) for t in lists.tops[:, first : first + 1].tolist()]) if first else None
        active = state
        if first:
            top = F.element_at(F.element_at(reach, F.col("cluster") + 1), 1)
            need = F.array_min("lower").cast("double")
            active = state.filter((F.size("lower") > 0) & (F.col("norm") * top * (1 + 1e-9) + 1e-6 >= need))
        left = {r["cluster"]: r["n"] for r in active.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
        if not left:
            break
        blocks = np.array([math.ceil(left.get(c, 0) / BLOCK) for c in range(len(levels))])
        last = np.minimum(levels, first + width - 1)
        ours = _placed(active.select(*[c.split()[0] for c in MEMBER.split(", ")]), lists, blocks, first, last)
        theirs = _dealt(base, lists, blocks, first, last)
        turn = written(ours.groupBy(*KEYS).cogroup(theirs.groupBy(*KEYS)).applyInArrow(walk, FOUND), "walked")
        found = turn if found is None else written(_best(found.union(turn), k).drop("place"), "found")
        # Limits rise to the k-th score of an answer that is full.
        full = _best(found, k).filter(F.col("place") == k).groupBy("query_id", "mark").agg(F.map_from_entries(F.collect_list(F.struct("upper", "score"))).alias("kth"))
        raised = F.transform(F.arrays_zip("upper", "lower"), lambda x: F.greatest(x["lower"], F.coalesce(F.element_at("kth", x["upper"]), x["lower"])))
        state = written(members.join(full, ["query_id", "mark"], "left").withColumn("lower", F.when(F.col("kth").isNull(), F.col("lower")).otherwise(raised)).drop("kth"), "members")
        first, width = first + width, width * 8
    return _best(found, k) if found is not None else members.sparkSession.createDataFrame([], FOUND + ", place int")


def _mined(base: DataFrame, anchors: DataFrame, dim: int, positives: int, negatives: int, percent: int) -> DataFrame:
    """`mined` for vectors of one length."""
    members = anchors.select(F.col("vec_id").alias("query_id"), F.col("other").alias("mark"), "label", "vector", "norm")
    sample = members.orderBy(F.xxhash64("query_id", "mark"), "query_id", "mark").limit(SAMPLE).select("vector").collect()
    clusters = max(1, min(CLUSTERS, members.count() // CLUSTER_ANCHORS))
    centres = _learnt(np.array([r["vector"] for r in sample], float).reshape(len(sample), dim), clusters)
    top = base.agg(F.max("norm")).first()[0]
    lists = Lists(dim, centres, np.zeros(len(centres)), top)
    members = written(_assigned(members, lists), "anchors")
    radius = np.zeros(len(centres))
    for r in members.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        radius[r["cluster"]] = r["angle"]
    lists = _cut(base, Lists(dim, centres, radius, top))
    all_scores = F.array(F.lit(2**63 - 1)), F.array(F.lit(NONE).cast("long"))
    asked = members.drop("angle").withColumns({"upper": all_scores[0], "lower": all_scores[1]})
    near = _searched(asked, base, lists, True, positives)
    copy = Window.partitionBy("query_id", "mark").orderBy("place", "copy")
    copies = near.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(positives)))))
    near = written(copies.withColumn("nth", F.row_number().over(copy)).filter(F.col("nth") <= positives).select("query_id", "mark", "nth", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Only the score of a positive matters for its negatives; below zero nothing lies between its limits.
    limits = near.filter("positive_score >= 0").groupBy("query_id", "mark").agg(F.array_sort(F.collect_set("positive_score")).alias("upper"))
    least = F.expr(f"transform(upper, p -> cast(ceil(cast(p AS DECIMAL(20, 0)) * {percent} / 100) AS BIGINT))")
    wanted = written(members.drop("angle").join(limits, ["query_id", "mark"]).withColumn("lower", least), "wanted")
    far = _searched(wanted, base, lists, False, negatives)
    copies = far.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(negatives)))))
    order = Window.partitionBy("query_id", "mark", "upper").orderBy("place", "copy")
    far = copies.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    far = far.select("query_id", "mark", F.col("upper").alias("positive_score"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(far, ["query_id", "mark", "positive_score"]).select(F.col("query_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that `anchor` picks.

    `vectors` is (vec_id, label, vector) as from `whole_numbers`; scores are inner products, higher ones first, ties by
    smaller vec_id. An anchor's positives are its first rows of the same label; a positive's negatives the first rows of
    other labels with percent * positive score <= 100 * score <= 100 * positive score. Rows with the anchor's own vec_id
    are never its answers. Equal rows are folded into one with its number of copies, each an answer of its own; equal
    anchors are asked once, anchors that share a vec_id and differ otherwise each. Vectors of different lengths never
    meet and are mined apart, one run for each length that anchors have. Empty tables give no rows. Scores beyond 62
    bits fail the job.
    """
    spark = vectors.sparkSession
    folded = vectors.groupBy("vec_id", "label", "vector").agg(F.count("*").alias("copies"))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    # Not negative, so that remainders by it are places.
    other = F.xxhash64("vec_id", "label", "vector").bitwiseAND(2**62 - 1)
    base = written(folded.select("vec_id", "label", "vector", F.sqrt(squares).alias("norm"), other.alias("other"), "copies"), "vectors")
    anchors = base.filter(anchor)
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for r in anchors.select(F.size("vector").alias("dim")).distinct().orderBy("dim").collect():
        one = base.filter(F.size("vector") == r["dim"])
        out = out.union(_mined(one, one.filter(anchor), r["dim"], positives, negatives, percent))
    return out
