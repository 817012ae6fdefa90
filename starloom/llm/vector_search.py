"""Exact top-k by inner product: a KD-tree per shard, searched best first.

Vectors are dealt into shards of bounded size. Each shard splits at medians into leaves with tight bounding boxes. A
box bounds the score of all its vectors, so a search takes boxes in falling order of bounds and ends where a bound is
below the k-th score. Queries search their own shard first; its k-th score goes with them to all other shards.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF = 128
FOUND = "query long, vec_id long, score long"


class Tree:
    """Median splits on the widest dimension; `low` and `high` are the tight boxes of all nodes, `leaves` their rows."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.low, self.high, self.children, self.leaves = vectors, [], [], [], []
        self._grow(np.arange(len(vectors)))
        self.low, self.high = np.stack(self.low), np.stack(self.high)

    def _grow(self, rows: np.ndarray) -> int:
        node, part = len(self.leaves), self.vectors[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.leaves.append(None)
        if len(rows) <= LEAF or not (low < high).any():
            self.leaves[node] = rows
            return node
        order = np.argsort(part[:, np.argmax(high - low)], kind="stable")
        half = len(rows) // 2
        self.children[node] = (self._grow(rows[order[:half]]), self._grow(rows[order[half:]]))
        return node

    def search(self, query: np.ndarray, ids: np.ndarray, own: int, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) of the tree, ties to the smaller id; none below `least`.

        One row is left out, the query's own: it has the id `own` and the vector of the query.
        """
        mine = [r for r in np.flatnonzero(ids == own) if (self.vectors[r] == query).all()][:1]
        bounds = np.maximum(self.low * query, self.high * query).sum(axis=1)
        heap, best = [(-bounds[0], 0)], []
        while heap:
            bound, node = heapq.heappop(heap)
            kth = best[k - 1][0] if len(best) >= k else least
            if kth is not None and -bound < kth:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.leaves[node]
            scores = self.vectors[rows] @ query
            if kth is not None:
                near = scores >= kth
                rows, scores = rows[near], scores[near]
            best += [(int(s), int(i)) for s, i, r in zip(scores, ids[rows], rows, strict=True) if r not in mine]
            best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
        return best


def _matrix(column: pd.Series, exact_limit: float = 2.0**53) -> np.ndarray:
    """Vectors as doubles where every inner product is exact in them, else as whole numbers of any size."""
    rows = np.stack([np.asarray(v, dtype=np.int64) for v in column]) if len(column) else np.zeros((0, 0), np.int64)
    top = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
    return rows.astype(float) if top * top * max(rows.shape[1], 1) < exact_limit else rows.astype(object)


def _searcher(k: int):
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype("int64")
        both = _matrix(pd.concat([left["vector"], right["vector"]]))
        tree, queries = Tree(both[: len(left)]), both[len(left) :]
        ids, out = left["vec_id"].to_numpy(), []
        for query, number, own, least in zip(queries, right["query"], right["query_id"], right["least"], strict=True):
            bound = None if pd.isna(least) else int(least)
            out += [(number, i, s) for s, i in tree.search(query, ids, own, k, bound)]
        return pd.DataFrame(out, columns=["query", "vec_id", "score"]).astype("int64")

    return search


def scaled(vectors: DataFrame, scale: float = 1024.0, column: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, vector): floor(scale * x) of each component, x as double; rows that can take part only."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.filter(F.col(column).isNotNull() & F.col(vec_id).isNotNull() & ~bad).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector")
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query, its own row left out.

    Both tables are (vec_id, vector) as from `scaled`. Ties go to the smaller vec_id. A query meets vectors of its own
    length only. Null vectors and ids take no part; repeated vec_ids are answers each; fewer candidates than k are all
    given; empty tables give no rows. A query's own row is one row with its id and vector: other rows with that id are
    candidates, and a query asked twice is answered twice. Every query sees every shard: queries go in blocks, and what
    is shuffled is a block of queries per shard and a shard per block.
    """
    base = written(vectors.select("vec_id", "vector", F.size("vector").alias("dim")), "vectors")
    distinct = queries.groupBy(F.col("vec_id").alias("query_id"), "vector").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    asked = written(distinct.select("*", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("query")), "queries")
    shards, blocks = max(1, math.ceil(base.count() / SHARD_ROWS)), max(1, math.ceil(asked.count() / QUERY_ROWS))
    home, search = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"), _searcher(k)
    dealt = base.withColumn("shard", home)
    query_home = F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit("block"), "query_id"), F.lit(blocks)).cast("int")
    placed = asked.withColumn("home", query_home).withColumn("block", block)
    keys, sent = ["dim", "shard"], ["query", "query_id", "vector"]
    own = placed.select("dim", F.col("home").alias("shard"), *sent, F.lit(None).cast("long").alias("least"))
    first = written(dealt.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInPandas(search, FOUND), "first")
    known = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("low")).filter(F.col("n") >= k).select("query", F.col("low").alias("least"))
    away = placed.join(known, "query", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard <> home")
    every = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    rest = every.groupBy(*keys).cogroup(away.select(*keys, *sent, "least").groupBy(*keys)).applyInPandas(search, FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = first.union(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    answers = ranked.join(asked.select("query", "query_id", "copies"), "query").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
