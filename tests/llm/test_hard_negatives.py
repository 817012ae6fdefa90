"""Mined negatives against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def all_pairs(rows, positives=5, negatives=5):
    """rows: (vec_id, label, vector of whole numbers), as given, anchors being ids divisible by 100."""
    out = []
    for anchor in {(i, x, v) for i, x, v in rows if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(anchor[2], v, strict=True)), i, x) for i, x, v in rows if i != anchor[0] and len(v) == len(anchor[2]))
        near = [s for s in scored if s[2] == anchor[1]][:positives]
        for score, i, _ in near:
            far = [s for s in scored if s[2] != anchor[1] and 80 * -score <= 100 * -s[0] <= 100 * -score][:negatives]
            out += [(anchor[0], i, n, s[1], -score, -s[0]) for n, s in enumerate(far, 1)]
    return sorted(out)


def check(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = hard_negatives.mined(hard_negatives.whole_numbers(df, 256.0), F.col("vec_id") % 100 == 0, **kwargs)
    whole = [(i, x, tuple(int(np.floor(256 * y)) for y in v)) for i, x, v in rows if i is not None and x is not None and v is not None and all(y is not None and np.isfinite(y) for y in v)]
    want = all_pairs(whole)
    assert sorted(map(tuple, got.collect())) == want
    return want


def cloud(n, dim, seed, spread=0.3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, r.randrange(3), [c + spread * r.gauss(0, 1) for c in centres[r.randrange(6)]]) for i in range(n)]


def test_many_turns_parts_blocks_and_clusters(spark, monkeypatch):
    """Lists cut into many levels and parts, several blocks and clusters, so that later turns only see open members."""
    monkeypatch.setattr(hard_negatives, "PART", 40)
    monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    monkeypatch.setattr(hard_negatives, "CLUSTER_ANCHORS", 5)
    rows = [(i * 20, x, v) for i, x, v in cloud(700, 8, 1)]
    assert len(check(spark, rows)) > 500


def test_odd_rows(spark):
    r = random.Random(3)
    rows = cloud(300, 4, 2)
    rows += [(100, 1, rows[100][2]), (100, 1, rows[100][2]), (100, 2, [0.5, 0.25, 0.0, 1.0]), (200, 0, [0.0] * 4), (7, 0, [0.0] * 4)]
    # Ties, and rows repeated more often than an answer has places.
    rows += [(1000 + i, r.randrange(2), [1.0, 1.0, 0.0, 0.0]) for i in range(60)] + [(300, 1, [1.0, 1.0, 0.0, 0.0])] + [(555, 1, [1.0, 1.0, 0.0, 0.0])] * 9 + [(556, 0, [1.0, 1.0, 0.0, 0.0])] * 9
    rows += [(400, 0, [3.0, 1.0]), (401, 0, [2.0, 1.0]), (402, 1, [2.0, 0.5]), (500, 0, []), (501, 0, [])]
    rows += [(600, None, [1.0] * 4), (None, 1, [1.0] * 4), (700, 1, None), (800, 1, [1.0, None, 0.0, 0.0]), (900, 1, [1.0, float("nan"), 0.0, 0.0]), (901, 1, [float("inf"), 0.0, 0.0, 0.0])]
    assert len(check(spark, rows)) > 50


def test_components_beyond_exact_doubles(spark):
    rows = [(i, i % 2, [float(2**22 - (i * 7919) % 97), float(i)]) for i in range(0, 230, 5)]
    assert check(spark, rows)


def test_a_third_of_all_rows_equal_and_clashing_columns(spark):
    rows = cloud(400, 4, 5) + [(77, 1, [2.0, 2.0, 2.0, 2.0])] * 200
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("query_id", "mark", "copies", "norm", "place"):
        df = df.withColumn(name, F.lit("x"))
    got = hard_negatives.mined(hard_negatives.whole_numbers(df, 256.0), F.col("vec_id") % 100 == 0)
    whole = [(i, x, tuple(int(np.floor(256 * y)) for y in v)) for i, x, v in rows]
    assert sorted(map(tuple, got.collect())) == all_pairs(whole)


def test_scores_too_large_for_their_column_fail(spark):
    rows = [(i, i % 2, [float(2**40 + i)]) for i in range(0, 120, 5)]
    with pytest.raises(Exception, match="64 bits"):
        check(spark, rows)


@pytest.mark.parametrize("keep", ["false", "vec_id % 100 <> 0", "vec_id = 100", "vec_id IN (100, 101)"])
def test_empty_and_tiny_tables(spark, keep):
    df = spark.createDataFrame(cloud(200, 4, 6), SCHEMA).filter(keep)
    assert hard_negatives.mined(hard_negatives.whole_numbers(df, 256.0), F.col("vec_id") % 100 == 0).count() in (0, 1)
