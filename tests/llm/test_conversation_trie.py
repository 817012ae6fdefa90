"""Nodes of the trie against a plain one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from starloom.llm import conversation_trie
from starloom.llm.conversation_trie import Trie

SCHEMA = "conv_id long, turn long, role string, text string"


def remainder(a, b):
    return a - b * int(a / b)


def rebuilt(rows):
    """{conv_id: turns}; rows are (conv_id, turn, role, text) without ties between different turns."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - remainder(c, 100), [])[:h] + turns[h:]
    return out


def plain_nodes(conversations):
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    below = {}
    for p in sorted(members, key=len, reverse=True):
        leaves = 0 if p in children else 1
        saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for q in children.get(p, []):
            leaves, saved = leaves + below[q][0], saved + below[q][1]
        below[p] = leaves, saved
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    key = lambda r: (r[1], r[0])
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *below[p], sha(ends.get(p, []))) for p, m in members.items()), key=key)


def check(spark, rows):
    got = conversation_trie.nodes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    found = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[1], r[0]))
    assert found == plain_nodes(rebuilt(rows))
    return found


def test_shared_beginnings_of_all_kinds(spark):
    """Deep shared prefixes, strings that end inside others, copies, ids below zero and around hundreds."""
    r = random.Random(7)
    spine = [("user" if i % 2 else "assistant", f"turn {i}" * (i % 3)) for i in range(40)]
    rows = []
    for c in [*range(-120, 260), *range(10**15, 10**15 + 30)]:
        turns = spine[: r.randrange(0, 30)] + [("user", r.choice("abc")) for _ in range(r.randrange(0, 4))] or [("user", "")]
        rows += [(c, i if i else None, role, text) for i, (role, text) in enumerate(turns)]
    assert len(check(spark, rows)) > 300


def test_odd_turns(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 5, "", "x"), (2, -3, None, "🙂é"), (None, 1, "user", "nobody"), (3, 1, "us", "erx"), (4, 1, "user", "x")]
    rows += [(100 + i, 0, "user", "same") for i in range(30)] + [(7, i, "user", "y" * 100_000) for i in range(8)]
    check(spark, rows)


def test_one_conversation_holds_a_third_of_all_rows(spark, monkeypatch):
    """Long conversations in blocks, equal turns in runs, and lists of ids in many blocks."""
    monkeypatch.setattr(conversation_trie, "BLOCK", 16)
    monkeypatch.setattr(conversation_trie, "RUN", 5)
    monkeypatch.setattr(conversation_trie, "IDS", 2)
    rows = [(500, i, "user", f"t{i % 7}") for i in range(300)] + [(600 + k, i, "user", f"t{i % 7}") for k in range(3) for i in range(100 + k)]
    rows += [(5000, i // 40, "user", "again") for i in range(90)] + [(1000 + k, 0, "system", "x") for k in range(60)]
    check(spark, rows)


def test_a_hot_conversation_is_cut(spark, monkeypatch):
    from starloom.operators import skew

    monkeypatch.setattr(skew.split_points, "__defaults__", (20,))
    rows = [(500, i // 3, "user", f"t{i // 3}") for i in range(300)] + [(k, i, "user", f"t{i}") for k in range(30) for i in range(8)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(3, 1, "user", "x")]])
def test_empty_tables_and_turnless_conversations(spark, rows):
    assert len(check(spark, rows)) == len(plain_nodes(rebuilt(rows) if rows and rows[0][0] is not None else {}))


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "x"), (2, 0, "user", "x")], SCHEMA)
    names = ("depth", "sid", "x", "y", "n", "e", "rep", "hash", "before")
    assert sorted(map(tuple, conversation_trie.nodes(df.select("*", *[F.lit("z").alias(n) for n in names])).collect()), key=str) == sorted(map(tuple, conversation_trie.nodes(df).collect()), key=str)


def test_fattest_numbers(spark):
    df = spark.range(0, 40).selectExpr("id AS a").join(spark.range(0, 41).selectExpr("id AS b"), F.lit(True))
    for r in df.withColumn("f", conversation_trie.fattest("a", "b")).collect():
        want = max(range(r["a"] + 1, r["b"] + 1), key=lambda x: x & -x, default=None)
        assert r["f"] == want


def test_batches_follow_the_logarithm(spark, monkeypatch):
    """600 strings through one turn, as a chain of prefixes and as branches of a spine."""
    spine = [("user", str(i)) for i in range(30)]
    rows = [(k * 100, i, *t) for k in range(150) for i, t in enumerate(spine[: k % 29 + 1] + [("assistant", str(k))])]
    batches = []
    located = Trie.located
    monkeypatch.setattr(Trie, "located", lambda self, *a: batches.append(1) or located(self, *a))
    check(spark, rows)
    assert len(batches) <= 12
