import collections
import itertools
import random
import time

import pandas as pd
import pytest
from brute import WORD, components
from pyspark.sql import functions as F

from starloom.llm import components as cc
from starloom.llm import common, mixing, near_dup, queries

SF = "/root/testdata/sf0.001"


def check_groups(docs, width, percent):
    """Equal to all pairs by brute force."""
    got = near_dup.groups(docs, width, percent).collect()
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    found, sizes = components([r["text"] for r in rows], width, percent)
    lowest = {}
    for r, c in zip(rows, found, strict=True):
        ids = [x for x in (lowest.get(c), r["doc_id"]) if x is not None]
        lowest[c] = min(ids) if ids else None
    want = sorted(((r["doc_id"], n, lowest[c] if n else r["doc_id"]) for r, c, n in zip(rows, found, sizes, strict=True)), key=str)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def near_copies(n, words, edits, seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(r.randrange(edits)):
            text[r.randrange(words)] = f"v{r.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_odd_rows(odd, width):
    check_groups(odd, width, 80)


def test_documents(documents):
    check_groups(documents, 2, 80)


def test_long_lists_large_clusters_and_truncated_sketches(spark, monkeypatch):
    """Groups around the limit, with blocks small enough for both turns, and sets above both sketch sizes."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    texts = near_copies(90, 120, 22, 1) + near_copies(40, 600, 90, 2) + near_copies(30, 12, 3, 3) + near_copies(25, 6, 3, 4)
    docs = spark.createDataFrame([(i * 7 % 1009, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    check_groups(docs, 2, 80)


def test_empty_table_and_kept_columns(documents, odd):
    assert near_dup.groups(documents.limit(0)).count() == 0
    assert near_dup.deduplicated(documents.limit(0)).count() == 0
    out = near_dup.deduplicated(odd)
    assert out.columns == odd.columns
    assert out.filter("doc_id = 3 AND text = 'one'").count() == 3


def test_a_copy_takes_no_other_text_of_its_id_along(spark):
    copy, near, one, two, three = "a b c d e f g", "A b c  d e f g", "unique text beside a copy here", "another unique text of a null id", "third text that nobody else has"
    rows = [(1, copy), (None, copy), (None, near), (None, one), (None, two), (None, None), (5, copy), (5, three), (5, three), (5, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("x")).repartition(3)
    left = sorted(((r["doc_id"], r["text"]) for r in near_dup.deduplicated(docs).collect()), key=str)
    assert left == sorted([(1, copy), (None, one), (None, two), (None, None), (5, three), (5, three), (5, None), (7, "")], key=str)


def test_candidates_of_short_lists(spark):
    """All pairs of three shared lists hang together, without a row for each pair of lists with the same members."""
    rng = random.Random(5)
    same = [(v, range(100, 116)) for v in range(3)]
    mixed = [(10 + v, rng.sample(range(40), rng.randint(2, 6))) for v in range(60)]
    mixed += [(100 + i, m) for i, (_, m) in enumerate(mixed[:20])] + [(200 + i, m) for i, (_, m) in enumerate(mixed[:10])]
    lists = same + mixed

    def edges(chosen):
        rows = [(v, len(m), n) for v, m in chosen for n in m]
        return near_dup._candidates(spark.createDataFrame(rows, "value long, rows long, node long"), 80)

    assert edges(same).count() == 15
    shared = collections.Counter(p for _, m in lists for p in itertools.combinations(sorted(m), 2))
    want = cc.components(spark.createDataFrame([p for p, n in shared.items() if n >= 3], "a long, b long"))
    got = cc.components(edges(lists))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lists_make_no_pairs_of_sizes_too_far_apart(spark):
    """Nodes that share enough lists are tied where their sizes allow it, and only there; handles tell the sizes."""
    sizes = [*range(1, 200), 1000, 1249, 1250, 10**6, 10**7]
    named = spark.createDataFrame([(n, str(n).encode()) for n in sizes], "n_shingles long, node binary")
    handle = {r["n_shingles"]: r["handle"] for r in named.select("n_shingles", near_dup._handle(80).alias("handle")).collect()}
    lists = [(v, [handle[80], handle[100], handle[1000], handle[1 + v]]) for v in range(4)]
    rows = [(v, len(m), n) for v, m in lists for n in m]
    got = near_dup._candidates(spark.createDataFrame(rows, "value long, rows long, node long"), 80, sized=True)
    assert {frozenset(r) for r in got.collect()} == {frozenset((handle[80], handle[100]))}
    similar = [p for p in itertools.combinations(sizes, 2) if 100 * p[0] >= 80 * p[1]]
    # Other members of a pair's lists keep these from being lists of the same members.
    rows = [(10 * i + v, 3, n) for i, (x, y) in enumerate(similar) for v in range(3) for n in (handle[x], handle[y], -4096 * (10 * i + v + 1))]
    got = near_dup._candidates(spark.createDataFrame(rows, "value long, rows long, node long"), 80, sized=True)
    assert {frozenset(r) for r in got.collect()} == {frozenset((handle[x], handle[y])) for x, y in similar}
    assert all(c == 0 for (c,) in named.select(near_dup._handle(100).bitwiseAND((1 << near_dup.SIZE_BITS) - 1)).collect())


def test_edges_below_a_piece_take_one_turn(spark, monkeypatch):
    """A long path dealt over many partitions is done in one more table, not in turns that each run over all of them."""
    made = []
    monkeypatch.setattr(cc, "written", lambda df, name, f=cc.written: made.append(name) or f(df, name))
    path = spark.createDataFrame([(i * 7919 % 3001, (i + 1) * 7919 % 3001) for i in range(3000)], "a long, b long").repartition(16)
    assert {(r["node"], r["component"]) for r in cc.components(path).collect()} == {(i, 0) for i in range(3001)}
    assert len(made) == 2


def test_components_by_stars(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    rows = cc.components(spark.createDataFrame(path, "a long, b long")).collect()
    want = {i: 0 for i in range(61)} | {i: 100 for i in (100, 101, 102)} | {200 + i: 200 for i in range(50)}
    assert {r["node"]: r["component"] for r in rows} == want and len(rows) == len(want)
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_targets_by_weight_and_cap():
    assert mixing.targets([100, 100, 100], [3, 1, 2], 450, 2) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.targets([10, 1000, 0], [3, 1, 2], 1515, 2) == pytest.approx([20, 1495, 0])
    assert sum(mixing.targets([5, 6, 7], [3, 1, 2], 36, 2)) == pytest.approx(36)


def test_draws_keep_totals_and_are_the_same_from_any_task():
    counts = [900, 40, 0, 60]
    whole = list(mixing.draws(counts, 10, 100, 3, range(10)))
    assert [sum(h[i] for _, h, _ in whole) for i in range(4)] == counts
    assert all(h.sum() == 100 for _, h, _ in whole)
    assert len({tuple(h) for _, h, _ in whole}) > 1
    for k in range(10):
        ((shard, have, before),) = mixing.draws(counts, 10, 100, 3, range(k, k + 1))
        assert shard == k and list(have) == list(whole[k][1]) and list(before) == list(whole[k][2])
    big = list(mixing.draws([10**11, 3 * 10**11], 4, 10**11, 1, range(4)))
    assert [sum(int(h[i]) for _, h, _ in big) for i in range(2)] == [10**11, 3 * 10**11]


def test_permutations_are_permutations():
    import numpy as np

    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(n), n, (1, 2))) == list(range(n))
    assert list(mixing.permuted(np.arange(1000), 1000, (1, 2))) != list(mixing.permuted(np.arange(1000), 1000, (1, 3)))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mix_meets_targets(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = queries.QUERIES["op1_mixing"](spark, path).toPandas()
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "source", "text").toPandas()
    assert len(rows) == len(docs)
    both = rows.merge(docs, on="doc_id")
    assert (both["size"] == both["text"].map(lambda t: len(WORD.findall(t or "")))).all()
    assert (both["taken"] <= 2 * both["size"]).all()
    sizes = both.groupby("source", dropna=False)["size"].sum().sort_index()
    want = mixing.targets(list(sizes), [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5 * sizes.sum(), 2)
    for (source, group), target in zip(both.groupby("source", dropna=False), want, strict=True):
        assert group["source_size"].unique().tolist() == [sizes[source]]
        assert group["target"].iloc[0] == pytest.approx(target)
        assert abs(group["taken"].sum() - target) <= 2 * mixing.BLOCK_WORDS, source
    again = queries.QUERIES["op1_mixing"](spark, path).toPandas()
    pd.testing.assert_frame_equal(rows.sort_values("doc_id", ignore_index=True), again.sort_values("doc_id", ignore_index=True))


def test_mixed_texts_are_the_words_taken(odd, documents):
    for docs in (odd, documents):
        mix = mixing.mixed(docs)
        taken = mixing.words_taken(mix)
        assert taken.count() == docs.count()
        out = mixing.texts(mix)
        assert out.columns == docs.columns
        words = out.select(F.sum(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))).first()[0]
        assert words == taken.agg(F.sum("taken")).first()[0]
        slots = mix.slots.groupBy("shard").count().collect()
        assert all(r["count"] <= mixing.SHARD_SLOTS for r in slots)
        assert mix.slots.groupBy("shard", "slot").count().filter("count > 1").count() == 0
        assert mix.slots.groupBy("place", "pass", "block").count().filter("count > 1").count() == 0
    assert mixing.texts(mixing.mixed(documents.limit(0))).count() == 0


def test_shards_hold_the_words_taken(spark, tmp_path):
    """Every word names its document: what stands in the written shards is recounted in plain code."""
    sizes = {i: (i * 37) % 300 for i in range(300)} | {300: 9000}
    rows = [(i, " ".join(f"d{i}_{k}" for k in range(n)), ["a", "b", None][i % 3] if i != 300 else "a") for i, n in sizes.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mix = mixing.mixed(docs)
    mixing.write_shards(mix, str(tmp_path / "shards"))
    out = spark.read.parquet(str(tmp_path / "shards")).collect()
    lines = mix.lines
    counts, n_shards = [s.slots for s in lines], max(1, -(-sum(s.slots for s in lines) // mixing.SHARD_SLOTS))
    have = {shard: list(h) for shard, h, _ in mixing.draws(counts, n_shards, mixing.SHARD_SLOTS, 11, range(n_shards))}
    for shard in have:
        held = [r for r in out if r["shard"] == shard]
        assert [sum(r["place"] == i for r in held) for i in range(len(lines))] == have[shard]
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    seen, in_shards = {}, {}
    for r in out:
        words = r["text"].split()
        assert 0 < len(words) <= mixing.BLOCK_WORDS
        for w in words:
            d = int(w[1:].split("_")[0])
            assert (sizes[d] and rows[d][2]) == lines[r["place"]].name or rows[d][2] is None
            seen[d] = seen.get(d, 0) + 1
            in_shards.setdefault(d, set()).add(r["shard"])
        # words of a document stand in their order, without gaps
        for a, b in zip(words, words[1:]):
            (da, ka), (db, kb) = a[1:].split("_"), b[1:].split("_")
            assert (da == db and int(kb) == int(ka) + 1) or (da != db and int(ka) == sizes[int(da)] - 1 and kb == "0")
    taken = {r["id"]: r for r in mixing.words_taken(mix).collect()}
    assert set(taken) == set(sizes)
    for d, n in sizes.items():
        assert taken[d]["taken"] == seen.get(d, 0) <= 2 * n and taken[d]["n_shards"] == len(in_shards.get(d, ()))
    in_order = sorted({(r["place"], r["block"]) for r in out})
    for place, line in enumerate(lines):
        assert [b for p, b in in_order if p == place] == list(range(line.blocks)) or line.target < line.size


def test_repeated_rows_are_mixed_each_on_its_own(spark):
    """A third of the rows equal, a third without id and text: none lost, none gathered, bounded by their own blocks."""
    text = " ".join(f"w{k}" for k in range(200))
    rows = spark.range(0, 60000, numPartitions=6).select(
        F.expr("CASE id % 3 WHEN 0 THEN 7L WHEN 1 THEN NULL ELSE id END").alias("doc_id"),
        F.expr(f"CASE id % 3 WHEN 0 THEN '{text}' WHEN 1 THEN NULL ELSE concat('some words of ', id) END").alias("text"),
        F.expr("CASE WHEN id % 3 = 2 AND id % 2 = 0 THEN 'b' ELSE 'a' END").alias("source"),
        F.expr("CASE id % 3 WHEN 0 THEN map('k', 1) END").alias("doc"),
    )
    mix = mixing.mixed(rows)
    taken = mixing.words_taken(mix)
    by = {r["id"]: r for r in taken.filter("id IS NULL OR id = 7").groupBy("id").agg(F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("taken").alias("most")).collect()}
    assert by[7]["n"] == 20000 and by[None]["n"] == 20000 and by[None]["taken"] == 0 and by[7]["most"] <= 400
    assert taken.count() == 60000
    sums = {r["source"]: (r["taken"], r["target"]) for r in taken.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert all(abs(t - want) <= 2 * mixing.BLOCK_WORDS for t, want in sums.values())
    words = mixing.texts(mix, length="none").select(F.sum(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))).first()[0]
    assert words == sum(t for t, _ in sums.values())


def test_large_clusters_are_divided_by_their_sketches(spark, monkeypatch):
    """Groups that one frequent pair of words ties: equal to all pairs with parts of sketches forced small."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "SKETCHES", 20)
    texts = [f"{t} tied here" for seed in range(9) for t in near_copies(14, 80, 14, seed)]
    docs = spark.createDataFrame(list(enumerate([*texts, *texts[:9]])), "doc_id long, text string").repartition(4)
    check_groups(docs, 2, 80)


def test_parts_by_size_leave_out_only_pairs_of_sizes_too_far_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(near_dup, "COMPARED", 3)
    r = np.random.default_rng(2)
    for trial in range(40):
        n = r.integers(1, 30, size=int(r.integers(1, 25)))
        left = np.flatnonzero(r.random(len(n)) < 0.7) if trial % 2 else np.arange(len(n))
        right = np.flatnonzero(r.random(len(n)) < 0.7) if trial % 2 else np.arange(len(n))
        given = {(i, j) for some, others in near_dup._by_size(n, left, right, 80) for i in some for j in others}
        if np.array_equal(left, right):
            given |= {(j, i) for i, j in given}
        assert given >= {(i, j) for i in left.tolist() for j in right.tolist() if 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j])}
        assert all(i in left and j in right for i, j in given)


def test_groups_in_small_parts_by_size(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "SKETCHES", 20)
    monkeypatch.setattr(near_dup, "COMPARED", 4)
    texts = [f"{t} tied here" for seed, length in enumerate((20, 30, 45, 80, 81, 100)) for t in near_copies(14, length, 14, seed)]
    check_groups(spark.createDataFrame(list(enumerate([*texts, *texts[:9]])), "doc_id long, text string").repartition(4), 2, 80)


def test_contraction_in_small_pieces(spark, monkeypatch):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(330)] + [(None, 3), (1000, 1000)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            label[high] = low
    monkeypatch.setattr(cc, "PIECE", 8)
    rows = cc.components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()
    assert {r["node"]: r["component"] for r in rows} == {x: find(x) for x in label} and len(rows) == len(label)


def shuffle_files(spark):
    """Names of the shuffle files that the executors of a local session hold."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_of_written_tables_do_not_wait_for_garbage(spark):
    """Before, all shuffles of the steps lay on disk together until the driver collected its garbage."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(near_copies(60, 40, 8, 5))], "doc_id long, text string").repartition(3)
    sketches = near_dup.sketches(docs, 2)
    before = shuffle_files(spark)
    nodes = common.written(sketches.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "test")
    left = shuffle_files(spark) - before
    for _ in range(100):
        if not left:
            break
        time.sleep(0.1)
        left = shuffle_files(spark) - before
    assert left == set()
    # The rows can be asked for again and again.
    assert nodes.count() == len(nodes.collect()) == nodes.count() > 0


def test_only_texts_asked_for_are_shuffled(spark, monkeypatch):
    """Nearly no others; with few marks more of them, but what is asked for is always there, a null id too."""
    texts = spark.range(4000).selectExpr("if(id = 7, null, id % 3900) AS _id", "unhex(md5(cast(id AS string))) AS _digest", "id")
    wanted = texts.filter("id % 40 = 7").selectExpr("_id AS doc_id", "_digest AS digest")
    asked = {r["id"] for r in texts.filter("id % 40 = 7").collect()}
    found = {r["id"] for r in near_dup._sifted(texts, wanted).collect()}
    assert asked <= found and len(found) < 2 * len(asked) + 400
    monkeypatch.setattr(near_dup, "MARKS", 1)
    assert asked <= {r["id"] for r in near_dup._sifted(texts, wanted).collect()}
    assert near_dup._sifted(texts, wanted.limit(0)).count() == 0


def test_huge_clusters_are_divided_without_copies_of_their_sketches(spark, monkeypatch):
    """One frequent text part ties all; before, each sketch went to as many tasks as the cluster had parts."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "SKETCHES", 20)
    sent = []
    finer = near_dup._finer
    monkeypatch.setattr(near_dup, "_finer", lambda sketched, big, percent: sent.extend(r["members"] for r in big.collect()) or finer(sketched, big, percent))
    texts = [f"{t} tied here" for seed, n in enumerate((8, 60, 60, 90, 300)) for t in near_copies(14, n, 3 + n // 6, seed)]
    docs = spark.createDataFrame([*enumerate([*texts, *texts[:9]]), (None, texts[0]), (400, None)], "doc_id long, text string").repartition(4)
    check_groups(docs, 2, 80)
    assert max(sent, default=0) <= 20


@pytest.mark.parametrize("n", [4, 5, 10, 51, 64, 65, 80, 81, 400])
def test_similar_sets_share_bands(n):
    import numpy as np

    r = np.random.default_rng(n)
    shared = []
    for _ in range(40):
        union = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        part = np.sort(union[: -(-n * 8 // 10)])
        shared.append(len(np.intersect1d(near_dup._bands(part, 80), near_dup._bands(np.sort(union), 80))))
    assert min(shared) > 0 and np.mean(shared) > 16
    few = near_dup._smallest(union, near_dup.ORDERS, 3)
    assert few.tolist() == [sorted(int(v >> np.uint64(32)) * int(a) % 2**32 for v in union)[:3] for a in near_dup.ORDERS]
