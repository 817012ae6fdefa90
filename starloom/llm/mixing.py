"""Mixing sources to target weights by fixed-length blocks.

The words of a source stand in one stream, bucket of documents after bucket, cut into blocks of fixed length that run
over the borders of documents and buckets; only the last block of a source is short. Each output shard has a fixed
number of slots; how many of them each source gets is a multinomial draw, conditioned on the totals of the mix, so that
every source comes out at its target. The draw halves the shards again and again, and every halving has a seed of its
own: any task can compute its shards alone. The n-th slot of a source takes the n-th place of a pseudorandom permutation
of its blocks, a new one for each pass. Blocks meet their slots by index, and `shards` gives the words that stand in
each slot.

Equal rows are counted before they are placed, stand one behind the other in their stream and are told apart by a number
alone. Numbers are dealt in batches, so that a row repeated without end is spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import text_or_empty, words, written

BLOCK_WORDS = 128
SHARD_SLOTS = 4096
# Distinct documents of a bucket: bounds what one task sorts.
BUCKET_DOCS = 512
# Buckets whose words are summed before the sums are ordered: bounds what one task orders for a source.
BUCKET_RUN = 4096
# Copies of one row that are dealt together.
BATCH = 512
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0


@dataclass(frozen=True)
class Source:
    """A line of the recipe. The recipe is the one thing that the driver holds: a row per source."""

    place: int
    name: str | None
    size: int
    blocks: int
    target: float
    slots: int


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Share `total` by weight; a target stops at `most` times its size, what is over goes to the others by weight."""
    found, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] >= weight * most * sizes[i]}
        if not over:
            for i in open_:
                found[i] = left * weights[i] / weight
            break
        for i in over:
            found[i] = most * sizes[i]
        left -= sum(found[i] for i in over)
        open_ -= over
    return found


def _sized(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    """doc (all columns), source, id, size, and a mark: 128 bits of the whole row, which equal rows share."""
    columns = [F.col(f"`{f.name}`") if "map<" not in f.dataType.simpleString() else F.to_json(F.struct(f"`{f.name}`")) for f in docs.schema.fields]
    missing = F.array(*[F.col(f"`{c}`").isNull() for c in docs.columns])
    mark = F.struct(F.xxhash64(*columns, missing).alias("a"), F.xxhash64(F.lit(1), *columns, missing).alias("b"))
    return docs.select(F.struct("*").alias("doc"), F.col(source).cast("string").alias("source"), F.col(doc_id).alias("id"), F.size(words(text_or_empty(text))).cast("long").alias("size"), mark.alias("mark"))


def recipe(streams: DataFrame, weights: tuple[float, ...], share: float, most: float) -> list[Source]:
    """Targets and slots per source, in the order of code points, null last; weights repeat along it."""
    rows = streams.groupBy("source").agg(F.sum("size").alias("size"), F.ceil(F.sum("size") / BLOCK_WORDS).alias("blocks")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    found = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
    passes = math.ceil(most)
    slots = [min(round(t * r["blocks"] / r["size"]), passes * r["blocks"]) if r["size"] else 0 for t, r in zip(found, rows, strict=True)]
    return [Source(i, r["source"], r["size"], r["blocks"], t, n) for i, (r, t, n) in enumerate(zip(rows, found, slots, strict=True))]


def _halved(rng: np.random.Generator, counts: np.ndarray, take: int) -> np.ndarray:
    """How many of `take` slots, drawn without return from the counts, each source gets."""
    rest, out = int(counts.sum()), np.zeros_like(counts)
    for i, have in enumerate(counts.tolist()):
        rest -= have
        if take <= 0 or have == 0:
            continue
        if rest + have < 10**9:
            got = int(rng.hypergeometric(have, rest, take))
        else:  # beyond the generator's range the normal form of the draw is as good
            whole = rest + have
            p = take / whole
            spread = math.sqrt(have * p * (1 - p) * rest / max(1, whole - 1))
            got = round(rng.normal(have * p, spread))
            got = max(take - rest, 0, min(have, take, got))
        out[i] = got
        take -= got
    return out


def draws(counts: list[int], shards: int, slots: int, seed: int, wanted: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, slots of each source in it, slots of each source in the shards before) for the wanted shards."""

    def descend(low: int, high: int, have: np.ndarray, before: np.ndarray):
        if high <= wanted.start or low >= wanted.stop:
            return
        if high - low == 1:
            yield low, have, before
            return
        middle = (low + high) // 2
        left = _halved(np.random.default_rng((seed, low, high)), have, (middle - low) * slots)
        yield from descend(low, middle, left, before)
        yield from descend(middle, high, have - left, before + left)

    yield from descend(0, shards, np.array(counts, dtype=np.int64), np.zeros(len(counts), dtype=np.int64))


def permuted(index: np.ndarray, n: int, seed: tuple[int, ...]) -> np.ndarray:
    """Places of `index` in a pseudorandom permutation of 0..n-1: a Feistel network, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = np.random.default_rng((*seed, n)).integers(0, 1 << 63, size=4, dtype=np.uint64)
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    outside = np.ones(len(out), dtype=bool)
    while outside.any():
        a, b = out[outside] >> np.uint64(half), out[outside] & low
        for key in keys:
            f = (b + key) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            a, b = b, a ^ ((f * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)) & low
        out[outside] = (a << np.uint64(half)) | b
        outside = out >= np.uint64(n)
    return out.astype(np.int64)


def _slots(spark, lines: list[Source], seed: int) -> DataFrame:
    """(shard, slot, place, pass, block): every slot of the output and the block it takes."""
    counts, blocks = [s.slots for s in lines], [s.blocks for s in lines]
    shards = max(1, math.ceil(sum(counts) / SHARD_SLOTS))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                for _, have, before in draws(counts, shards, SHARD_SLOTS, seed, range(shard, shard + 1)):
                    place = np.repeat(np.arange(len(have)), have)
                    number = np.arange(len(place)) - np.repeat(np.cumsum(have) - have, have) + np.repeat(before, have)
                    size = np.array(blocks, dtype=np.int64)[place]
                    turn, block = number // np.maximum(size, 1), np.zeros(len(place), dtype=np.int64)
                    for p, t in set(zip(place.tolist(), turn.tolist(), strict=True)):
                        at = (place == p) & (turn == t)
                        block[at] = permuted(number[at] % blocks[p], blocks[p], (seed, p, t))
                    slot = permuted(np.arange(len(place)), max(len(place), 1), (seed, shard))
                    columns = [np.full(len(slot), shard, dtype=np.int64), slot, place.astype(np.int32), turn.astype(np.int32), block]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "slot", "place", "pass", "block"])

    rows = spark.range(shards, numPartitions=max(1, math.ceil(shards / 32)))
    return rows.mapInArrow(fill, "shard long, slot long, place int, pass int, block long")


@dataclass(frozen=True)
class Mix:
    """slots: (shard, slot, place, pass, block). docs: a row for each document, without its text; distinct: mark, doc, copies.

    docs has mark, copy and batch (the row's number among equal ones, and the first number dealt with it), id, source, size,
    source_size, target, place and cuts: the document's words that the mix takes, block by block, as (start, end, at, block,
    uses), start and end counted in the document, `at` in the block, and uses the (pass, shard, slot) that the block fills.
    lines: the recipe.
    """

    slots: DataFrame
    docs: DataFrame
    distinct: DataFrame
    lines: list[Source]


def _based(streams: DataFrame) -> DataFrame:
    """streams with `base`, the words of the source before them, summed over runs of buckets first."""
    runs = streams.withColumn("run", F.floor(F.col("bucket") / BUCKET_RUN))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("source", "run").agg(F.sum("size").alias("in_run")).withColumn("run_base", F.coalesce(F.sum("in_run").over(before), F.lit(0)))
    inside = Window.partitionBy("source", "run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inner = runs.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    sums = sums.select(F.col("source").alias("_source"), F.col("run").alias("_run"), "run_base")
    both = inner.join(sums, F.col("source").eqNullSafe(F.col("_source")) & (F.col("run") == F.col("_run")))
    return both.select("source", "bucket", (F.col("run_base") + F.col("inner")).alias("base"))


def _copies(rows: DataFrame) -> DataFrame:
    """A row for each of `copies`, numbered by `copy`; rows of many copies are dealt to tasks by batches first."""
    few = rows.filter(F.col("copies") <= BATCH).withColumn("batch", F.lit(0).cast("long"))
    many = rows.filter(F.col("copies") > BATCH).withColumn("batch", F.explode(F.expr(f"sequence(0L, copies - 1, {BATCH}L)")))
    dealt = few.unionByName(many.repartition("mark", "batch"))
    return dealt.withColumn("copy", F.explode(F.sequence("batch", F.least(F.col("batch") + BATCH, F.col("copies")) - 1)))


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 11
) -> Mix:
    """Mix all rows. Sizes are counted in words; sources in the order of code points, null last, weigh `weights`, repeating.

    Empty and null texts have size 0 and are never taken; an empty table mixes nothing. Equal rows are interchangeable
    and each is mixed on its own, however many there are; rows that differ in any column are not equal. A very long text
    stands in many blocks, each looked up on its own. Columns of `docs` stay inside `doc`. Reruns give the same mix.
    """
    spark = docs.sparkSession
    sized = _sized(docs, text, doc_id, source)
    rows = written(sized.groupBy("source", "id", "size", "mark").agg(F.count("*").alias("copies")), "mix-rows")
    buckets = max(1, math.ceil(rows.count() / BUCKET_DOCS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("mark"), F.lit(buckets))).withColumn("span", F.col("size") * F.col("copies"))
    streams = written(rows.groupBy("source", "bucket").agg(F.sum("span").alias("size")), "streams")
    lines = recipe(streams, weights, share, most)
    numbered = spark.createDataFrame([(s.place, s.name, s.size, s.target) for s in lines], "place int, name string, source_size long, target double")
    placed = _based(streams).join(numbered, F.col("source").eqNullSafe(F.col("name"))).select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "base", "place", "source_size", "target")
    slots = written(_slots(spark, lines, seed), "slots")
    uses = slots.groupBy("place", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "slot"))).alias("uses"))
    in_order = Window.partitionBy("source", "bucket").orderBy("id", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    ordered = rows.withColumn("first", F.coalesce(F.sum("span").over(in_order), F.lit(0)))
    ordered = ordered.join(placed, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))).drop("_source", "_bucket", "bucket", "span")
    each = _copies(ordered).withColumn("first", F.col("base") + F.col("first") + F.col("copy") * F.col("size"))
    own = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("first") / BLOCK_WORDS), F.floor((F.col("first") + F.col("size") - 1) / BLOCK_WORDS)))
    parts = each.withColumn("block", F.explode_outer(own))
    low = F.col("block") * BLOCK_WORDS - F.col("first")
    start = F.greatest(low, F.lit(0))
    cut = F.struct(start.alias("start"), F.least(low + BLOCK_WORDS, F.col("size")).alias("end"), (start - low).alias("at"), "block", "uses")
    found = parts.join(uses, ["place", "block"], "left").withColumn("cut", F.when(F.col("uses").isNotNull(), cut))
    keys = ["mark", "copy", "batch", "id", "source", "size", "source_size", "target", "place"]
    cuts = found.groupBy(*keys).agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    distinct = sized.groupBy("mark").agg(F.first("doc").alias("doc"), F.count("*").alias("copies"))
    return Mix(slots, cuts, distinct, lines)


def words_taken(mix: Mix) -> DataFrame:
    """A row for each document: id, size, source, source_size, target, taken (its words in the mix, repeats counted), n_shards."""
    taken = F.aggregate("cuts", F.lit(0).cast("long"), lambda acc, c: acc + (c["end"] - c["start"]) * F.size(c["uses"]))
    shards = F.size(F.array_distinct(F.flatten(F.transform("cuts", lambda c: c["uses"]["shard"])))).cast("long")
    return mix.docs.select("id", "size", "source", "source_size", "target", taken.alias("taken"), shards.alias("n_shards"))


def _with_units(mix: Mix, text: str) -> DataFrame:
    """The documents that the mix takes words of, with `doc` and `units`: their words, each with the white space behind it."""
    rows = mix.distinct.withColumn("batch", F.explode(F.expr(f"sequence(0L, copies - 1, {BATCH}L)")))
    used = mix.docs.filter(F.size("cuts") > 0).select("mark", "batch", "place", "cuts")
    return rows.join(used, ["mark", "batch"]).withColumn("units", F.regexp_extract_all(text_or_empty(f"doc.`{text}`"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0)))


def _words_of(c):
    return F.slice("units", (c["start"] + 1).cast("int"), (c["end"] - c["start"]).cast("int"))


def shards(mix: Mix, text: str = "text") -> DataFrame:
    """The mix itself: (shard, slot, place, pass, block, text), a row for each slot, with the words of its block.

    Words keep the white space behind them; where a document ends inside a block, a line feed stands before the next.
    """
    pieces = F.transform("cuts", lambda c: F.struct("place", c["block"].alias("block"), c["at"].alias("at"), c["uses"].alias("uses"), F.array_join(_words_of(c), "").alias("piece")))
    rows = _with_units(mix, text).select(F.explode(pieces).alias("p")).select("p.place", "p.block", "p.at", "p.piece", F.explode("p.uses").alias("u"))
    rows = rows.select("u.shard", "u.slot", "place", "u.pass", "block", F.struct("at", "piece").alias("piece")).repartition("shard")
    in_order = F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["piece"])
    return rows.groupBy("shard", "slot", "place", "pass", "block").agg(F.array_join(in_order, "\n").alias("text"))


def write_shards(mix: Mix, path: str, text: str = "text") -> None:
    """Write the mixed shards as Parquet, each shard whole in one file and in the order of its slots."""
    shards(mix, text).sortWithinPartitions("shard", "slot").write.option("compression", "zstd").parquet(path)


def texts(mix: Mix, text: str = "text", length: str = "n_chars") -> DataFrame:
    """One row for each document and pass that takes words of it: its columns, the text cut to the words taken.

    Words keep the white space behind them; `length`, if there is such a column, is counted anew.
    """
    passes = F.array_distinct(F.flatten(F.transform("cuts", lambda c: c["uses"]["pass"])))
    each = _with_units(mix, text).withColumn("turn", F.explode(passes))
    taken = F.transform("cuts", lambda c: F.when(F.array_contains(c["uses"]["pass"], F.col("turn")), _words_of(c)).otherwise(F.array().cast("array<string>")))
    cut = each.withColumn("cut", F.array_join(F.flatten(taken), ""))
    columns = cut.select("doc.*").columns
    out = {text: F.col("cut"), length: F.length("cut").cast(dict(cut.select("doc.*").dtypes).get(length, "long"))}
    return cut.select(*[out[c].alias(c) if c in out else F.col("doc").getField(c).alias(c) for c in columns])
