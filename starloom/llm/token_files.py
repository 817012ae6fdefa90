"""Token ids as files: id blocks cut into byte or bit planes, each plane compressed by itself, with an index of chunks.

A file is a Parquet file of one shard: a row per chunk of ids, with the chunk's place (the index), its planes, and the
documents that begin in it. Shards follow each other in ascending doc_id, null first. Written through Spark, so that a
task that runs again replaces its file.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import batch_rows, text_or_empty
from starloom.llm.pretokens import coded, gathered, split_columns

CHUNK = 1 << 16
# Words whose ids a worker remembers between batches; it starts anew with those of a batch when there are more.
KNOWN = 1_000_000
# Words in one call of the library.
RUN = 1000
# Documents of an Arrow batch: what a task holds at once.
BATCH = 2000
SCHEMA = "shard int, chunk int, first long, n int, kind string, planes array<binary>, crc32 long, doc_id array<long>, doc_first array<long>, doc_n array<long>"


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The planes of a block of ids, lowest first, each compressed: 4 of bytes or 32 of bits."""
    flat = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        flat = np.unpackbits(flat, axis=1, bitorder="little")
        planes = [np.packbits(np.ascontiguousarray(flat[:, i]), bitorder="little") for i in range(32)]
    else:
        planes = [np.ascontiguousarray(flat[:, i]) for i in range(4)]
    pack = zstandard.ZstdCompressor(level=3)
    return [pack.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(unpack.decompress(p), np.uint8) for p in planes]
    if kind == "bit":
        bits = np.stack([np.unpackbits(r, bitorder="little", count=n) for r in rows], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)
    return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").reshape(-1)


@cache
def _tokenizer(path: str, added: bool = False) -> Tokenizer:
    """With `added`, as the library has it: literals of added tokens in a text become their ids.

    A task has one core: the library's own threads would only wait for each other.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    if not added:
        tokenizer.encode_special_tokens = True
    return tokenizer


def _literals(path: str) -> list[str]:
    return [t.content for t in _tokenizer(path, True).get_added_tokens_decoder().values() if t.content]


# Words a worker has encoded, where the ids of each begin (one more at the end), and the ids.
_KNOWN: dict[str, tuple[pa.Array, np.ndarray, np.ndarray]] = {}


def _encoded(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after another, and how many each has."""
    ids, many = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for start in range(0, len(words), RUN):
        part = words[start : start + RUN]
        out = _tokenizer(path).encode(part, is_pretokenized=True, add_special_tokens=False)
        ids.append(np.array(out.ids, dtype=np.uint32))
        many.append(np.bincount(np.array(out.word_ids, dtype=np.int64), minlength=len(part)))
    return np.concatenate(ids), np.concatenate(many)


def _known(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, where those of each known word begin, and the place of each of the words; only unknown ones are encoded."""
    known, starts, ids = _KNOWN.get(path) or (words.slice(0, 0), np.zeros(1, np.int64), np.zeros(0, np.uint32))
    found = pc.index_in(words, value_set=known)
    fresh = np.asarray(found.is_null())
    place = np.asarray(found.fill_null(0), dtype=np.int64)
    if fresh.any():
        new = words.filter(pa.array(fresh))
        place = np.where(fresh, len(known) + np.cumsum(fresh) - 1, place)
        more, many = _encoded(new.to_pylist(), path)
        known, ids = pa.concat_arrays([known, new]), np.concatenate((ids, more))
        starts = np.concatenate((starts, starts[-1] + np.cumsum(many)))
    if len(known) <= KNOWN:
        _KNOWN[path] = known, starts, ids
    else:  # go on with the words of this batch
        kept, many = gathered(ids, starts, place)
        _KNOWN[path] = words, np.concatenate(([0], np.cumsum(many))), kept
    return ids, starts, place


def _ids(batch: pa.RecordBatch, path: str, pattern: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, the end id behind each row's, and the ids per row. A text of column 3 is encoded by the library."""
    words, codes, begins = coded(batch.column(1), batch.column(2), pattern)
    known, starts, place = _known(words, path)
    ids, many = gathered(known, starts, place[codes])
    ends = np.concatenate(([0], np.cumsum(many)))[begins]
    literal = batch.column(3)
    if literal.null_count == len(literal):
        return np.insert(ids, ends[1:], np.uint32(end_id)), np.diff(ends) + 1
    # Such a row has no pieces: its ids go in before the end id.
    tails = [[end_id] if t is None else [*_tokenizer(path, True).encode(t, add_special_tokens=False).ids, end_id] for t in literal.to_pylist()]
    sizes = np.array([len(t) for t in tails])
    return np.insert(ids, np.repeat(ends[1:], sizes), np.concatenate(tails).astype(np.uint32)), np.diff(ends) + sizes


def write(docs: DataFrame, path: str, tokenizer_path: str, pattern: str, end_id: int = 2, kind: str = "byte", text: str = "text", doc_id: str = "doc_id", added: bool = False) -> None:
    """Encode every whole text with the tokenizer, put `end_id` behind each, and write the shards to a new folder.

    Literals of the tokenizer's added tokens are plain text; with `added` they become the tokens' ids, as by the library.
    Null and empty texts give the end id alone. Rows of one doc_id stand next to each other; their order among
    themselves is that of their texts. No rows give no chunks.
    """
    # A text with a literal in it goes to the library whole, as splitting at the token changes the pieces beside it.
    literals = _literals(tokenizer_path) if added else []
    special = F.exists(F.array(*map(F.lit, literals)), lambda x: F.contains(F.col("text"), x)) if literals else F.lit(False)
    pieces, whole = split_columns(F.when(~special, F.col("text")), pattern)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").select("doc_id", pieces, whole, F.when(special, F.col("text")).alias("literal"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, first, held, begun, total = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def row(ids: np.ndarray, starting: list[tuple[int, int, int]]) -> pa.RecordBatch:
            names, firsts, sizes = zip(*starting, strict=True) if starting else ((), (), ())
            values = {"shard": shard, "chunk": chunk, "first": first, "n": len(ids), "kind": kind, "planes": to_planes(ids, kind), "crc32": zlib.crc32(ids.astype("<u4").tobytes())}
            columns = [pa.array([values["shard"]], pa.int32()), pa.array([values["chunk"]], pa.int32()), pa.array([values["first"]], pa.int64()), pa.array([values["n"]], pa.int32()), pa.array([kind]), pa.array([values["planes"]], pa.list_(pa.binary())), pa.array([values["crc32"]], pa.int64())]
            columns += [pa.array([list(v)], pa.list_(pa.int64())) for v in (names, firsts, sizes)]
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids, sizes = _ids(batch, tokenizer_path, pattern, end_id)
            at = total + np.concatenate(([0], np.cumsum(sizes)))[:-1]
            begun += zip(batch.column(0).to_pylist(), at.tolist(), sizes.tolist(), strict=True)
            total += len(ids)
            held = np.concatenate((held, ids)) if len(held) else ids
            done = 0
            while len(held) - done >= CHUNK:
                cut = next((i for i, b in enumerate(begun) if b[1] >= first + CHUNK), len(begun))
                yield row(held[done : done + CHUNK], begun[:cut])
                chunk, first, begun, done = chunk + 1, first + CHUNK, begun[cut:], done + CHUNK
            held = held[done:]
        if len(held):
            yield row(held, begun)

    with batch_rows(docs.sparkSession, BATCH):
        placed.mapInArrow(chunks, SCHEMA).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files: ids as little-endian unsigned 32-bit integers.

    `start` is the number of ids of all documents before it. A chunk whose ids do not match its checksum fails.
    """
    table = spark.read.schema(SCHEMA).parquet(path)
    totals = table.groupBy("shard").agg(F.sum("n").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, shard, at = [], None, 0  # documents not yet whole: [doc_id, first, n, parts, have]
        for batch in batches:
            for r in batch.to_pylist():
                ids = from_planes(r["planes"], r["n"], r["kind"])
                if zlib.crc32(ids.tobytes()) != r["crc32"] or (r["shard"] == shard and r["first"] != at):
                    raise ValueError(f"shard {r['shard']}, chunk {r['chunk']}: damaged or out of order")
                shard, at = r["shard"], r["first"] + r["n"]
                open_ += [[d, f, n, [], 0] for d, f, n in zip(r["doc_id"], r["doc_first"], r["doc_n"], strict=True)]
                done = []
                for doc in open_:
                    low = max(doc[1], r["first"]) - r["first"]
                    part = ids[low : min(doc[1] + doc[2], at) - r["first"]]
                    doc[3].append(part.tobytes())
                    doc[4] += len(part)
                    if doc[4] == doc[2]:
                        done.append(doc)
                open_ = [d for d in open_ if d[4] < d[2]]
                if done:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * len(done), pa.int32()), *(pa.array([d[i] for d in done], pa.int64()) for i in range(3)), pa.array([b"".join(d[3]) for d in done], pa.binary())],
                        ["shard", "doc_id", "first", "n_tokens", "ids"],
                    )

    ordered = table.repartition("shard").sortWithinPartitions("shard", "chunk")
    rows = ordered.mapInArrow(documents, "shard int, doc_id long, first long, n_tokens long, ids binary")
    # A row per shard, that is per writing task: small whatever the corpus, so the ids need not be shuffled for it.
    return rows.join(F.broadcast(bases), F.col("shard") == F.col("_shard")).select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")
