"""Byte-level BPE with every distinct word encoded once for the whole table.

Texts are split into words; a block of documents keeps its distinct words and, per document, the words' codes by
position. The words of all blocks are shuffled by word, in packs of a hash bucket of words, so each is encoded in one
place; the ids go back to their block and take the places of the codes. What moves is a word per block, not a word per
position, and one code per position, once: words and codes leave by the same shuffle, which both sides read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import give_back, text_or_empty
from starloom.llm.pretokens import coded, gathered, split_columns

# Pieces after which a block is closed: bounds what a task holds.
BLOCK_PIECES = 2_000_000
# Documents split at once, and ids decoded at once.
BATCH, DECODED = 1000, 1_000_000
# Words whose ids a task remembers.
KNOWN = 150_000
# Pieces whose places are worked out at once.
SLICE = 250_000
# Hash buckets of words: a word's bucket is in one task, and a block's words of a bucket move as one row.
BUCKETS = 512


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@cache
def token_bytes(path: str) -> pa.Array:
    """The token-byte table by id; its size is that of the vocabulary, whatever the corpus."""
    table = ranks(path)
    by_id = dict(zip(table.values(), table.keys(), strict=True))
    return pa.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], pa.large_binary())


def _packed(codes: np.ndarray, level: int = 3) -> bytes:
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=level).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _pack_words(words: list[str]) -> bytes:
    raw = [w.encode() for w in words]
    sizes = np.array([len(raw), *map(len, raw)], dtype="<u4")
    return zstandard.ZstdCompressor(level=3).compress(sizes.tobytes() + b"".join(raw))


def _unpack_words(data: bytes) -> list[str]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    sizes = np.frombuffer(data, "<u4", n, 4)
    ends = 4 + 4 * n + np.cumsum(sizes, dtype=np.int64)
    return [data[e - z : e].decode() for e, z in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _pack_ids(ids: list[bytes]) -> bytes:
    """Ids per word, and all ids, in the order of the pack's words."""
    many = np.array([len(ids), *(len(i) // 4 for i in ids)], dtype="<u4")
    return _packed(np.concatenate((many, np.frombuffer(b"".join(ids), dtype="<u4"))))


def _unpack_ids(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = _unpacked(data)
    n = int(numbers[0])
    return numbers[1 : n + 1].astype(np.int64), numbers[n + 1 :]


PACK = pa.struct([("bucket", pa.int32()), ("data", pa.binary())])
BLOCKS = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("codes", pa.binary()), ("buckets", pa.binary()), ("packs", pa.list_(PACK))])
BLOCK_ROW = "block long, doc_id array<long>, counts array<int>, codes binary, buckets binary, packs array<struct<bucket:int,data:binary>>"


def _block(number: int, parts: list[tuple]) -> pa.RecordBatch:
    """One row: documents, their piece counts, codes by falling frequency, the bucket of each code's word, and the words by bucket.

    The block's name depends on its content: if a lost block is made again from rows in another order, ids of the old
    one do not fit it, and the job fails instead of placing wrong ids.
    """
    ids = pa.concat_arrays([p[0] for p in parts])
    counts = np.concatenate([np.diff(p[3]) for p in parts])
    words = pa.chunked_array([p[1] for p in parts]).combine_chunks()
    shift = np.concatenate(([0], np.cumsum([len(p[1]) for p in parts])))[:-1]
    merged = words.dictionary_encode()
    local = np.asarray(merged.indices, dtype=np.int32)
    codes = np.concatenate([local[s : s + len(p[1])][p[2]] for p, s in zip(parts, shift, strict=True)])
    often = np.argsort(-np.bincount(codes, minlength=len(merged.dictionary)), kind="stable")
    place = np.empty(len(often), dtype=np.uint32)
    place[often] = np.arange(len(often))
    in_order = merged.dictionary.take(pa.array(often)).to_pylist()
    bucket = np.array([xxhash.xxh3_64_intdigest(w) % BUCKETS for w in in_order], dtype=np.uint32)
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by_bucket], np.arange(BUCKETS + 1))
    packs = []
    for i in range(BUCKETS):
        if len(part := by_bucket[cuts[i] : cuts[i + 1]]):
            packs.append({"bucket": i, "data": _pack_words([in_order[k] for k in part])})
    packed = _packed(place[codes])
    name = xxhash.xxh3_64(np.int64(number).tobytes() + packed)
    for values in (np.asarray(ids.fill_null(0)).tobytes(), *(p["data"] for p in packs)):
        name.update(values)
    name = np.uint64(name.intdigest()).view(np.int64)
    one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name], pa.int64()), one(ids, pa.int64()), one(pa.array(counts.astype(np.int32)), pa.int32()), pa.array([packed], pa.binary()),
            pa.array([_packed(bucket)], pa.binary()), pa.array([packs], pa.list_(PACK)),
        ],
        schema=BLOCKS,
    )


def encoded(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids) for every row of `docs`: the ids that the tiktoken library gives each match of the pattern, in order.

    Null and empty texts have no ids (an empty array). Repeated rows and repeated or null ids each give a row; other
    columns are not used. Special tokens in a text are ordinary text. Read `docs` from a table: rows that come in another
    order when a lost part is made again fail the job.
    """
    pieces, whole = split_columns(text_or_empty(text), pattern)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number, parts, size = context.partitionId() << 32, [], 0
        for batch in (b.slice(i, BATCH) for b in batches for i in range(0, b.num_rows, BATCH)):
            words, codes, begins = coded(batch.column(1), batch.column(2), pattern)
            parts.append((batch.column(0), words, codes, begins))
            size += len(codes)
            if size >= BLOCK_PIECES:
                yield _block(number, parts)
                number, parts, size = number + 1, [], 0
        if parts:
            yield _block(number, parts)
        give_back()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), pieces, whole)
    # One shuffle for both readers: each takes whole rows, so that the plans below are the same and Spark reuses it.
    table = rows.mapInArrow(blocks, BLOCK_ROW).repartition("block")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packs in zip(batch.column("block"), batch.column("packs"), strict=True):
                fields = packs.values.flatten()
                yield pa.RecordBatch.from_arrays([pa.repeat(block, len(packs.values)), *fields], ["block", "bucket", "data"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, known = encoding(ranks_path, pattern), {}
        for batch in batches:
            out = []
            for data in batch.column(2):
                words = _unpack_words(data.as_py())
                for word in words:
                    if word not in known:
                        known[word] = np.array(codec.encode_ordinary(word), dtype="<u4").tobytes()
                out.append(_pack_ids([known[w] for w in words]))
                if len(known) > KNOWN:  # bounds memory: a word that comes again is then encoded again
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["block", "bucket", "ids"])
        del known
        give_back()

    entries = table.mapInArrow(unpack, "block long, bucket int, data binary")
    found = entries.repartition("bucket").mapInArrow(encode, "block long, bucket int, ids binary")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})
        out = []
        packs = [_unpack_ids(data.as_py()) for data in right.sort_by("bucket")["ids"]] or [(np.zeros(0, np.int64),) * 2]
        many, flat = (np.concatenate(part) for part in zip(*packs, strict=True))
        buckets = _unpacked(left["buckets"][0].as_py())
        if len(many) != len(buckets) or left.num_rows > 1:
            raise ValueError("the words of a block do not fit its codes: its rows came in another order when it was made again")
        order = np.empty(len(buckets), dtype=np.int64)
        order[np.argsort(buckets, kind="stable")] = np.arange(len(buckets))
        values, _ = gathered(flat, np.concatenate(([0], np.cumsum(many))), order)
        values, starts = values.astype(np.int32), np.concatenate(([0], np.cumsum(many[order])))
        for row in range(left.num_rows):
            ids, codes = left["doc_id"][row].values, _unpacked(left["codes"][row].as_py())
            ends = np.concatenate(([0], np.cumsum(np.asarray(left["counts"][row].values, dtype=np.int64))))
            first = 0
            while first < len(ids):  # some documents at a time, so that no array holds the whole block's places
                end = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE, side="right")) - 1)
                some, each = gathered(values, starts, codes[ends[first] : ends[end]])
                cuts = np.concatenate(([0], np.cumsum(each)))[ends[first : end + 1] - ends[first]]
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(some))
                out.append(pa.table({"doc_id": ids.slice(first, end - first), "ids": lists}))
                first = end
        return pa.concat_tables(out)

    return table.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(assemble, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The rows with `bytes`, the text's bytes: each id is looked up in the token-byte table. Ids must be of the table.

    A null array gives null, an empty one no bytes. All columns of `rows` stay.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks_path)
        for batch in batches:
            place = batch.schema.get_field_index(ids)
            sizes = np.asarray(batch.column(place).value_lengths().fill_null(0), dtype=np.int64)
            all_ends, first = np.concatenate(([0], np.cumsum(sizes))), 0
            while first < batch.num_rows:  # some ids at a time: a token takes more room than its id
                end = max(first + 1, int(np.searchsorted(all_ends, all_ends[first] + DECODED, side="right")) - 1)
                part = batch.slice(first, end - first)
                lists, ends = part.column(place), all_ends[first : end + 1] - all_ends[first]
                joined = table.take(lists.flatten())
                cuts = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset : joined.offset + len(joined) + 1][ends] if len(joined) else np.zeros(len(ends), np.int64)
                data = joined.buffers()[2] or pa.py_buffer(b"")
                whole = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(cuts)), data])
                whole = pa.compute.if_else(lists.is_valid(), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, whole], [*batch.schema.names, "bytes"])
                first = end
        give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(decode, f"{fields}, bytes binary")
