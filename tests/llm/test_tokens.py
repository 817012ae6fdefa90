import base64
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from brute import sha
from tokenizers import Tokenizer

from starloom.llm import bpe_words, queries, token_files

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("pieces", [50, 4_000_000])
@pytest.mark.parametrize("source", ["odd", "documents"])
def test_ids_equal_the_library(source, pieces, request, codec, monkeypatch):
    monkeypatch.setattr(bpe_words, "BLOCK_PIECES", pieces)
    docs = request.getfixturevalue(source)
    rows = bpe_words.decoded(bpe_words.encoded(docs, RANKS, P.PATTERN), RANKS).collect()
    got = sorted(((r["doc_id"], list(r["ids"]), bytes(r["bytes"])) for r in rows), key=str)
    assert got == sorted(((i, codec.encode_ordinary(t), t.encode()) for i, t in texts(docs)), key=str)


def test_digests(spark, codec):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op8_bpe_words"](spark, "/root/testdata/sf0.001").collect()}
    for i, t in texts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        ids = codec.encode_ordinary(t)
        assert rows[i]["n_tokens"] == len(ids) and rows[i]["ids_sha256"] == sha(",".join(map(str, ids))) and rows[i]["decoded_sha256"] == sha(t)


def test_empty_table(documents, spark, tmp_path):
    none = documents.limit(0)
    assert bpe_words.decoded(bpe_words.encoded(none, RANKS, P.PATTERN), RANKS).count() == 0
    token_files.write(none, str(tmp_path / "f"), JSON, P.PATTERN)
    assert token_files.read(spark, str(tmp_path / "f")).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(1).integers(0, 1 << 32, n, dtype=np.uint32)
    planes = token_files.to_planes(ids, kind)
    assert len(planes) == {"byte": 4, "bit": 32}[kind]
    assert (token_files.from_planes(planes, n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("source", ["odd", "documents"])
def test_files_equal_the_library(source, kind, request, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 512)
    docs = request.getfixturevalue(source)
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    token_files.write(docs, str(tmp_path / "f"), JSON, P.PATTERN, 2, kind)
    rows = [(r["doc_id"], r["start"], r["n_tokens"], list(np.frombuffer(r["ids"], "<u4"))) for r in token_files.read(spark, str(tmp_path / "f")).collect()]
    want, at = [], 0
    for i, t in sorted(texts(docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), ids))
        at += len(ids)
    assert sorted(rows, key=lambda r: r[1]) == want


def test_file_digests(spark):
    rows = queries.QUERIES["op10_token_files"](spark, "/root/testdata/sf0.001").orderBy("start").collect()
    tokenizer = Tokenizer.from_file(JSON)
    at = 0
    for (i, t), r in zip(sorted(texts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))), rows, strict=True):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_damaged_chunk_fails(spark, documents, tmp_path):
    from pyspark.sql import functions as F

    token_files.write(documents, str(tmp_path / "f"), JSON, P.PATTERN)
    spark.read.parquet(str(tmp_path / "f")).withColumn("crc32", F.lit(1).cast("long")).write.parquet(str(tmp_path / "g"))
    with pytest.raises(Exception, match="damaged"):
        token_files.read(spark, str(tmp_path / "g")).count()


LITERALS = [(1, "a <|endoftext|> b"), (2, "plain  text\n\n x"), (2, "  <|endoftext|>\n\n<|endoftext|><|endoftext|>  x"), (3, None), (4, "<|endoftext|>"), (None, "it's <|endoftext|"), (7, "\U00031350 <|endoftext|> \U0001c7ff"), (8, "\U00031350 y")]


def test_literals_of_added_tokens_get_the_library_s_ids(spark, tmp_path):
    docs = spark.createDataFrame(LITERALS, "doc_id long, text string").repartition(3)
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    tokenizer = Tokenizer.from_file(JSON)
    want, at = [], 0
    for i, t in sorted(texts(docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    rows = queries.QUERIES["op10_token_files"](spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in rows] == want
