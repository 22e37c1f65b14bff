"""Byte-level BPE against the tiktoken library."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from pulse.llm import byte_bpe, queries

LINES = open(P.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, LINES)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.Vocabulary(LINES), P.PATTERN)


def texts():
    rng = random.Random(4)
    pools = ["ab cde fgh'", "aaaa  \n\t ", "éüñß Ω漢字🙂 ", "'s't're've'm'll'd 0123", "\x00\x1c\x1d\x85\xa0  a", "<|endoftext|>***$$$"]
    out = ["", " ", "don't  stop\n\n", "a" * 5000, "é" * 3000, " " * 4000, "<|endoftext|>", "x" + "ab" * 1500]
    for _ in range(600):
        pool = rng.choice(pools) + rng.choice(pools)
        out.append("".join(rng.choice(pool) for _ in range(rng.randrange(1, 120))))
    out += ["".join(rng.choice("etaoin shrdlu") for _ in range(400)) for _ in range(30)]
    return out


def test_ids_equal_the_library_and_decode_back(encoder, reference):
    t = texts()
    for text, ids in zip(t, encoder.encode_many(t)):
        assert ids.tolist() == reference.encode_ordinary(text), text[:80]
        assert encoder.vocabulary.decode(ids.tolist()).decode() == text


def test_segments_and_forgetting_change_nothing(encoder, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SEGMENT", 64)
    monkeypatch.setattr(byte_bpe, "GROUP_CHARS", 300)
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 50)
    monkeypatch.setattr(byte_bpe, "CELLS", 64)
    t = texts()
    assert [x.tolist() for x in encoder.encode_many(t)] == [reference.encode_ordinary(x) for x in t]


def test_heap_and_matrix_merge_alike(encoder):
    rng = random.Random(6)
    for _ in range(200):
        piece = bytes(rng.choice(b"etaoinshaaa ") for _ in range(rng.randrange(2, 60)))
        assert encoder.vocabulary._merge_long(piece).tolist() == encoder.vocabulary._merge_rows([piece], 64)[0].tolist()


def test_query(spark, reference):
    import hashlib

    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = reference.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, queries.QUERIES["op9_byte_bpe"](spark, sf).collect())) == sorted(want)


def test_edges(spark):
    d = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, "hi", "x"), (2, "hi", "x")], "doc_id long, text string, ids string")
    rows = sorted(((r.doc_id or 0), list(r.ids), bytes(r.decoded)) for r in queries.tokenised(d).collect())
    assert [(a, c) for a, _, c in rows] == [(0, b""), (1, b""), (2, b"hi"), (2, b"hi")]
    assert queries.tokenised(d.limit(0)).count() == 0


def test_encode_and_decode_columns(spark):
    bpe = byte_bpe.ByteBPE(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    d = spark.createDataFrame([(1, "Zoë's  42"), (2, None)], "doc_id long, text string")
    ids = d.select("doc_id", bpe.encode(d.text).alias("ids"))
    back = {r.doc_id: bytes(r.b) for r in ids.select("doc_id", bpe.decode(ids.ids).alias("b")).collect()}
    assert back == {1: "Zoë's  42".encode(), 2: b""}
