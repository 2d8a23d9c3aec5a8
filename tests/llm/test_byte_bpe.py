"""Byte-level BPE against the library whose ranks it uses, on texts of every kind."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.llm import byte_bpe
from tidewater.llm.queries import llm_queries

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "x" * 50_000, " " * 30_000 + "x", "\n \n\t" * 500, "don't  we'll　'S 12³½ 3", "<|endoftext|>", "\x00\x01\x1c\x1d\x85\xa0",
       "՘࢏⃁ a\U000323b0b\U00011de01", "é" * 999 + "🙂👍🏽🇩🇪", "�Āǿ"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(*byte_bpe._given(None, None)[:2], byte_bpe.stand_ins())


def test_every_token_and_every_character(library, codec):
    def ids(text):
        return [int(i) for part in codec.encode(text) for i in part]

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    assert ids(every) == library.encode_ordinary(every)
    texts = [t.decode() for t in codec.tokens.values() if not t.decode(errors="ignore").encode() != t]
    assert len(texts) > 40_000
    joined = " ".join(texts)
    assert ids(joined) == library.encode_ordinary(joined)
    rng = random.Random(5)
    for _ in range(3_000):
        text = "".join(rng.choice(every[:0x700] + " 　一가\U0001f600") for _ in range(rng.randint(1, 30)))
        got = ids(text)
        assert got == library.encode_ordinary(text) and codec.decode(got) == text.encode()


def test_chunks_and_the_memory_of_words_change_nothing(codec, monkeypatch):
    text = " ".join(f"word{i} über{i % 7}" for i in range(500)) + "y" * 3_000
    whole = [int(i) for part in codec.encode(text) for i in part]
    monkeypatch.setattr(byte_bpe, "CHUNK", 3)
    monkeypatch.setattr(byte_bpe, "KNOWN", 2)
    monkeypatch.setattr(byte_bpe, "SHORT", 10)
    assert [int(i) for part in codec.encode(text) for i in part] == whole


def test_ranks_with_gaps():
    ranks = {bytes([b]): 2 * b for b in range(256)} | {b"ab": 700, b"bc": 600, b"abc": 9_000, b"unreached": 40_000}
    import base64

    import tiktoken

    lines = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    codec = byte_bpe.Codec(lines, r"\S+|\s+", {})
    ids = [int(i) for part in codec.encode("abc abcd unreached") for i in part]
    assert ids == tiktoken.Encoding("gaps", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary("abc abcd unreached")
    assert ids == [9_000, 64, 9_000, 200, 64, 40_000]
    assert codec.decode(ids) == b"abc abcd unreached"
    with pytest.raises(ValueError, match="every byte"):
        byte_bpe.read_ranks(b"YQ== 0")


def test_query_against_the_library(spark, library, tmp_path, rows):
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, "twice"), (7, "twice")],
                                  "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs.unionByName(extra, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc_id, text in docs.union(extra.select("doc_id", "text")).collect():
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    got = llm_queries()["op12_byte_bpe"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_no_rows_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(empty)).collect() == []
    nulls = spark.createDataFrame([(1, None), (None, [0, 1])], "doc_id long, ids array<int>")
    assert sorted(byte_bpe.decode(nulls).select("decoded").collect())[0].decoded in (b"", bytearray(b""))
