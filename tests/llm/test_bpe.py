import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from routecast.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIB = bpe.vocabulary(RANKS)


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in bpe.encode(df, RANKS, **kw).collect())
    want = sorted(
        (i is None, i or 0, np.asarray(LIB.encode_ordinary(t or ""), "<u4").tobytes()) for i, t in rows
    )
    assert got == want


def test_edges(spark):
    check(spark, [(1, None), (2, ""), (3, " "), (None, "no id"), (4, "<|endoftext|> it's"), (4, "<|endoftext|> it's"), (5, "ä\U0001f600\n\n x")])
    check(spark, [])


@pytest.mark.parametrize("unit", ["ab  \n c d's 12é, ", "x", "   \n", "'re", " a", "日本語 テキスト。\n"])
def test_windows_equal_whole_text(spark, unit):
    rng = np.random.default_rng(3)
    words = [unit, " ", "don't", "\n\n", "word", "123", "!!", "é", "  "]
    mixed = "".join(words[i] for i in rng.integers(0, len(words), 700))
    check(spark, [(1, unit * 200), (2, mixed), (2, mixed), (3, mixed[::-1])], chunk=64, overlap=16)


def test_run_longer_than_the_overlap(spark):
    check(spark, [(1, "a" * 500 + " b c " + "d" * 300 + " " * 200 + "x")], chunk=64, overlap=8)


def test_round_trip(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    back = bpe.decode(bpe.encode(df, RANKS, chunk=2048, overlap=256), RANKS, ["doc_id"])
    joined = df.join(back, "doc_id").select(F.encode("text", "utf-8").alias("a"), F.col("bytes").alias("b")).collect()
    assert len(joined) == df.count() and all(r.a == r.b for r in joined)


def test_query_matches_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in bpe.op6_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = LIB.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
