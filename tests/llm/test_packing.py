import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from routecast.llm import packing
from routecast.llm.common import written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.01"


def whole(rows, window):
    """Every window is gapless from 0 and fits."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return by


def test_open_windows_against_a_scan():
    rng = random.Random(1)
    tree, model = packing.OpenWindows(100), []
    for k in range(3000):
        n = rng.randint(1, 100)
        fits = [c for c, _ in model if c >= n]
        got = tree.take(n)
        if not fits:
            assert got is None
        else:
            assert got[0] == min(fits)
            model.remove(got)
        c = rng.randint(0, 100)
        if c and rng.random() < 0.7:
            tree.put(c, k)
            model.append((c, k))


def test_edges(spark):
    text = "word " * 40
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "<|endoftext|>"), (5, "é\U0001f600")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    cut = written(spark, packing.pieces(df, RANKS, window=16), "t")
    got = packing.pack(spark, cut, window=16, shard_pieces=8).collect()
    whole(got, 16)
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append(r)
    assert [(r.length, bytes(r.ids)) for r in per[1] + per[2]] == [(1, b"\x01\0\0\0")] * 2
    assert len(per[3]) == 2 * len(per[None])
    assert sorted(r.start for r in per[None]) == list(range(0, per[None][0].doc_tokens, 16))
    seq = packing.sequences(spark.createDataFrame(got, cut.schema.add("sequence_id", "long").add("offset", "long")))
    assert sum(len(r.ids) for r in seq.collect()) == 4 * sum(r.length for r in got)
    empty = written(spark, packing.pieces(df.where("false"), RANKS), "t")
    assert packing.pack(spark, empty).collect() == []


def test_added_tokens_in_a_text(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, f"a {end} b", f"{end}{end}", f"a  {end}\n\n  b{end}", f"x<|{end}|>é", "<|endoftext", f" {end} "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pieces(df, RANKS).collect()}
    assert got == {i: [*t.encode(x, add_special_tokens=False).ids, 1] for i, x in enumerate(texts)}
    assert got[1] == [64, 220, 50256, 275, 1]


def test_shards_of_rows_without_an_id(spark):
    df = spark.createDataFrame([(None, "word")] * 400, "doc_id long, text string")
    cut = written(spark, packing.pieces(df, RANKS, window=16), "t")
    got = packing.pack(spark, cut, window=16, shard_pieces=100).collect()
    whole(got, 16)
    assert len(got) == 400
    per = [sum(r.sequence_id >> 40 == s for r in got) for s in range(4)]
    assert sum(per) == 400 and max(per) <= 200


def test_query(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = packing.op8_packing(spark, SF).collect()
    by = whole(got, packing.WINDOW)
    used = sum(r.length for r in got)
    assert used > 0.98 * packing.WINDOW * len(by)
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append(r)
    for d in docs:
        ids = np.asarray([*t.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(per.pop(d.doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    assert not per
