"""Best-fit decreasing packing of tokenised texts into windows.

A text's ids (and the end id) longer than a window are first cut into full
windows and a rest. Added tokens of the vocabulary's json (``<|endoftext|>``)
that stand in a text are cut out first and have their own ids, as in the
``tokenizers`` library. Pieces go, longest first, to the tightest open window
with room, which a segment tree over remaining capacities finds; without one,
a new window opens. Pieces are dealt by a hash of their place in the written
table into shards of about ``SHARD_PIECES``, whatever their ids, each sorted by
Spark and packed in one pass that holds only the open windows. Only lengths move, never ids.

Defined results: a null or empty text is the end id alone; every input row is
packed, repeated rows and null ids included; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routecast.llm.bpe import read_ranks
from routecast.llm.common import table, written

WINDOW = 2048
END_ID = 1
SHARD_PIECES = 1 << 16


_loaded: dict[str, object] = {}


def vocabulary(ranks_path: str):
    """The encoder of a rank file with the added tokens of the json file
    beside it, if any; one per Python worker."""
    if ranks_path not in _loaded:
        import public_tokenizers
        import tiktoken

        added, beside = {}, os.path.splitext(ranks_path)[0] + ".json"
        if os.path.exists(beside):
            with open(beside, encoding="utf-8") as f:
                added = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
        ranks = {k: v for k, v in read_ranks(ranks_path).items() if v not in added.values()}
        _loaded[ranks_path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
    return _loaded[ranks_path]


class OpenWindows:
    """Open windows by remaining capacity. A heap-shaped tree over capacities
    0..window marks which subtrees hold any."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, sequence: int) -> None:
        if not self.held[capacity]:
            i = capacity + self.leaves
            while i and not self.any[i]:
                self.any[i] = 1
                i >>= 1
        self.held[capacity].append(sequence)

    def take(self, length: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the tightest window that holds ``length``."""
        i = length + self.leaves
        if not self.any[i]:
            while True:
                if i == 1:
                    return None
                if not i & 1 and self.any[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.leaves:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        sequence = self.held[capacity].pop()
        if not self.held[capacity]:
            self.any[i] = 0
            i >>= 1
            while i and not (self.any[2 * i] or self.any[2 * i + 1]):
                self.any[i] = 0
                i >>= 1
        return capacity, sequence


def pieces(
    df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """``id_col``, start, length, doc_tokens and ids (binary, little-endian
    unsigned 32-bit) of every piece of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary(ranks_path)
        for b in batches:
            texts = b.column("_text")
            for at in range(0, b.num_rows, 256):
                row, start, length, total, ids = [], [], [], [], []
                for i, t in enumerate(texts.slice(at, 256).to_pylist(), at):
                    own = np.asarray([*(enc.encode(t, allowed_special="all") if t else ()), end_id], "<u4")
                    for s in range(0, len(own), window):
                        cut = own[s : s + window]
                        row.append(i)
                        start.append(s)
                        length.append(len(cut))
                        total.append(len(own))
                        ids.append(cut.tobytes())
                longs = [pa.array(x, pa.int64()) for x in (start, length, total)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").take(pa.array(row, pa.int64())), *longs, pa.array(ids, pa.large_binary())],
                    names=["_id", "start", "length", "doc_tokens", "ids"],
                )

    own = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    longs = [T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")]
    schema = T.StructType([own.schema["_id"], *longs, T.StructField("ids", T.BinaryType())])
    return own.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def pack(
    spark: SparkSession, cut: DataFrame, id_col: str = "doc_id", window: int = WINDOW, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """``cut`` (a written table of pieces) with sequence_id and offset."""
    shards = max(1, -(-cut.count() // shard_pieces))
    names = cut.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, opened, tree = None, 0, None
        for b in batches:
            sequence, offset = [], []
            for s, n in zip(b.column("_shard").to_pylist(), b.column("length").to_pylist()):
                if s != shard:
                    shard, opened, tree = s, 0, OpenWindows(window)
                found = tree.take(n)
                if found is None:
                    found = window, (shard << 40) + opened
                    opened += 1
                capacity, seq = found
                sequence.append(seq)
                offset.append(window - capacity)
                if capacity > n:
                    tree.put(capacity - n, seq)
            own = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"]
            )

    dealt = (
        cut.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
        .repartition(shards, "_shard")
        .sortWithinPartitions("_shard", F.desc("length"), id_col, "start")
    )
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each window, without padding, from packed pieces
    that carry their ids. A window is bounded, so is its group."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(own, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_texts(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Packed pieces of doc_id and text, with the checksum of their ids."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the vocabulary of byte_bpe_50k.json
    cut = pieces(df, ranks).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    packed = pack(spark, written(spark, cut, "pieces"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op8_packing": op8_packing}
ORACLES: dict[str, str] = {}
