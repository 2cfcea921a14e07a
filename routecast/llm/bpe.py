"""Byte-level BPE encoding and decoding of whole texts.

A text over ``CHUNK`` characters is cut into overlapping windows that are
pre-tokenised side by side. Pre-tokenisation only looks ahead, so two scans
that share one boundary agree from there on: the first boundary in an overlap
that both windows report, after a character that is no white space, is a true
boundary, and the text before it tokenises the same without what follows. The
windows are cut anew at those boundaries and the pieces encoded on their own;
ids of a text's pieces are laid end to end. A text of which some overlap holds
no shared boundary (one run of letters longer than the overlap, say) is
encoded in one piece. Shorter texts are one piece from the start.

Defined results: a null or empty text has no ids; decoding null ids gives no
bytes; every input row gives one output row, repeated rows and repeated or
null ids included; other columns are ignored; an empty table gives an empty
table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routecast.llm.common import string_buffers, table

CHUNK = 32768  # characters of a window
OVERLAP = 1024  # characters that a window reaches into the next one

_loaded: dict[str, object] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def vocabulary(ranks_path: str):
    """The encoder of a rank file; one per Python worker."""
    if ranks_path not in _loaded:
        import public_tokenizers
        import tiktoken

        _loaded[ranks_path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        )
    return _loaded[ranks_path]


def ids_column(per_text: list[list[int]]) -> pa.Array:
    """Ids as little-endian unsigned 32-bit integers, one binary per text."""
    return pa.array([np.asarray(x, "<u4").tobytes() for x in per_text], pa.large_binary())


def _schema(df: DataFrame, keep: list[str], *more: T.StructField) -> T.StructType:
    return T.StructType([df.schema[c] for c in keep] + list(more))


def _encode_pieces(df: DataFrame, keep: list[str], ranks_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary(ranks_path)
        for b in batches:
            texts = b.column("_text")
            for at in range(0, b.num_rows, 256):
                own = texts.slice(at, 256).to_pylist()
                ids = ids_column([enc.encode_ordinary(t) if t else [] for t in own])
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(at, 256) for c in keep] + [ids], names=[*keep, "ids"]
                )

    return df.mapInArrow(run, _schema(df, keep, T.StructField("ids", T.BinaryType())))


def _windows(df: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(doc key, window number, windows of the text, the window's text)."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                text = b.column("_text")[i].as_py()
                total = -(-len(text) // chunk)
                for k in range(total):
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column("_key").slice(i, 1),
                            pa.array([k], pa.int64()),
                            pa.array([total], pa.int64()),
                            pa.array([text[k * chunk : (k + 1) * chunk + overlap]], pa.large_string()),
                        ],
                        names=["_key", "k", "total", "window"],
                    )

    schema = T.StructType(
        [
            df.schema["_key"],
            T.StructField("k", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("window", T.StringType()),
        ]
    )
    return df.select("_key", "_text").mapInArrow(run, schema)


def window_boundaries(window: str, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Pre-token boundaries of a window that can be shared: those in its own
    first ``overlap`` characters, counted from its start, and those in the
    part it lends to the next window, counted from that one's start. A
    boundary counts after white space only on the lending side's say (there it
    never does), and a match that ends within two characters of the window's
    end may still change with what follows."""
    import public_tokenizers
    import regex

    pat = _loaded.get("pattern")
    if pat is None:
        pat = _loaded["pattern"] = regex.compile(public_tokenizers.PATTERN)
    head, lent = [0], []
    for m in pat.finditer(window):
        end = m.end()
        if end <= overlap:
            head.append(end)
        if chunk <= end <= len(window) - 2 and not window[end - 1].isspace():
            lent.append(end - chunk)
    return head, lent


def _boundaries(windows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    def run(batches):
        for b in batches:
            both = [window_boundaries(w, chunk, overlap) for w in b.column("window").to_pylist()]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("_key"), b.column("k"), b.column("total")]
                + [pa.array([x[side] for x in both], longs) for side in (0, 1)],
                names=["_key", "k", "total", "head", "lent"],
            )

    longs = T.ArrayType(T.LongType())
    schema = _schema(windows, ["_key", "k", "total"], T.StructField("head", longs), T.StructField("lent", longs))
    return windows.mapInArrow(run, schema)


def _cuts(marks: DataFrame, chunk: int) -> DataFrame:
    """Per text, the positions where its windows resynchronise; no cuts when
    one of them does not."""
    right = marks.where("k > 0").select("_key", "k", "total", "head")
    left = marks.select("_key", (F.col("k") + 1).alias("k"), "lent")
    both = right.join(left, ["_key", "k"]).withColumn("q", F.array_min(F.array_intersect("head", "lent")))
    per_text = both.groupBy("_key").agg(
        F.count("q").alias("found"),
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.col("k") * chunk + F.col("q"))).alias("cuts"),
    )
    return per_text.select(
        "_key", F.when(F.col("found") == F.col("total") - 1, F.col("cuts")).otherwise(F.array().cast("array<long>")).alias("cuts")
    )


def _pieces(df: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                text, cuts = b.column("_text")[i].as_py(), b.column("cuts")[i].as_py() or []
                at = [0, *cuts, len(text)]
                for k, (a, z) in enumerate(zip(at, at[1:])):
                    yield pa.RecordBatch.from_arrays(
                        [b.column("_key").slice(i, 1), pa.array([k], pa.int64()), pa.array([text[a:z]], pa.large_string())],
                        names=["_key", "piece", "_text"],
                    )

    schema = T.StructType([df.schema["_key"], T.StructField("piece", T.LongType()), T.StructField("_text", T.StringType())])
    return df.select("_key", "_text", "cuts").mapInArrow(run, schema)


def _joined(pieces: DataFrame) -> DataFrame:
    """Ids of a text's pieces, end to end: a group is one text."""

    def run(key, group):
        import pandas as pd

        return pd.DataFrame({"_key": [key[0]], "ids": [b"".join(group.sort_values("piece")["ids"])]})

    return pieces.groupBy("_key").applyInPandas(run, _schema(pieces, ["_key"], T.StructField("ids", T.BinaryType())))


def encode(
    df: DataFrame,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``id_col`` and ``ids`` (binary, little-endian unsigned 32-bit) of every
    row of ``df``."""
    if not 2 < overlap <= chunk:
        raise ValueError("the overlap must be at most a chunk")
    own = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    is_long = F.coalesce(F.length("_text"), F.lit(0)) > chunk
    short = _encode_pieces(own.where(~is_long), ["_id"], ranks_path)

    # equal rows are encoded once and counted
    long = (
        own.where(is_long)
        .groupBy("_id", "_text")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_key", F.concat_ws(":", F.sha2("_text", 256), F.col("_id").cast("string")))
    )
    windows = _windows(long, chunk, overlap).repartition(F.col("_key"), F.col("k"))
    cuts = _cuts(_boundaries(windows, chunk, overlap), chunk)
    pieces = _pieces(long.join(cuts, "_key")).repartition(F.col("_key"), F.col("piece"))
    coded = _joined(_encode_pieces(pieces, ["_key", "piece"], ranks_path))
    copies = long.select("_key", "_id", "_copies")
    coded = coded.join(copies, "_key").select(
        "_id", "ids", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_c")
    )
    return short.unionByName(coded.select("_id", "ids")).withColumnRenamed("_id", id_col)


def decode(df: DataFrame, ranks_path: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """``keep`` and ``bytes``: the raw bytes of each row's ids, end to end. An
    id outside the vocabulary fails the query."""

    def run(batches):
        enc = _loaded.get(("bytes", ranks_path))
        if enc is None:
            ranks = read_ranks(ranks_path)
            size = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, i in ranks.items():
                size[i] = len(token)
            by_id = sorted(ranks.items(), key=lambda x: x[1])
            flat = np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            enc = _loaded[("bytes", ranks_path)] = (flat, start, size)
        flat, start, size = enc
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                raw, offs = string_buffers(part.column(ids_col))
                ids = raw.view("<u4") if len(raw) else np.zeros(0, np.uint32)
                n = size[ids]
                ends = np.concatenate([[0], np.cumsum(n)])
                where = np.repeat(start[ids] - ends[:-1], n) + np.arange(ends[-1])
                out, cut = flat[where].tobytes(), ends[offs // 4]
                texts = pa.array([out[a:z] for a, z in zip(cut, cut[1:])], pa.large_binary())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [texts], names=[*keep, "bytes"])

    return df.mapInArrow(run, _schema(df, keep, T.StructField("bytes", T.BinaryType())))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(table(spark, sf_dir, "documents"), ranks)
    coded = coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
    )
    back = decode(coded, ranks, ["doc_id", "n_tokens", "ids_sha256"])
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


QUERIES = {"op6_byte_bpe": op6_byte_bpe}
ORACLES: dict[str, str] = {}
