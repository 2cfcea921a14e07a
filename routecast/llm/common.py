"""Helpers that several of the text operators share."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space: the separators of words in every operator here.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a scratch folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    named = tempfile.mkdtemp(prefix="routecast-llm-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def written(spark: SparkSession, df: DataFrame, name: str, slim: bool = False) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends
    there, and later jobs read the columns they need. The files go when the
    driver's JVM ends. ``slim`` tables have few bytes a row: an eighth of the
    usual number of files holds them."""
    if slim:
        df = df.coalesce(max(1, parts(spark) // 8))
    path = os.path.join(shared_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Free on the driver what the jobs so far have left. Spark drops broadcast
    tables (2 MB at least, however few rows) and shuffle state only when the
    driver's JVM has collected the plans that name them, and until then its
    heap grows with every job; a full collection also gives the heap back."""
    gc.collect()
    spark._jvm.System.gc()


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of_id(id_col: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.encode(c.cast("string"), "utf-8")) % F.lit(modulus)


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n+1) of an Arrow string or binary column; nulls are
    empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.large_binary()
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    col = col.cast(wide)
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def row_slices(offsets: np.ndarray, max_bytes: int, max_rows: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` text (a longer row stands alone),
    so that working memory follows the slice and not the batch."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n, i + max_rows)
        yield i, j
        i = j


def binary_array(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A large binary column from its bytes and offsets."""
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())],
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_RADIX = 0x9FB21C651E98DF25  # odd, so it has an inverse modulo 2^64
_RADIX_INV = pow(_RADIX, -1, 1 << 64)


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return _LOWER[raw]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of several texts laid end to end: start, end (byte positions) and
    the text's index, in order. A word never runs over a text's end."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~_SPACE[raw]
    starts = ink.copy()
    starts[1:] &= ~ink[:-1]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    starts[cuts] |= ink[cuts]
    ends[cuts - 1] |= ink[cuts - 1]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, s, side="right") - 1
    return s, e, doc


def word_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes: differences of prefix sums of a
    polynomial over randomised byte values, brought to a common power, then
    mixed with the length."""
    if len(s) == 0:
        return np.zeros(0, np.uint64)
    n = len(raw)
    up = np.full(n, _RADIX, np.uint64)
    up[0] = 1
    np.cumprod(up, out=up)
    pre = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up, out=pre[1:])
    down = np.full(n, _RADIX_INV, np.uint64)
    down[0] = 1
    np.cumprod(down, out=down)
    h = (pre[e] - pre[s]) * down[s]
    return mix64(h + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


SMALL_ROWS = 200_000  # most rows of a table that small_join broadcasts
SALTS = 32


def small_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Null-safe join of ``left`` with a ``right`` of distinct ``keys``. Up to
    ``max_rows`` (counted) ``right`` is broadcast; beyond, a key's rows on the
    left are spread over ``SALTS`` partitions by a hash of their columns (the
    same when a task is run again), each with a copy of the right row.
    ``right``'s other columns must not occur in ``left``."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    if right.limit(max_rows + 1).count() <= max_rows:
        on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
        return left.join(F.broadcast(renamed), on, how).drop(*[f"_r_{k}" for k in keys])
    salt = fresh(left, "_salt")
    salted = left.withColumn(salt, F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    renamed = renamed.withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col(salt) == F.col("_r_salt")]
    return salted.join(renamed, on, how).drop(salt, "_r_salt", *[f"_r_{k}" for k in keys])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body
    names it (a projection may be merged into the expression above it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
