"""Nearest neighbours with an inverted multi-index.

Both halves of a vector are quantised on their own, each to the nearest of
``CENTROIDS`` centroids, fitted by Lloyd's rounds on about ``MAX_SAMPLE``
vectors chosen by hash. A cell is a pair of centroids. A query takes the cells
in order of their summed squared distance from its halves, with a heap over
the two sorted lists, until the cells taken hold ``SHARE`` of all vectors and
at least ``LEAST`` (the vectors this was tuned on are nearly unclustered, and
a smaller share misses the recall of 0.9; clustered ones need less). All
vectors in those cells are ranked by their exact distance in double precision.

Work is dealt by first centroid, at most ``BLOCK`` vectors and ``QUERY_BLOCK``
queries to a task; a larger cell row is split. Of each set of equal vectors,
the ``k + 1`` smallest ids are indexed, as no list can hold more of them; the
partial limit on the reading side keeps a large set from meeting in one task.

Defined results: vectors that are null, empty, zero, hold null or non-finite
components, have a null id, or whose length is not the most frequent one
(ties: the longest) take no part; repeated rows count once; an id with several
vectors is ranked for each, and never among its own neighbours; other columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routecast.llm.common import table, written

CENTROIDS = 64  # of each half; a query's cells of a row fit the bits of a long
SHARE, LEAST = 0.6, 1000
MAX_SAMPLE, LLOYD_ROUNDS = 20_000, 12
BLOCK, QUERY_BLOCK = 16_384, 4096


class Codebook(NamedTuple):
    left: np.ndarray
    right: np.ndarray

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.left.shape[1]
        return x[:, :n], x[:, n:]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T, 0)


def centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from distinct rows spread over the sample."""
    rows = np.unique(x, axis=0)
    if len(rows) <= k:
        return rows
    c = rows[np.random.default_rng(5).permutation(len(rows))[:k]]
    for _ in range(LLOYD_ROUNDS):
        near = np.argmin(squared(x, c), axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct id and v (array of double) of the vectors that take part."""
    v = F.col("v")
    own = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    own = own.where(F.col("id").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0))
    size = own.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return own.where(F.size("v") == (size.size if size else 0)).distinct()


def fit(vectors: DataFrame, n: int, k: int) -> Codebook | None:
    share = min(1.0, MAX_SAMPLE / max(1, n))
    sample = vectors.where(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 20)) < max(1, int(share * (1 << 20))))
    rows = sample.orderBy("id", "v").select("v").toArrow().column("v").to_pylist()
    if not rows:
        return None
    x = np.array(rows, float)
    half = x.shape[1] // 2
    return Codebook(centroids(x[:, :half], k), centroids(x[:, half:], k))


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x, "<f8")], pa.large_binary())


def assign(vectors: DataFrame, book: Codebook) -> DataFrame:
    """id, v (packed), and the centroids of both halves."""
    shared = vectors.sparkSession.sparkContext.broadcast(book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("v"))
            near = [np.argmin(squared(h, c), axis=1).astype(np.int32) for h, c in zip(own.halves(x), own)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), _packed(x), pa.array(near[0]), pa.array(near[1])], names=["id", "v", "c1", "c2"]
            )

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {id_type}, v binary, c1 int, c2 int")


def cells_in_order(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by summed distance: a pair enters the heap once both
    that come before it in one list have left."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    done = [0] * len(s1)  # pairs taken in each row
    heap = [(s1[0] + s2[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        done[i] = j + 1
        yield int(o1[i]), int(o2[j])
        if i + 1 < len(s1) and done[i + 1] == j:
            heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
        if j + 1 < len(s2) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))


def visits(queries: DataFrame, book: Codebook, sizes: np.ndarray, wanted: int) -> DataFrame:
    """id, v, c1 and the set of second centroids (bits) that a query takes."""
    shared = queries.sparkSession.sparkContext.broadcast((book, sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = shared.value
        n = n.tolist()
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("v"))
            d1, d2 = (squared(h, c) for h, c in zip(own.halves(x), own))
            row, first, bits = [], [], []
            for q in range(len(x)):
                taken, held = {}, 0
                for c1, c2 in cells_in_order(d1[q], d2[q]):
                    if n[c1][c2]:
                        taken[c1] = taken.get(c1, 0) | (1 << c2)
                        held += n[c1][c2]
                        if held >= wanted:
                            break
                row += [q] * len(taken)
                first += taken.keys()
                bits += taken.values()
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(at), _packed(x).take(at), pa.array(first, pa.int32())]
                + [pa.array(np.array(bits, np.uint64).view(np.int64))],
                names=["id", "v", "c1", "bits"],
            )

    id_type = queries.schema["id"].dataType.simpleString()
    return queries.mapInArrow(run, f"id {id_type}, v binary, c1 int, bits long")


def nearest(q: np.ndarray, qid, bits: np.ndarray, x: np.ndarray, xid, c2: np.ndarray, k: int):
    """(query row, vector row, distance) of the ``k`` nearest in the block."""
    rows, cols, scores = [], [], []
    for i in range(0, len(q), 256):
        d = squared(q[i : i + 256], x)
        open_ = (bits[i : i + 256, None] >> c2[None].astype(np.uint64)) & np.uint64(1) == 1
        d[~open_ | (qid[i : i + 256, None] == xid[None])] = np.inf
        kth = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
        scale = (q[i : i + 256] ** 2).sum(1) + (x * x).sum(1).max()
        # the expanded square is off by rounding; near ties are ranked exactly
        near = d <= np.where(np.isfinite(kth), kth + 1e-9 * scale, np.finfo(float).max)[:, None]
        for r in range(len(d)):
            at = np.flatnonzero(near[r])
            exact = np.sqrt(((x[at] - q[i + r]) ** 2).sum(1))
            best = np.lexsort((xid[at], exact))[:k]
            rows.append(np.full(len(best), i + r))
            cols.append(at[best])
            scores.append(exact[best])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


def search(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 10,
    share: float = SHARE,
    least: int = LEAST,
    n_centroids: int = CENTROIDS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, the ``k`` nearest ids and their distances (score), of
    every vector of which ``is_query`` (over ``id_col``) holds."""
    if not 1 <= n_centroids <= 64:
        raise ValueError("1 to 64 centroids a half")
    spark = df.sparkSession
    vectors = written(spark, usable(df, id_col, vec_col), "vectors")
    id_type = vectors.schema["id"].dataType.simpleString()
    n = vectors.count()
    book = fit(vectors, n, n_centroids)
    if book is None:
        return spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    equal = Window.partitionBy("v").orderBy("id")
    few = vectors.withColumn("r", F.row_number().over(equal)).where(F.col("r") <= k + 1).drop("r")
    index = written(spark, assign(few, book), "index")
    sizes = np.zeros((len(book.left), len(book.right)), np.int64)
    for r in index.groupBy("c1", "c2").count().collect():  # at most 4096 cells
        sizes[r.c1, r.c2] = r["count"]
    queries = vectors.withColumnRenamed("id", id_col).where(is_query).withColumnRenamed(id_col, "id")
    n_queries = queries.count()
    lots = max(1, -(-n_queries // query_block))
    spread = queries.repartition(max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_queries // 16)), "id")
    wanted = max(least, int(share * sizes.sum()))
    asked = visits(spread, book, sizes, wanted).withColumn("lot", F.pmod(F.xxhash64("id", "v"), F.lit(lots)).cast("int"))
    asked = written(spark, asked, "visits")
    # a row of cells above the block size is split by hash, each part asked
    splits = F.element_at(F.array(*[F.lit(int(max(1, -(-s // block)))) for s in sizes.sum(axis=1)]), F.col("c1") + 1)
    asked_parts = asked.withColumn("part", F.explode(F.sequence(F.lit(0), splits - 1)))
    parts_of = index.withColumn("part", F.pmod(F.xxhash64("id", "v"), splits).cast("int"))
    wanted_by = written(spark, asked_parts.select("c1", "part", "lot").distinct(), "asked")  # at most blocks times lots
    dealt = parts_of.join(wanted_by, ["c1", "part"])
    dim = book.left.shape[1] + book.right.shape[1]

    def rank(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "v": [], "vec_id": [], "score": []})
        q, x = (np.frombuffer(b"".join(t["v"]), "<f8").reshape(-1, dim) for t in (left, right))
        bits = left["bits"].to_numpy().view(np.uint64)
        i, j, d = nearest(q, left["id"].to_numpy(), bits, x, right["id"].to_numpy(), right["c2"].to_numpy(), k)
        return pd.DataFrame(
            {"query_id": left["id"].to_numpy()[i], "v": left["v"].to_numpy()[i], "vec_id": right["id"].to_numpy()[j], "score": d}
        )

    keys = ["c1", "part", "lot"]
    near = asked_parts.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(
        rank, f"query_id {id_type}, v binary, vec_id {id_type}, score double"
    )
    order = Window.partitionBy("query_id", "v").orderBy("score", "vec_id")
    near = near.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return near.select("query_id", "rank", "vec_id", "score")


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {"op10_multi_index": op10_multi_index}
ORACLES: dict[str, str] = {}
