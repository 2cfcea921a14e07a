"""Near-duplicate vectors by spherical-cap filters.

Vectors of cosine ``least`` or more are linked. Equal vectors form a class,
and one row stands for a class from there on. The filters are caps around the
words of random product codes: a vector is rotated at random (signs and
Hadamard transforms), its components are dealt to blocks, each block has its
own random words, and a filter direction is one word of every block. A
vector's score with a direction is the sum of its block scores, so the
directions above the cap's height are list-decoded block by block: a part that
cannot reach the height with the best of the blocks to come is left. That
finds all directions that a vector exceeds among many more than are ever
looked at. ``CODES`` codes make up for each other's weak spots.

The number of directions is in proportion to that of vectors, so that few
unrelated ones share a filter at any size. The height is the greatest at which
of ``TRIALS`` simulated pairs of cosine ``least`` no more than ``MISS`` share
no filter. Some vectors lie far from all words, and so do all their near
copies; their caps are lowered until each takes ``LIST`` directions. With that,
none of 6,000 other pairs at the bar shared no filter, for 50,000 vectors of 64
components (2 of 6,000 for a million); closer pairs are missed less.

Vectors that share a filter are verified in double precision. Filters of up to
``SMALL`` vectors give pairs of ids, whose vectors are joined once for each
pair. Larger ones, as a group of many near copies makes, are cut into blocks of
about ``BLOCK``; each two blocks meet in one product, which returns numbers of
links and a spanning forest, not pairs. A pair is counted in the first of the
large filters it shares, and among the pairs of ids only if it shares none.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing; neither do vectors of different
lengths; a vector that occurs under several ids links them all, and counts
once for each id; an id that occurs with several vectors has a row for each,
and its component is that of the row's vector; a null id counts as an id that
is never the smallest one; every input row gives one row, repeated rows
included; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import mix64, small_join, table, written
from routecast.llm.components import components

CODES = 16
SHARE = 800  # directions for each vector, over all codes
LEAST_WORDS, MOST_WORDS = 24, 4096  # of a block; beyond, codes take a block more
TRIALS, MISS = 2000, 20
LIST = 32  # directions that every vector takes at least
STEP = 0.2  # by which a height is lowered, in deviations of a score
SMALL, BLOCK = 16, 1024
ROWS = 128  # vectors decoded at once
SEED = 11


class Code:
    """One product code over the components [0, ``dim``) after a rotation."""

    def __init__(self, dim: int, blocks: int, words: int, seed: int):
        self.size = max(8, 1 << (dim - 1).bit_length())
        rng = np.random.default_rng([SEED, dim, blocks, words, seed])
        self.signs = rng.choice(np.array([-1, 1], np.float32), (2, self.size))
        self.order = rng.permutation(self.size)
        self.cuts = np.array_split(np.arange(self.size), blocks)
        self.words = []
        for own in self.cuts:
            w = rng.standard_normal((len(own), words))
            w *= math.sqrt(len(own) / self.size) / np.sqrt((w * w).sum(0))
            self.words.append(w.astype(np.float32))

    def rotated(self, x: np.ndarray) -> np.ndarray:
        for g in self.signs:
            x = x[:, self.order] * g
            half = 1
            while half < self.size:
                pairs = x.reshape(len(x), -1, 2, half)
                a, b = pairs[:, :, 0], pairs[:, :, 1]
                x = np.stack([a + b, a - b], axis=2).reshape(len(x), self.size)
                half *= 2
            x = x / np.float32(math.sqrt(self.size))
        return x

    def scores(self, x: np.ndarray) -> list[np.ndarray]:
        y = self.rotated(x)
        return [y[:, own] @ w for own, w in zip(self.cuts, self.words)]


def decode(scores: list[np.ndarray], height: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, direction (number) and score of all directions of at least
    ``height``, for every row of the blocks' scores."""
    n, words = scores[0].shape
    best = [s.max(axis=1).astype(float) for s in scores]
    rest = np.sum(best, axis=0)  # what the blocks to come can add
    row, key, total = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
    for s, most in zip(scores, best):
        rest = rest - most
        need = height - rest[row] - total
        weakest = np.full(n, np.inf)
        np.minimum.at(weakest, row, need)
        r, c = np.nonzero(s >= weakest[:, None])
        v = s[r, c].astype(float)
        order = np.lexsort((v, r))
        r, c, v = r[order], c[order], v[order]
        place = np.searchsorted(r * 8.0 + v, row * 8.0 + np.clip(need, -3, 3))
        times = np.searchsorted(r, row, side="right") - place
        at = np.repeat(place, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        row, key, total = np.repeat(row, times), np.repeat(key, times) * words + c[at], np.repeat(total, times) + v[at]
    return row, key, total


class Filters:
    """The codes and the height for ``n`` vectors of one length."""

    def __init__(self, dim: int, n: int, least: float):
        share = SHARE * max(1, n) / CODES
        self.blocks = 2
        while share ** (1 / self.blocks) > MOST_WORDS and self.blocks < 4:
            self.blocks += 1
        self.words = max(LEAST_WORDS, math.ceil(share ** (1 / self.blocks)))
        self.codes = [Code(dim, self.blocks, self.words, seed) for seed in range(CODES)]
        self.size = self.codes[0].size
        self.height = self._height(dim, least)

    def padded(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.size), np.float32)
        out[:, : x.shape[1]] = x
        return out

    def _height(self, dim: int, least: float) -> float:
        """From each simulated pair's best shared direction."""
        rng = np.random.default_rng([SEED, dim])
        a, z = rng.standard_normal((2, TRIALS, dim))
        a /= np.sqrt((a * a).sum(1))[:, None]
        z -= (z * a).sum(1)[:, None] * a
        z /= np.maximum(np.sqrt((z * z).sum(1)), 1e-300)[:, None]
        b = least * a + math.sqrt(1 - least * least) * z
        reach = np.full(TRIALS, -1.0)
        low = math.sqrt(2 * math.log(max(2, CODES * self.words**self.blocks / 2000)) / self.size) * 0.85
        for code in self.codes:
            for i in range(0, TRIALS, ROWS):
                both = []
                for x in (a, b):
                    r, k, v = decode(code.scores(self.padded(x[i : i + ROWS])), low)
                    both.append((r * self.words**self.blocks + k, v))
                _, p, q = np.intersect1d(both[0][0], both[1][0], assume_unique=True, return_indices=True)
                shared = np.minimum(both[0][1][p], both[1][1][q])
                np.maximum.at(reach, i + both[0][0][p] // self.words**self.blocks, shared)
        reach.sort()
        return round(max(float(reach[MISS]), 0.0) - 1e-6, 6)

    def lists(self, x: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and 64-bit key of every filter that a row of ``x`` exceeds: its
        cap's height is lowered until there are ``LIST``."""
        none = np.zeros(0, np.int64)
        rows, keys = [none], [none]
        for i in range(0, len(x), ROWS):
            at, own = np.arange(i, min(i + ROWS, len(x))), self.padded(x[i : i + ROWS])
            height = self.height
            while len(at):
                row, key, score = (np.concatenate(c) for c in zip(*self._exceeded(own, dim, height)))
                found = np.bincount(row, minlength=len(at))
                done = (found >= LIST) | (height < -1)
                order = np.lexsort((key, -score, row))
                place = np.arange(len(row)) - np.repeat(np.cumsum(found) - found, found)
                # the height first asked for, or that of the last of LIST
                keep = order[done[row[order]] & ((score[order] >= self.height) | (place < LIST))]
                rows.append(at[row[keep]])
                keys.append(key[keep])
                at, own, height = at[~done], own[~done], height - STEP / math.sqrt(self.size)
        both = np.unique(np.stack([np.concatenate(rows), np.concatenate(keys)]), axis=1)
        return both[0], both[1]

    def _exceeded(self, own: np.ndarray, dim: int, height: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for number, code in enumerate(self.codes):
            r, k, v = decode(code.scores(own), height)
            mixed = mix64(k.astype(np.uint64) + mix64(np.array([dim * CODES + number + 1], np.uint64)))
            yield r, mixed.view(np.int64), v


@functools.lru_cache(maxsize=4)
def filters_for(dim: int, n: int, least: float) -> Filters:
    return Filters(dim, n, least)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def packed(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, digest, dim and vec (little-endian doubles) of every row; the last
    three are null where the vector takes no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            vecs = []
            for v in b.column("v"):
                own = None if v.values is None else v.values.to_numpy(zero_copy_only=False)
                ok = own is not None and np.isfinite(own).all() and own.any()
                vecs.append((own.astype("<f8") + 0.0).tobytes() if ok else None)
            digests = [None if v is None else hashlib.blake2b(v, digest_size=16).digest() for v in vecs]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id"),
                    pa.array(digests, pa.large_binary()),
                    pa.array([None if v is None else len(v) // 8 for v in vecs], pa.int32()),
                    pa.array(vecs, pa.large_binary()),
                ],
                names=["id", "digest", "dim", "vec"],
            )

    own = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    id_type = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {id_type}, digest binary, dim int, vec binary")


def _matrix(vecs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), -1)


def filter_lists(classes: DataFrame, n: int, least: float) -> DataFrame:
    """key and node for every filter that a class's vector exceeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, nodes = b.column("dim").to_numpy(), b.column("node").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                own = filters_for(dim, n, least)
                for i in range(0, len(at), 1024):
                    part = at[i : i + 1024]
                    vecs = b.column("vec").take(pa.array(part)).to_pylist()
                    rows, keys = own.lists(unit(_matrix(vecs)), dim)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes[part][rows])], names=["key", "node"])

    return classes.select("node", "dim", "vec").mapInArrow(run, "key long, node long")


def linked_pairs(few: DataFrame, ends: DataFrame, least: float) -> DataFrame:
    """a, b and their weights wa, wb: the linked ones among the pairs of rows
    (key, node) with one key that share no large filter."""
    left, right = few.select("key", F.col("node").alias("a")), few.select("key", F.col("node").alias("b"))
    pairs = left.join(right, "key").where("a < b").select("a", "b").distinct()
    for c in ("a", "b"):
        side = ends.select(F.col("node").alias(c), F.col("vec").alias(f"v{c}"), F.col("w").alias(f"w{c}"), F.col("large").alias(f"l{c}"))
        pairs = pairs.join(side, c)
    pairs = pairs.where(~F.arrays_overlap("la", "lb")).select("a", "b", "wa", "wb", "va", "vb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                va, vb = part.column("va").to_pylist(), part.column("vb").to_pylist()
                ok = np.zeros(len(va), bool)
                size = np.array([len(x) if len(x) == len(y) else 0 for x, y in zip(va, vb)])
                for s in np.unique(size[size > 0]):
                    at = np.flatnonzero(size == s)
                    x, y = (unit(_matrix([v[k] for k in at])) for v in (va, vb))
                    ok[at] = (x * y).sum(axis=1) >= least
                yield part.select(["a", "b", "wa", "wb"]).filter(pa.array(ok))

    return pairs.mapInArrow(run, "a long, b long, wa long, wb long")


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """(first, other) of every row and the first row of its component."""
    open_, out = np.ones(len(linked), bool), []
    for i in range(len(linked)):
        if not open_[i]:
            continue
        open_[i] = False
        front = np.array([i])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & open_)
            open_[front] = False
            out += [(i, j) for j in front.tolist()]
    return out


def tile(key: int, side: np.ndarray, nodes: np.ndarray, w: np.ndarray, x: np.ndarray, large: list[list[int]], least: float):
    """Numbers of links (by row, from the other side's weights) that are
    counted in this filter, and the forest over all links of the tile."""
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    edges = forest(linked)
    before = [[k for k in own if k < key] for own in large]
    names = {k: i for i, k in enumerate(sorted({k for own in before for k in own}))}
    holds = np.zeros((len(x), len(names)), np.float32)
    for i, own in enumerate(before):
        holds[i, [names[k] for k in own]] = 1
    counted = linked & (holds @ holds.T == 0) if names else linked
    if side.any() and not side.all():  # two blocks: only links across them
        counted = counted & (side[:, None] != side[None])
    return counted @ w, edges


def large_links(many: DataFrame, ends: DataFrame, least: float, block: int) -> DataFrame:
    """a, b and n: links a - b that span the components within the filters
    (n is null), and the numbers n of links counted for a (b is null). Rows of
    ``many`` are key, node and c, the filter's number of vectors."""
    blocks = F.ceil(F.col("c") / block).cast("int")
    part = F.pmod(F.xxhash64("node", "key"), blocks).cast("int")
    dealt = many.select("key", "node", part.alias("part"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select(
        "key", "node", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), (F.col("part") > F.col("other")).alias("side")
    )
    dealt = dealt.join(ends, "node")
    order = ["key", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            own = sorted(held, key=lambda r: (len(r[6]), r[1]))
            a, b, n = [], [], []
            for size in sorted({len(r[6]) for r in own}):  # lengths differ only where keys' hashes meet
                same = [r for r in own if len(r[6]) == size]
                nodes, w = [r[1] for r in same], np.array([r[5] for r in same], np.int64)
                side = np.array([r[4] for r in same], bool)
                links, edges = tile(same[0][0], side, nodes, w, unit(_matrix([r[6] for r in same])), [r[7] for r in same], least)
                a += [nodes[i] for i, _ in edges] + nodes
                b += [nodes[j] for _, j in edges] + [None] * len(nodes)
                n += [None] * len(edges) + links.tolist()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, n)], names=["a", "b", "n"])

        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                cols = [part.column(c).to_pylist() for c in ("key", "node", "lo", "hi", "side", "w", "vec", "large")]
                for r in zip(*cols):
                    if held and (held[0][0], held[0][2], held[0][3]) != (r[0], r[2], r[3]):
                        yield done()
                        held.clear()
                    held.append(r)
        if held:
            yield done()

    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long, n long")


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95, small: int = SMALL, block: int = BLOCK
) -> DataFrame:
    """``id_col``, n_links (other vectors linked directly), component_id
    (smallest id reachable) and kept, one row per row of ``df``."""
    if not (0 < least <= 1 and small >= 1 and block >= 1):
        raise ValueError("least must be in (0, 1], small and block positive")
    spark = df.sparkSession
    own = written(spark, packed(df, id_col, vec_col), "packed")
    ids = own.where("digest IS NOT NULL").select("digest", "id").distinct().groupBy("digest")
    sizes = ids.agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w"))
    vecs = own.where("digest IS NOT NULL").groupBy("digest").agg(F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    # the number a class gets holds from here on, as the table is written
    classes = written(spark, vecs.join(sizes, "digest").withColumn("node", F.monotonically_increasing_id()), "classes")
    lists = written(spark, filter_lists(classes, classes.count(), least), "filters")
    shared = lists.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    rows = written(spark, small_join(lists, written(spark, shared, "shared", slim=True), ["key"], "inner"), "rows")
    few, many = rows.where(F.col("c") <= small), rows.where(F.col("c") > small)
    # a class's list is as long as its filters are many, whatever the table
    large = many.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("large"))
    involved = rows.select("node").distinct().join(large, "node", "left")
    ends = classes.select("node", "vec", "w").join(involved, "node")
    ends = written(spark, ends.withColumn("large", F.coalesce("large", F.array().cast("array<long>"))), "ends")
    pairs = written(spark, linked_pairs(few, ends, least), "pairs")
    groups = written(spark, large_links(many, ends, least, block), "groups")
    counts = pairs.select(F.col("a").alias("node"), F.col("wb").alias("n"))
    counts = counts.unionByName(pairs.select(F.col("b").alias("node"), F.col("wa").alias("n")))
    counts = counts.unionByName(groups.where("b IS NULL").select(F.col("a").alias("node"), "n"))
    counts = counts.groupBy("node").agg(F.sum("n").alias("n"))
    links = pairs.select("a", "b").unionByName(groups.where("b IS NOT NULL").select("a", "b"))
    roots = components(spark, written(spark, links.distinct().toDF("u", "v"), "links", slim=True))
    rooted = classes.select("digest", "node", "rep", "w").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = rooted.join(smallest, "root").join(counts, "node", "left")
    found = found.select("digest", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = small_join(own.select("id", "digest"), written(spark, found, "found", slim=True), ["digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def op13_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_cap_filters": op13_cap_filters}
ORACLES: dict[str, str] = {}
