"""Grouping of spelling variants.

Words are counted over all texts; the frequent ones are compared. Two words
are near if one insertion, deletion or replacement of a code point makes one
of the other. Each word points to its near word of largest count, if that is
at least ``ratio`` times its own, and following these leads to a root.

Near words are found by asymmetric q-chunks. The longer word of a pair (either
one of equal lengths) gives two disjoint chunks, its first and its last
``length div 2`` code points. One edit leaves a chunk as it is, so the other
word has it among its positional grams, in the same place or one before. The
other word may be as long or one shorter, which fixes the grams' length, and a
gram in a place that no chunk can reach is left out at once. Chunks and grams
join on their hash, and every pair met is verified on the words.

A chunk that many words share would make the square of their number. So where
chunks and grams of a key would make more than ``most`` pairs a row, the key
is made finer: what the two words do not share yet still holds at most one
edit, so of its two halves one is the same again and joins the key. That goes
on down to a single open place, where at most as many words meet as there are
letters. Pairs stay in proportion to words, and none is lost. A pair whose
chunks, or halves, are both the same counts where the first one is.

Defined results: null texts have no words; a null id counts as an empty one;
repeated rows are counted as often as they occur; other columns are ignored;
an empty table, or one without frequent words, gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import string_buffers, table, written

# Latin letters as UTF-8: U+00C0 to U+00FF are C3 80 to C3 BF.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
NO_RUN = re.compile(rb"[^A-Za-z\x80-\xff]")
SLICE_BYTES = 1 << 20
FLUSH_BYTES = 1 << 24
TYPO_EVERY = 97
MIN_LENGTH, MIN_COUNT = 5, 3
MOST = 32  # pairs a row of a key
HOT = 50_000  # rows of a key that a join deals to one task


def slices(text: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of about ``SLICE_BYTES`` that cut no run."""
    at = 0
    while at < len(text):
        gap = NO_RUN.search(text, min(at + SLICE_BYTES, len(text)))
        end = gap.end() if gap else len(text)
        yield at, end
        at = end


def without_one(run: bytes, place: int) -> bytes:
    """``run`` without its code point at ``place`` modulo its length."""
    own = run.decode()
    place %= len(own)
    return (own[:place] + own[place + 1 :]).encode()


def count_words(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo_every: int | None = None, min_bytes: int = 1
) -> DataFrame:
    """word and n of all texts: runs of Latin letters, A-Z lower-cased. With
    ``typo_every``, a run whose hash with its document's id that number
    divides loses a code point first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        size = 0

        def rows() -> pa.RecordBatch:
            keys = pa.array(held.keys(), pa.large_binary()).view(pa.large_string())
            return pa.RecordBatch.from_arrays([keys, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            starts = b.column("start").to_pylist()
            for i in range(b.num_rows):
                text, start = raw[offs[i] : offs[i + 1]].tobytes(), zlib.crc32(starts[i].encode())
                for s, e in slices(text):
                    for word, n in Counter(RUN.findall(text[s:e].lower())).items():
                        if typo_every and not (h := zlib.crc32(word, start)) % typo_every:
                            word = without_one(word, h)
                        if len(word) >= min_bytes:
                            if word not in held:
                                size += len(word) + 150
                            held[word] += n
                    if size > FLUSH_BYTES:
                        yield rows()
                        held.clear()
                        size = 0
        if held:
            yield rows()

    start = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("start")
    counted = df.select(start, F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _piece(word: str, begin: Column, end: Column) -> Column:
    """Code points [begin, end) of the column ``word``."""
    return F.substr(F.col(word), begin + 1, end - begin)


def chunks(words: DataFrame) -> DataFrame:
    """key, x, n_x and the open range [a, b) of x beside a chunk."""
    size = F.char_length("word").alias("size")
    own = words.select(F.col("word").alias("x"), F.col("n").alias("n_x"), size)
    q, zero = F.expr("size div 2"), F.lit(0)
    first = F.struct(F.xxhash64("size", zero, _piece("x", zero, q)).alias("key"), q.cast("int").alias("a"), F.col("size").alias("b"))
    last = F.struct(
        F.xxhash64("size", F.lit(1), _piece("x", F.col("size") - q, F.col("size"))).alias("key"),
        zero.alias("a"),
        q.cast("int").alias("b"),
    )
    return own.select("x", "n_x", F.explode(F.array(first, last)).alias("c")).select("c.key", "x", "n_x", "c.a", "c.b")


def grams(words: DataFrame) -> DataFrame:
    """key, y, n_y, the open range [a, b) of a partner, and d, the number of
    code points that the partner is longer."""
    size = F.char_length("word")
    d = F.explode(F.array(F.lit(0), F.lit(1))).alias("d")
    own = words.select(F.col("word").alias("y"), F.col("n").alias("n_y"), size.alias("own"), d)
    own = own.withColumn("size", F.col("own") + F.col("d")).where("own >= size div 2")
    q, zero = F.expr("size div 2"), F.lit(0)
    first = F.struct(F.xxhash64("size", zero, _piece("y", zero, q)).alias("key"), q.cast("int").alias("a"), F.col("size").alias("b"))
    last = F.struct(
        F.xxhash64("size", F.lit(1), _piece("y", F.col("own") - q, F.col("own"))).alias("key"),
        zero.alias("a"),
        q.cast("int").alias("b"),
    )
    return own.select("y", "n_y", "d", F.explode(F.array(first, last)).alias("c")).select("c.key", "y", "n_y", "d", "c.a", "c.b")


def finer(rows: DataFrame, word: str, shift: Column) -> DataFrame:
    """Each row twice: the open range's first half the same, or its second.
    ``shift`` is how far the word's code points after the edit lie earlier."""
    middle = F.expr("(a + b) div 2").cast("int")
    first = F.struct(
        F.xxhash64("key", F.lit(0), _piece(word, F.col("a"), middle)).alias("key"), middle.alias("a"), F.col("b").alias("b")
    )
    second = F.struct(
        F.xxhash64("key", F.lit(1), _piece(word, middle - shift, F.col("b") - shift)).alias("key"),
        F.col("a").alias("a"),
        middle.alias("b"),
    )
    others = [c for c in rows.columns if c not in ("key", "a", "b")]
    both = rows.select(*others, F.explode(F.array(first, second)).alias("c"))
    return both.select("c.key", *others, "c.a", "c.b")


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """x, n_x, y, n_y of all near words (word, n), each pair once."""
    spark = words.sparkSession
    left, right, found = chunks(words), grams(words), []
    while True:
        load = left.groupBy("key").agg(F.count(F.lit(1)).alias("l"), F.first(F.col("b") - F.col("a")).alias("open"))
        load = load.join(right.groupBy("key").agg(F.count(F.lit(1)).alias("r")), "key")
        crowded = F.col("l").cast("double") * F.col("r") > most * (F.col("l") + F.col("r"))
        load = load.select("key", (crowded & (F.col("open") > 1)).alias("again"), (F.col("l") + F.col("r")).alias("rows"))
        load = written(spark, load, "load", slim=True)
        # the few keys with very many rows never meet in a task: their rows are found by a broadcast of at most rows / HOT keys
        hot = F.broadcast(load.where(F.col("again") & (F.col("rows") > HOT)).select("key"))
        others = load.where(~F.col("again") | (F.col("rows") <= HOT))
        cool = [side.join(hot, "key", "left_anti") for side in (left, right)]
        met = [side.join(others.where("NOT again").select("key"), "key") for side in cool]
        met = met[0].join(met[1].select("key", "y", "n_y", "d"), "key")
        # both chunks, or halves, may be the same: the pair counts where the first one is
        first = (F.col("b") == F.char_length("x")) | (F.substr("x", F.lit(1), F.col("b")) != F.substr("y", F.lit(1), F.col("b")))
        near = ((F.col("d") == 1) | (F.col("x") < F.col("y"))) & first & (F.levenshtein("x", "y", 1) == 1)
        found.append(written(spark, met.where(near).select("x", "n_x", "y", "n_y"), "near"))
        if load.where("again").isEmpty():
            break
        again = [side.join(others.where("again").select("key"), "key") for side in cool]
        again = [a.unionByName(side.join(hot, "key", "left_semi")) for a, side in zip(again, (left, right))]
        left = written(spark, finer(again[0], "x", F.lit(0)), "chunks")
        right = written(spark, finer(again[1], "y", F.col("d")), "grams")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form: pointers are doubled until
    all are at words without one. A chain's counts grow by a factor at every
    step, so its length is bounded by the logarithm of the largest count."""
    state = written(spark, forms.select("word", F.col("form").alias("root")), "roots", slim=True)
    while True:
        to = state.select(F.col("word").alias("root"), F.col("root").alias("to"))
        # a plain join: a root's rows are few beside a task's, and copies of a side would outweigh the words
        moved = state.join(to, "root", "left")
        moved = moved.select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved"))
        moved = written(spark, moved, "roots", slim=True)
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def variants(words: DataFrame, ratio: float = 2, most: int = MOST) -> DataFrame:
    """word, n, n_near (number of near words), form (the near word that it
    points to, or null), form_n and root of every row of ``words`` (distinct
    word, n)."""
    if ratio <= 1:
        raise ValueError("ratio must be above 1: chains of forms would not end")
    spark = words.sparkSession
    words = written(spark, words.select("word", "n"), "words")
    pairs = near_pairs(words, most)
    one = pairs.select(F.col("x").alias("word"), F.col("n_x").alias("n"), F.col("y").alias("near"), F.col("n_y").alias("m"))
    two = pairs.select(F.col("y").alias("word"), F.col("n_y").alias("n"), F.col("x").alias("near"), F.col("n_x").alias("m"))
    best = one.unionByName(two).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near"))).alias("b"), F.first("n").alias("n")
    )
    points = -F.col("b.m") >= F.lit(ratio) * F.col("n")
    best = best.select("word", "n_near", F.when(points, F.col("b.near")).alias("form"), F.when(points, -F.col("b.m")).alias("form_n"))
    best = written(spark, best, "forms", slim=True)
    root = roots(spark, best.where("form IS NOT NULL"))
    out = words.join(best, "word", "left").join(root, "word", "left")
    return out.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_words(table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY, min_bytes=MIN_LENGTH)
    found = variants(counted.where((F.col("n") >= MIN_COUNT) & (F.char_length("word") >= MIN_LENGTH)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op12_spelling_variants": op12_spelling_variants}
ORACLES: dict[str, str] = {}
