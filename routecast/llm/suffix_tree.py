"""Scoring texts with a probabilistic suffix tree.

A text is the sequence of its lower-cased words and an end. The model spells
it out: the bytes of each word, a blank after each, a line end for the end;
``DEPTH`` line ends stand before the first. Symbols are bytes and contexts the
up to ``DEPTH`` bytes before one, so every text has a probability, whatever
its words.

Counts of all (context, symbol) pairs of the training texts are summed by
Spark, the longest order from the texts and each shorter one from the order
above; every pair stays. A context is retained when its pairs gain enough over
its longest retained suffix: count times Kullback-Leibler divergence above the
cost of its parameters, ``distinct / 2 * ln(count)``. A retained context's
distribution is smoothed with its suffix's by the Witten-Bell rule, where
``distinct`` pseudo counts go to the suffix; the empty context has a uniform
share of ``ALPHA`` a byte. A symbol is scored by the longest retained context
before it. (``least_share`` leaves out pairs below that relative frequency, for
a smaller tree; their counts go to the suffix, too. It is 0 unless given.)

The tree stays a table. A pair of the longest order that was learned has its
final probability there. The pairs that make up at least ``HEAD_SHARE`` of all
symbols each, at most 1 / ``HEAD_SHARE`` of them, are broadcast; the others
that a text holds are joined with the table, and pairs that were never learned
go down the orders, once each, by joins as well.

The base score needs the count of every word. The words that make up at least
``HEAD_SHARE`` of all tokens each, at most 1 / ``HEAD_SHARE`` of them, are
broadcast; the others' counts come by a join on the word's 64-bit hash, for
the words of each text that are not among them.

Defined results: null text is empty, that is, the end alone; a null id trains;
with nothing to learn from all symbols are equally likely; every input row
gives one row, repeated rows included; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import bucket_of_id, lowered, mix64, row_slices, string_buffers, table, word_hashes, words, written

DEPTH = 5
LEAST_SHARE = 0.0
ALPHA = 0.1
HEAD_SHARE = 1e-7
SLICE_BYTES = 1 << 20
FLUSH = 1 << 19  # distinct keys a task holds before it hands them on; Spark adds up the rest before the shuffle
END, BLANK = 10, 32
END_HASH = int(mix64(np.array([0xE0D], np.uint64)).view(np.int64)[0])
WORD = DEPTH + 1  # the "order" that word counts have in the table of counts


def spell(low: np.ndarray, s: np.ndarray, e: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (``DEPTH`` bytes before, byte) for every symbol of ``n`` texts,
    and the texts' indices, in order."""
    length = e - s
    per_doc = np.bincount(doc, weights=length + 1, minlength=n).astype(np.int64)
    ends = np.cumsum(per_doc + DEPTH + 1)
    begins = ends - per_doc - DEPTH - 1
    out = np.full(ends[-1] if n else 0, BLANK, np.uint8)
    for k in range(DEPTH):
        out[begins + k] = END
    out[ends - 1] = END
    before = np.cumsum(length + 1) - length - 1  # bytes of all words before
    at = before + (doc + 1) * DEPTH + doc
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(at, length) + within] = low[np.repeat(s, length) + within]
    wide = out.astype(np.uint64)
    codes = wide[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        codes |= wide[DEPTH - k : len(wide) - k] << np.uint64(8 * k)
    index = np.repeat(np.arange(n), per_doc + DEPTH + 1)[DEPTH:]
    place = np.arange(DEPTH, len(out)) - begins[index]
    real = place >= DEPTH
    return codes[real], index[real]


class _Sums:
    """Counts by key, merged as they come."""

    def __init__(self):
        self.keys, self.n, self.held = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.n.append(n)
        self.held += len(k)
        if self.held > FLUSH and len(self.keys) > 1:
            k, n = self.take()
            self.keys, self.n, self.held = [k], [n], len(k)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k, n = np.concatenate(self.keys), np.concatenate(self.n)
        self.keys, self.n, self.held = [], [], 0
        order = np.argsort(k, kind="stable")  # runs in order already: a merge
        k, n = k[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        return k[first], np.add.reduceat(n, first)


def count(df: DataFrame, text_col: str) -> DataFrame:
    """order, key and n: pairs of the longest order, and words (order
    ``WORD``), over all texts."""

    def rows(order: int, sums: _Sums) -> Iterator[pa.RecordBatch]:
        k, n = sums.take()
        for i in range(0, len(k), 1 << 16):
            own = k[i : i + (1 << 16)].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), order, np.int32)), pa.array(own), pa.array(n[i : i + (1 << 16)])],
                names=["order", "key", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, tokens, docs = _Sums(), _Sums(), 0
        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            docs += b.num_rows
            for i, j in row_slices(offs, SLICE_BYTES):
                low = lowered(raw[offs[i] : offs[j]])
                s, e, doc = words(low, offs[i : j + 1] - offs[i])
                grams.add(spell(low, s, e, doc, j - i)[0])
                tokens.add(word_hashes(low, s, e))
                for order, sums in ((DEPTH, grams), (WORD, tokens)):
                    if sums.held > FLUSH:
                        yield from rows(order, sums)
        if docs:
            yield from rows(DEPTH, grams)
            yield from rows(WORD, tokens)
            end = [pa.array([x], t) for x, t in ((WORD, pa.int32()), (END_HASH, pa.int64()), (docs, pa.int64()))]
            yield pa.RecordBatch.from_arrays(end, names=["order", "key", "n"])

    counted = df.select(F.col(text_col).alias("text")).mapInArrow(run, "order int, key long, n long")
    return counted.groupBy("order", "key").agg(F.sum("n").alias("n"))


class Tree(NamedTuple):
    """Per order from 1: pairs (key, n, lp: log10 of the final probability)
    and the log10 weight of the suffix of retained contexts (context, w). Of
    order 0, log10 of every byte's probability. And the symbols learned."""

    pairs: list[DataFrame]
    contexts: list[DataFrame]
    empty: np.ndarray
    total: int


def _numpy(df: DataFrame, cols: list[str]) -> list[np.ndarray]:
    """Columns of a table of bounded size, in order of the first."""
    t = df.select(*cols).toArrow()
    out = [t.column(c).to_numpy() for c in cols]
    order = np.argsort(out[0], kind="stable")
    return [x[order] for x in out]


def _mask(order: int) -> int:
    return (1 << (8 * (order + 1))) - 1


def grow(spark: SparkSession, longest: DataFrame, least_share: float = LEAST_SHARE) -> Tree:
    """The tree of pair counts (key, n) of order ``DEPTH``."""
    orders = [longest.select("key", "n")]
    for d in range(DEPTH - 1, -1, -1):
        shorter = orders[0].groupBy(F.col("key").bitwiseAND(F.lit(_mask(d))).alias("key")).agg(F.sum("n").alias("n"))
        orders.insert(0, written(spark, shorter, "pairs"))
    total = orders[0].agg(F.sum("n")).first()[0] or 0
    p0 = np.full(256, ALPHA / (total + 256 * ALPHA))
    for r in orders[0].collect():  # at most 256 rows
        p0[r.key] = (r.n + ALPHA) / (total + 256 * ALPHA)
    share = orders[0].withColumn("p", (F.col("n") + ALPHA) / (total + 256 * ALPHA)).select("key", "p")
    pairs, contexts = [], []
    for d in range(1, DEPTH + 1):
        suffix = F.col("key").bitwiseAND(F.lit(_mask(d - 1)))
        own = orders[d].withColumns({"context": F.shiftrightunsigned("key", 8), "suffix": suffix})
        own = own.join(share.withColumnsRenamed({"key": "suffix", "p": "p_suffix"}), "suffix", "left")
        keep = F.col("n") >= F.lit(least_share * total)
        stats = own.groupBy("context").agg(
            F.sum("n").alias("total"),
            F.sum(F.when(keep, F.col("n"))).alias("held"),
            F.count_if(keep).alias("distinct"),
            F.sum(F.when(keep, F.col("n") * F.ln("n"))).alias("n_ln_n"),
            F.sum(F.when(keep, F.col("n") * F.ln("p_suffix"))).alias("n_ln_p"),
            F.least(F.sum(F.when(keep, F.col("p_suffix"))), F.lit(1 - 1e-12)).alias("p_held"),
        )
        stats = stats.withColumn("rest", F.col("total") - F.col("held"))
        rest = F.when(F.col("rest") > 0, F.col("rest") * (F.ln("rest") - F.ln(1 - F.col("p_held")))).otherwise(0.0)
        gain = F.col("n_ln_n") + rest - F.col("total") * F.ln("total") - F.col("n_ln_p")
        # null where the context isn't retained
        pseudo = F.when(gain > F.col("distinct") / 2 * F.ln(F.col("total") + 1), F.col("distinct") + F.col("rest"))
        stats = stats.select("context", (F.col("total") + F.col("distinct")).alias("all"), pseudo.alias("pseudo"))
        smoothed = (F.col("n") + F.col("pseudo") * F.col("p_suffix")) / F.col("all")
        level = own.where(keep).join(stats, "context").withColumn("p", F.coalesce(smoothed, "p_suffix"))
        weight = F.log10(F.col("pseudo") / F.col("all"))
        level = written(spark, level.select("key", "n", "p", weight.alias("w")), "level")
        share = level.select("key", "p")
        pairs.append(level.select("key", "n", F.log10("p").alias("lp")))
        context = F.shiftrightunsigned("key", 8).alias("context")
        contexts.append(level.where("w IS NOT NULL").groupBy(context).agg(F.first("w").alias("w")))
    return Tree(pairs, contexts, np.log10(p0), total)


def unseen(spark: SparkSession, tree: Tree, codes: DataFrame) -> DataFrame:
    """key and lp of distinct codes (key) that the longest order doesn't hold:
    the weights of the retained contexts on the way to the longest order that
    holds the pair, and its probability there."""
    empty = F.array(*[F.lit(float(x)) for x in tree.empty])
    out = codes.select("key", F.lit(None).cast("double").alias("lp"), F.lit(0.0).alias("above"))
    for d in range(DEPTH, 0, -1):
        if d < DEPTH:
            own = tree.pairs[d - 1].select(F.col("key").alias("pair"), F.col("lp").alias("own"))
            out = out.join(own, F.col("key").bitwiseAND(F.lit(_mask(d))) == F.col("pair"), "left")
            out = out.select("key", F.coalesce("lp", F.col("above") + F.col("own")).alias("lp"), "above")
        context = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit(_mask(d - 1)))
        out = out.join(tree.contexts[d - 1], context == F.col("context"), "left")
        out = out.select("key", "lp", (F.col("above") + F.coalesce("w", F.lit(0.0))).alias("above"))
    last = F.get(empty, F.col("key").bitwiseAND(F.lit(255)).cast("int"))
    return out.select("key", F.coalesce("lp", F.col("above") + last).alias("lp"))


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def text_scores(
    head: tuple[np.ndarray, np.ndarray], codes: np.ndarray, index: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sum of the log probabilities of each text's codes that ``head`` holds,
    and for the others text, code and number, in order of text: equal symbols
    of a text are looked up once."""
    both = (index.astype(np.uint64) << np.uint64(48)) | codes
    both.sort()
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    times = np.diff(np.append(first, len(both)))
    own = both[first]
    code, doc = (own & np.uint64((1 << 48) - 1)).astype(np.int64), (own >> np.uint64(48)).astype(np.int64)
    at, known = _find(head[0], code)
    lp = np.where(known, head[1][at], 0.0) if len(head[0]) else np.zeros(len(code))
    rare = ~known
    return np.bincount(doc, weights=lp * times, minlength=n), doc[rare], code[rare], times[rare]


class Model(NamedTuple):
    tree: Tree
    vocabulary: DataFrame  # key, n of every training token
    head: tuple[np.ndarray, np.ndarray]  # the frequent ones
    head_pairs: tuple[np.ndarray, np.ndarray]  # key and lp of the frequent pairs of the longest order
    tokens: int
    distinct: int


def train(df: DataFrame, text_col: str = "text", head_share: float = HEAD_SHARE, least_share: float = LEAST_SHARE) -> Model:
    spark = df.sparkSession
    counts = written(spark, count(df, text_col), "counts")
    vocabulary = counts.where(F.col("order") == WORD).select("key", "n")
    tree = grow(spark, counts.where(F.col("order") == DEPTH), least_share)
    row = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    keys, n = _numpy(vocabulary.where(F.col("n") >= head_share * (row.n or 0)), ["key", "n"])
    often = tree.pairs[-1].where(F.col("n") >= head_share * tree.total)
    return Model(tree, vocabulary, (keys, n), tuple(_numpy(often, ["key", "lp"])), row.n or 0, row.v)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, n_known, train_tokens, base_score and score of
    every row."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((model.head_pairs, *model.head))

    def lists(doc: np.ndarray, m: int, *values: np.ndarray) -> list[pa.Array]:
        cut = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=m))]).astype(np.int32))
        return [pa.ListArray.from_arrays(cut, pa.array(v.astype(np.int64))) for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, keys, n = shared.value
        logs = np.log10(n + 0.1)
        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            for i, j in row_slices(offs, SLICE_BYTES):
                m = j - i
                low = lowered(raw[offs[i] : offs[j]])
                s, e, doc = words(low, offs[i : j + 1] - offs[i])
                # the end is a token of every text
                h = np.concatenate([word_hashes(low, s, e).view(np.int64), np.full(m, END_HASH)])
                of = np.concatenate([doc, np.arange(m)])
                u, inverse = np.unique(h, return_inverse=True)
                at, known = _find(keys, u)
                lp = np.where(known, logs[at], 0.0) if len(keys) else np.zeros(len(u))
                base = np.bincount(of, weights=lp[inverse], minlength=m)
                n_known = np.bincount(of, weights=known[inverse], minlength=m).astype(np.int64)
                rare = ~known[inverse]
                pair, times = np.unique(np.stack([of[rare], inverse[rare]]), axis=1, return_counts=True)
                codes, index = spell(low, s, e, doc, m)
                scores, *more = text_scores(head, codes, index, m)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("id").slice(i, m),
                        pa.array(np.bincount(of, minlength=m)),
                        pa.array(n_known),
                        pa.array(base),
                        pa.array(scores),
                        *lists(pair[0], m, u[pair[1]], times),
                        *lists(more[0], m, *more[1:]),
                    ],
                    names=["id", "n_tokens", "n_known", "base", "score", "rare", "times", "codes", "code_times"],
                )

    own = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (
        f"id {own.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, base double, score double, "
        "rare array<long>, times array<long>, codes array<long>, code_times array<long>"
    )
    scored = own.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    scored = written(spark, scored, "scored")  # ids and rows may repeat, row doesn't

    def listed(word: bool, keys: str, times: str) -> DataFrame:
        each = scored.select("row", F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(times).alias("times"))).alias("r"))
        return each.select("row", F.lit(word).alias("word"), F.col("r.key").alias("key"), F.col("r.times").alias("times"))

    rest = listed(True, "rare", "times").unionByName(listed(False, "codes", "code_times"))
    words_known = model.vocabulary.select(F.lit(True).alias("word"), "key", F.log10(F.col("n") + 0.1).alias("lp"))
    known = words_known.unionByName(model.tree.pairs[-1].select(F.lit(False).alias("word"), "key", "lp"))
    lp = F.coalesce("lp", F.lit(float(np.log10(0.1))))
    # the pairs never learned stay beside their text, so that the join runs once
    sums = rest.join(known, ["word", "key"], "left").groupBy("row").agg(
        F.sum(F.when(F.col("word") & F.col("lp").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.when(F.col("word"), F.col("times") * lp)).alias("more"),
        F.sum(F.when(~F.col("word"), F.col("times") * F.col("lp"))).alias("more_score"),
        F.collect_list(F.when(~F.col("word") & F.col("lp").isNull(), F.struct("key", "times"))).alias("lost"),
    )
    sums = written(spark, sums, "sums")
    lost = sums.select("row", F.explode("lost").alias("r")).select("row", "r.key", "r.times")
    found = written(spark, unseen(spark, model.tree, lost.select("key").distinct()), "unseen")
    lost = lost.join(found, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("lp")).alias("unseen_score"))
    out = scored.drop("rare", "times", "codes", "code_times").join(sums.drop("lost"), "row", "left").join(lost, "row", "left")
    z = float(np.log10(model.tokens + 0.1 * (model.distinct + 1)))
    none = F.lit(0.0)
    return out.select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", none) - F.col("n_tokens") * z).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", none) + F.coalesce("unseen_score", none)).alias("score"),
    )


def held_out(id_col: str) -> Column:
    return F.coalesce(bucket_of_id(id_col, 10) == 0, F.lit(False))


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs.where(~held_out("doc_id"))))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op2_suffix_tree": op2_suffix_tree}
ORACLES: dict[str, str] = {}
