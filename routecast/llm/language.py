"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point.
An n-gram of three letters (a run of other characters counts as one blank, and
texts begin and end with one) is bound by multiplying the first letter's
vector permuted twice, the second's permuted once, and the third's. A text's
vector is the sum over its n-grams; a language's prototype is the sum over its
training texts. A text takes the language whose prototype has the largest
cosine with it; ties go to the smaller language name. Sums are of whole
numbers, hence the same in any order. Texts longer than ``PIECE_BYTES`` are
summed up piece by piece and distinct n-grams are bound ``BLOCK`` at a time, so
memory follows neither the length of a text nor the size of its alphabet.

``confident`` compares a text's cosine with those of learned texts: quantile
sketches per language and class of length give the lower quartile, of which a
text has to reach ``BAR_SHARE``. A class with fewer than ``LEAST_LEARNED``
learned texts takes the quartile of its length over all languages, and no bar
where that has too few as well.

Prototypes are summed by Spark from one partial sum per task and language;
what reaches the driver is ``DIM`` numbers per language.

Defined results: null texts and texts without a letter get ``und`` and score
0, as does every text when nothing was learned; scores are the cosine, at
least 0; every input row gives one row, repeated rows and null ids included;
other columns pass through, also those named like the result's; an empty table
gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routecast.llm.common import bucket_of_id, fresh, mix64, row_slices, small_join, string_buffers, table, written

DIM = 2048
UNKNOWN = "und"
SLICE_BYTES = 1 << 18
PIECE_BYTES = 1 << 20
BLOCK = 2048
BAR_SHARE, LEAST_LEARNED, SKETCH_K = 0.15, 50, 800
LONGEST_CLASS = 12  # texts of 2^12 characters or more are one class

_letters: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Lower-case code point of each letter, 0 for other characters."""
    if "lut" not in _letters:
        lut = np.zeros(sys.maxunicode + 1, np.int32)
        for c in range(sys.maxunicode + 1):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                lut[c] = ord(low) if len(low) == 1 and low.isalpha() else c
        _letters["lut"] = lut
    return _letters["lut"]


def letter_vectors(points: np.ndarray, dim: int) -> np.ndarray:
    """+1/-1 vectors (int8) of code points; blank is point 0."""
    seed = points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, dim // 64 + 1, dtype=np.uint64)
    bits = np.unpackbits(mix64(mix64(seed)).view(np.uint8), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def trigrams(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code point of each letter of the texts laid end to end, the index of
    its text, and the places where an n-gram begins. Blanks are 0."""
    n = len(offs) - 1
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = (raw & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(lead)])[offs]
    low = letter_table()[points]
    # a blank before each text and after the last
    low = np.insert(low, at, 0)
    at = at + np.arange(n + 1)
    doc = np.searchsorted(at, np.arange(len(low)), side="right") - 1
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 0) | (low[:-1] != 0)  # runs of blanks become one
    low, doc = low[keep], doc[keep]
    return low, doc, np.arange(max(0, len(low) - 2))


def profiles(
    raw: np.ndarray, offs: np.ndarray, groups: np.ndarray, n_groups: int, dim: int, before: bool = False, after: bool = False
) -> np.ndarray:
    """Sum of n-gram vectors per group; ``groups`` names each text's. With
    ``before`` (``after``) the first (last) character is there for its
    neighbour's n-gram alone."""
    out = np.zeros((n_groups, dim))
    if len(offs) == 2 and len(raw) > 2 * PIECE_BYTES and not (before or after):
        for piece, first, last in pieces(raw):
            out += profiles(piece, np.array([0, len(piece)]), groups, n_groups, dim, not first, not last)
        return out
    low, doc, at = trigrams(raw, offs)
    # the blank that ends a text may be the one that begins the next: an
    # n-gram belongs to the text of its middle letter, and has one
    middle = low[1:-1] != 0
    if before and len(middle) and letter_table()[ord(_first(raw))]:
        middle[0] = False
    if after and len(middle) and letter_table()[ord(_last(raw))]:
        middle[-1] = False
    at = at[middle]
    if len(at) == 0:
        return out
    alphabet, code = np.unique(low, return_inverse=True)
    k = len(alphabet)
    grams, which = np.unique((code[at] * k + code[at + 1]) * k + code[at + 2], return_inverse=True)
    pairs, counts = np.unique(which * n_groups + groups[doc[at + 1]], return_counts=True)
    # whole numbers below 2^24 stay exact in single precision
    exact = np.float32 if len(at) < 1 << 24 else np.float64
    for i in range(0, len(grams), BLOCK):
        own = grams[i : i + BLOCK]
        letters, place = np.unique(np.concatenate([own // (k * k), own // k % k, own % k]), return_inverse=True)
        v, (x, y, z) = letter_vectors(alphabet[letters], dim), place.reshape(3, -1)
        bound = np.roll(v, 2, axis=1)[x] * np.roll(v, 1, axis=1)[y] * v[z]
        lo, hi = np.searchsorted(pairs, [i * n_groups, (i + len(own)) * n_groups])
        times = np.zeros((n_groups, len(own)), exact)
        times[pairs[lo:hi] % n_groups, pairs[lo:hi] // n_groups - i] = counts[lo:hi]
        out += times @ bound.astype(exact)
    return out


def _first(raw: np.ndarray) -> str:
    return raw[:4].tobytes().decode("utf-8", "ignore")[0]


def _last(raw: np.ndarray) -> str:
    return raw[-4:].tobytes().decode("utf-8", "ignore")[-1]


def pieces(raw: np.ndarray) -> Iterator[tuple[np.ndarray, bool, bool]]:
    """Pieces of a long text, each with one character more on both sides, and
    whether it is the first or the last."""
    start = lambda p: p - next(i for i in range(4) if p == i or p >= len(raw) or raw[p - i] & 0xC0 != 0x80)
    cuts = [0, *(start(p) for p in range(PIECE_BYTES, len(raw) - PIECE_BYTES, PIECE_BYTES)), len(raw)]
    for a, b in zip(cuts, cuts[1:]):
        first, last = a == 0, b == len(raw)
        end = b if last else next(b + i for i in range(1, 5) if b + i >= len(raw) or raw[b + i] & 0xC0 != 0x80)
        yield raw[a if first else start(a - 1) : end], first, last


def prototypes(df: DataFrame, text_col: str, lang_col: str, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their prototype vectors, from the rows of ``df``
    with a text and a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            langs = np.asarray(b.column("lang").to_pylist(), dtype=object)
            for i, j in row_slices(offs, SLICE_BYTES * 4):
                names, groups = np.unique(langs[i:j].astype(str), return_inverse=True)
                part = profiles(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i], groups, len(names), dim)
                for name, vec in zip(names.tolist(), part):
                    total[name] = total.get(name, 0) + vec
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.large_string()), pa.array([x.tolist() for x in total.values()], pa.list_(pa.float64()))],
            names=["lang", "profile"],
        )

    own = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    partial = own.mapInArrow(run, "lang string, profile array<double>")
    summed = partial.select("lang", F.posexplode("profile").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
    rows = summed.collect()  # DIM rows per language
    langs = sorted({r.lang for r in rows})
    out = np.zeros((len(langs), dim))
    for r in rows:
        out[langs.index(r.lang), r.d] = r.x
    known = np.abs(out).sum(axis=1) > 0
    return [x for x, k in zip(langs, known) if k], out[known]


def identify(
    df: DataFrame, langs: list[str], protos: np.ndarray, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns, unless given), then lang_pred and score; each gets
    an underscore more where ``df`` has such a column."""
    keep = list(df.columns) if keep is None else keep
    dim = protos.shape[1] if len(langs) else DIM
    unit = protos / np.linalg.norm(protos, axis=1, keepdims=True) if len(langs) else protos
    shared = df.sparkSession.sparkContext.broadcast(unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = shared.value
        for b in batches:
            raw, offs = string_buffers(b.column("_text"))
            pred, score = [], []
            for i, j in row_slices(offs, SLICE_BYTES, 256):
                vec = profiles(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i], np.arange(j - i), j - i, dim)
                norm = np.linalg.norm(vec, axis=1)
                if len(langs):
                    cos = vec @ unit.T / np.maximum(norm, 1e-300)[:, None]
                    best = np.argmax(cos, axis=1)
                    top = np.clip(cos[np.arange(j - i), best], 0, 1)
                else:
                    best, top, norm = np.zeros(j - i, int), np.zeros(j - i), np.zeros(j - i)
                pred += [langs[k] if n else UNKNOWN for k, n in zip(best, norm)]
                score += np.where(norm > 0, top, 0.0).tolist()
            own = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(pred, pa.large_string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"]
            )

    names = [f"c{i}" for i in range(len(keep))]
    own = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("_text"))
    schema = T.StructType(
        [own.schema[n] for n in names] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    out = own.mapInArrow(run, schema)
    found = [F.col(c).alias(fresh(df, c)) for c in ("lang_pred", "score")]
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], *found)


def confident(found: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``found`` (with lang_pred and score, and no column whose name
    begins with ``bar_``) whose cosine reaches the bar of their language and
    length. ``found`` is read twice."""
    spark = found.sparkSession
    size = F.floor(F.log2(F.greatest(F.length(text_col), F.lit(1)))).cast("int")
    rows = found.where(F.col("lang_pred") != UNKNOWN)
    rows = rows.withColumn("bar_size", F.least(size, F.lit(LONGEST_CLASS)))
    learned = rows.where(F.col(lang_col).isNotNull()).groupBy(F.col("lang_pred").alias("bar_lang"), "bar_size")
    own = learned.agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("score", F.lit(SKETCH_K)).alias("sketch"))
    own = written(spark, own, "bars", slim=True)
    over = own.groupBy("bar_size").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))

    def bar(df: DataFrame, name: str, *keys: str) -> DataFrame:
        quartile = F.kll_sketch_get_quantile_double("sketch", F.lit(0.25))
        enough = df.where(F.col("n") >= LEAST_LEARNED).select(*keys, (BAR_SHARE * quartile).alias(name))
        return written(spark, enough, "bars", slim=True)

    own = bar(own, "bar_own", "bar_lang", "bar_size")
    rows = small_join(rows.withColumn("bar_lang", F.col("lang_pred")), own, ["bar_lang", "bar_size"], "left")
    rows = small_join(rows, bar(over, "bar_over", "bar_size"), ["bar_size"], "left")
    kept = rows.where(F.col("score") >= F.coalesce("bar_own", "bar_over", F.lit(0.0)))
    return kept.select(*[F.col(f"`{c}`") for c in found.columns])


def held_out(id_col: str) -> Column:
    """A null id is never held out."""
    return F.coalesce(bucket_of_id(id_col, 4) == 2, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, protos = prototypes(docs.where(~held_out("doc_id")), "text", "lang")
    found = identify(docs, langs, protos, keep=["doc_id"])
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


QUERIES = {"op7_language_id": op7_language_id}
ORACLES: dict[str, str] = {}
