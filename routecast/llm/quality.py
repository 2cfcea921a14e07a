"""Quality rules with thresholds that follow the data.

Every document gets base counts and five measures per word, line or letter:
symbols, repeated lines, words in repeated 3-word windows, capitals, and word
length. KLL quantile sketches of the measures are built per language and
source from the documents that pass the fixed base rules, and merge upwards
(language, then all); a group of fewer than ``MIN_GROUP`` documents takes the
thresholds of the next level that has as many. A document fails a rule when a
measure lies more than ``REACH`` spreads above its group's median (for the word
length, below it, too). The spread has two parts, added as variances: the
group's, from the lower quartile to the median, and that of counting, which
follows from the document's own number of words, lines or letters: with a
median rate r and events that come ``CLUMP`` at a time, n units scatter by
r * CLUMP / n + (CLUMP / n)^2, and a mean word length by a quarter of its square
/ n. So there is no fixed cutoff, and a measure that is 0 for most of a group
still allows a document the few events that chance brings. Only DataFrame
functions run.

Defined results: null text counts as empty; a document without words fails the
base rules; null languages and sources are groups of their own; every input
row gives one row, with repeated rows and null ids kept; columns of the input
never clash with working columns. Windows are compared by their 64-bit hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import WORD_SPLIT, fresh, let, small_join, table, written

MIN_WORDS = 50
MIN_GROUP = 50
REACH = 5.0
SKETCH_K = 800
# measure: events that come together (a repeated sentence has about 20 words)
CLUMP = {"symbols": 1, "dup_lines": 1, "repeats": 20, "capitals": 1}
NAMES = [*CLUMP, "word_length"]
TWO_SIDED = {"word_length"}


def _repeated(words: Column) -> Column:
    """Words (positions) inside a 3-word window found twice or more."""

    def positions(h: Column) -> Column:
        in_order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            in_order,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                        | ((i > 0) & F.coalesce(F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"], F.lit(False))),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(pos: Column) -> Column:
        gaps = F.transform(pos, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(pos, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1),
        F.size(words) - 2,
    )
    return F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(
        let(
            windows,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
                let(positions(h), covered)
            ),
        )
    )


def base_counts(text: Column) -> Column:
    """Struct of the base counts of a text."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeated(w).alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        )

    return let(
        F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l")),
        lambda s: F.struct(
            s["w"]["n_words"].alias("n_words"),
            s["w"]["word_chars"].alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            s["l"]["n_dup_lines"].alias("n_dup_lines"),
            s["w"]["n_repeat_words"].alias("n_repeat_words"),
            s["l"]["n_lines"].alias("n_lines"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        ),
    )


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def measures(c: Column) -> dict[str, Column]:
    """Measures by name; all are numbers as a document has words here."""
    per_word = lambda n: n / F.greatest(c["n_words"], F.lit(1))
    return {
        "symbols": per_word(c["n_symbols"]),
        "dup_lines": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
        "repeats": per_word(c["n_repeat_words"]),
        "capitals": c["n_capitals"] / F.greatest(c["word_chars"], F.lit(1)),
        "word_length": per_word(c["word_chars"]),
    }


def reach(c: Column, name: str, mid: Column, spread: Column) -> Column:
    """How far from ``mid`` a measure of a document with the counts ``c`` may
    lie."""
    n = F.greatest(c[{"dup_lines": "n_lines", "capitals": "word_chars"}.get(name, "n_words")], F.lit(1))
    chance = mid * mid / (4 * n) if name == "word_length" else CLUMP[name] / n * (mid + CLUMP[name] / n)
    return REACH * F.sqrt(spread * spread + chance)


def thresholds(measured: DataFrame, counts: str, lang_col: str, source_col: str) -> DataFrame:
    """Per (lang, source): median and spread of each measure."""
    names = NAMES
    good = measured.where(~base_failed(F.col(counts)))
    values = good.select(
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), *[m.alias(n) for n, m in measures(F.col(counts)).items()]
    )
    by_source = values.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names]
    )

    def merged(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names]
        )

    def limits(df: DataFrame, *keys: str) -> DataFrame:
        out = []
        for n in names:
            mid = F.kll_sketch_get_quantile_double(n, F.lit(0.5))
            spread = mid - F.kll_sketch_get_quantile_double(n, F.lit(0.25))
            out += [mid.alias(f"{n}_mid"), spread.alias(f"{n}_spread")]
        return df.where(F.col("n") > 0).select(*keys, "n", *out)

    # sketches of each level are written: they are random beyond SKETCH_K
    # values, and every reader has to see the same ones
    spark = measured.sparkSession
    by_source = written(spark, by_source, "sketches")
    by_lang = written(spark, merged(by_source, "lang"), "sketches")
    overall = written(spark, limits(merged(by_lang)), "limits")
    by_lang = written(spark, limits(by_lang, "lang"), "limits")
    own = limits(by_source, "lang", "source")

    cols = [f"{n}_{side}" for n in names for side in ("mid", "spread")]
    as_of = lambda df, p: df.select(
        *[c for c in ("lang",) if c in df.columns], F.col("n").alias(f"{p}_n"), *[F.col(c).alias(f"{p}_{c}") for c in cols]
    )
    joined = small_join(own, as_of(by_lang, "l"), ["lang"], "left").crossJoin(F.broadcast(as_of(overall, "a")))  # one row
    pick = lambda c: (
        F.when(F.col("n") >= MIN_GROUP, F.col(c)).when(F.col("l_n") >= MIN_GROUP, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    )
    return written(spark, joined.select("lang", "source", *[pick(c).alias(c) for c in cols]), "thresholds")


def judge(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """The columns ``keep`` (all, unless given) and a struct column, whose name
    is returned, too: the base counts, ``base_failed`` and ``kept``."""
    spark = df.sparkSession
    keep = list(df.columns) if keep is None else keep
    carried = list(dict.fromkeys([*keep, lang_col, source_col]))
    verdict, limits_col = fresh(df, "verdict"), fresh(df, "_limits")
    measured = written(spark, df.select(*carried, base_counts(F.col(text_col)).alias(verdict)), "measured")
    limit = thresholds(measured, verdict, lang_col, source_col)
    packed = limit.select(
        F.col("lang").alias(lang_col),
        F.col("source").alias(source_col),
        F.struct(*[c for c in limit.columns if c not in ("lang", "source")]).alias(limits_col),
    )
    joined = small_join(measured, packed, [lang_col, source_col], "left")
    c, lim = F.col(verdict), F.col(limits_col)
    within = []
    for n, m in measures(c).items():
        off = m - lim[f"{n}_mid"]
        within.append((F.abs(off) if n in TWO_SIDED else off) <= reach(c, n, lim[f"{n}_mid"], lim[f"{n}_spread"]))
    failed = base_failed(c)
    kept = ~failed & F.coalesce(reduce(lambda a, b: a & b, within), F.lit(True))
    out = F.struct(f"{verdict}.*", failed.alias("base_failed"), kept.alias("kept"))
    return joined.select(*keep, out.alias(verdict)), verdict


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, v = judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", f"{v}.*").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES: dict[str, str] = {}
