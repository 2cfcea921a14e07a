"""URL verdicts: a rule list first, then gradient-boosted trees.

A rule names a host, which also stands for its subdomains, and a path prefix;
of the rules that fit, the longest decides. URLs that no rule decides are
judged by boosted trees on lexical features (lengths, depths, digit ratio,
character entropy, parameters, hyphens) and on suffix statistics: the number
of labelled URLs below the same last label, and the last two labels, of the
host, and the share of blocked ones among them. The labelled URLs are those
that rules decide; the statistics are taken over all of them, the trees are
fitted on about ``MAX_TRAIN``, chosen by hash per verdict. Only
DataFrame functions and the DataFrame-based ``pyspark.ml`` trees run.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule, and is judged on the empty text's features; with labelled
URLs of one verdict only, that verdict holds for the rest, with none "allow";
every input row gives one row, repeated rows and null ids included; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import let, small_join, table, written


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]
MAX_TRAIN = 20_000
ROUNDS, DEPTH, SEED = 10, 4, 11
FEATURES = [
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "entropy", "params", "hyphens",
    "one_label_share", "one_label_n", "two_label_share", "two_label_n",
]


def split_url(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with host and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return df.withColumns({"host": host, "path": F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)})


def decide(rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits host and path."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        text, verdict = (F.when(fits, F.lit(new)).otherwise(old) for new, old in ((r.text, text), (r.verdict, verdict)))
    return text, verdict


def _entropy(url: Column) -> Column:
    """Bits a character, of the characters' own frequencies. Characters are
    sorted, so that each makes one run."""

    def of_runs(starts: Column, n: Column) -> Column:
        size = lambda p, i: F.coalesce(F.get(starts, i + 1), n) - p
        return -F.aggregate(
            F.transform(starts, lambda p, i: size(p, i) / n * F.log2(size(p, i) / n)), F.lit(0.0), lambda a, x: a + x
        )

    return let(
        F.array_sort(F.split(url, "")),
        lambda c: let(
            F.filter(F.sequence(F.lit(0), F.size(c) - 1), lambda i: (i == 0) | (F.get(c, i) != F.get(c, F.greatest(i - 1, F.lit(0))))),
            lambda starts: of_runs(starts, F.size(c)),
        ),
    )


def _suffixes(df: DataFrame) -> DataFrame:
    """``df`` with the last label, and the last two labels, of the host."""
    labels = F.split("host", r"\.", -1)
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    return df.withColumns({"one_label": F.element_at(labels, -1), "two_label": two})


def lexical(df: DataFrame, url_col: str) -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    return _suffixes(df).withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "host_depth": F.size(F.split("host", r"\.", -1)).cast("double"),
            "path_depth": F.regexp_count(F.col("path"), F.lit("/")).cast("double"),
            "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / n,
            "entropy": _entropy(url),
            "params": F.regexp_count(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("[^&]+")).cast("double"),
            "hyphens": F.regexp_count(F.col("host"), F.lit("-")).cast("double"),
        }
    )


def _with_suffixes(df: DataFrame, stats: dict[str, DataFrame]) -> DataFrame:
    for name, t in stats.items():
        df = small_join(df, t, [name], "left").fillna({f"{name}_share": 0.5, f"{name}_n": 0.0})
    return df


def _sample(labelled: DataFrame, rows: dict[float, int], max_train: int) -> DataFrame:
    """About ``max_train`` rows, of each verdict its share but a quarter at
    least, or all it has; ``weight`` restores the verdicts' shares."""
    lot = F.pmod(F.xxhash64("_id", "_url"), F.lit(1 << 40))
    taken = []
    for label, n in rows.items():
        rate = min(1.0, max(max_train * n / sum(rows.values()), max_train / 4) / n)
        own = labelled.where((F.col("label") == label) & (lot < int(rate * (1 << 40))))
        if own.isEmpty():  # its rows share a few hashes
            own, rate = labelled.where(F.col("label") == label).limit(1), 1 / n
        taken.append(own.withColumn("weight", F.lit(1 / rate)))
    return taken[0].unionByName(taken[1])


def judge(df: DataFrame, id_col: str, url_col: str, rules: list[Rule] = RULES, max_train: int = MAX_TRAIN) -> DataFrame:
    """``id_col``, host, path, rule, verdict and, for URLs that the trees
    judge, their probability of a block."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    spark = df.sparkSession
    own = split_url(df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url")
    text, verdict = decide(rules)
    own = own.withColumns({"rule": text, "ruled": verdict})
    labelled = own.where("rule IS NOT NULL")
    labelled = _suffixes(labelled.withColumn("label", (F.col("ruled") == "block").cast("double")))
    total = labelled.groupBy("one_label", "two_label").agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("rows"))
    total = written(spark, total, "suffixes")
    both = total.agg(F.sum("blocked").alias("blocked"), F.sum("rows").alias("rows")).first()
    rows = {1.0: int(both.blocked or 0), 0.0: int((both.rows or 0) - (both.blocked or 0))}
    out = ["_id", "host", "path", "rule"]
    if not all(rows.values()):
        default = F.lit("block" if rows[1.0] else "allow")
        judged = own.select(*out, F.coalesce("ruled", default).alias("verdict"), F.lit(None).cast("double").alias("p_block"))
        return judged.withColumnRenamed("_id", id_col)
    sample = written(spark, lexical(_sample(labelled, rows, max_train), "_url"), "labelled")
    stats = {
        name: total.groupBy(name).agg(
            ((F.sum("blocked") + 1) / (F.sum("rows") + 2)).alias(f"{name}_share"),
            F.sum("rows").cast("double").alias(f"{name}_n"),
        )
        for name in ("one_label", "two_label")
    }
    to_vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED
    )
    model = trees.fit(to_vector.transform(_with_suffixes(sample, stats)).select("features", "label", "weight"))
    scored = model.transform(to_vector.transform(_with_suffixes(lexical(own, "_url"), stats)))
    by_trees = F.when(F.col("prediction") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    p = F.when(F.col("rule").isNull(), F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*out, F.coalesce("ruled", by_trees).alias("verdict"), p.alias("p_block")).withColumnRenamed("_id", id_col)


def op3_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), "page_id", "url")


QUERIES = {"op3_url_trees": op3_url_trees}
ORACLES: dict[str, str] = {}
