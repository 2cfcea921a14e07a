"""Removal of lines that spread over many sites.

A line's key is the 64-bit hash of its text without outer blanks. One
aggregation per key merges HyperLogLog sketches of the sites that show it,
made on the reading side, with its occurrences and its first document. Lines
of at least ``min_sites`` occurrences whose estimate is twice the threshold
spread for certain; those nearer to it (and over one site) get their distinct
sites counted exactly. A line of ``min_sites`` sites or more is removed from
every document but the first (smallest id) that holds it, so that no text is
lost altogether. Only DataFrame functions run.

Only line keys move; removed positions come back per document. A very common
line meets in one sketch per task, and as a join key it is broadcast or
salted.

Defined results: null and empty texts stay as they are; lines without a word
are never removed; a null site counts for nothing; documents with a null id
keep a line only if no document with an id holds it; every input row stays,
repeated rows included; other columns pass through unchanged. (That all of a
line's ``min_sites`` sites fall on one of the sketch's 128 registers, which
would hide it, has a chance of 128^-(min_sites-1).)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.llm.common import fresh, let, small_join, table, written

MIN_SITES = 5
SKETCH_ERROR = 0.1  # 128 registers
BLANKS = " \t\r\x0b\x0c"


def _keys(text: Column) -> Column:
    """Key of each line, null for lines without a word."""
    return F.transform(
        F.split(text, "\n", -1),
        lambda x: F.when(F.btrim(x, F.lit(BLANKS)) != "", F.xxhash64(F.btrim(x, F.lit(BLANKS)))),
    )


def line_keys(df: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """id, text hash, site, line number and key of every line with a word."""
    return (
        df.where(F.col(text_col) != "")
        .select(
            F.col(id_col).alias("id"),
            F.xxhash64(text_col).alias("version"),
            F.col(site_col).alias("site"),
            F.posexplode(_keys(F.col(text_col))).alias("pos", "key"),
        )
        .where("key IS NOT NULL")
    )


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """key and first document of each line at ``min_sites`` sites or more."""
    sketched = (
        lines.groupBy("key")
        .agg(
            F.approx_count_distinct("site", SKETCH_ERROR).alias("estimate"),
            F.count("site").alias("seen"),
            F.min("id").alias("first_id"),
        )
        .where((F.col("seen") >= min_sites) & (F.col("estimate") >= min(2, min_sites)))
    )
    sketched = written(lines.sparkSession, sketched, "spread")
    certain = sketched.where(F.col("estimate") >= 2 * min_sites).select("key", "first_id")
    near = sketched.where(F.col("estimate") < 2 * min_sites).select("key", "first_id")
    # distinct pairs first, so that a common line is one row per site and task
    pairs = lines.where("site IS NOT NULL").select("key", "site").distinct()
    exact = (
        small_join(pairs, near, ["key"], "inner")
        .groupBy("key", "first_id")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return certain.unionByName(exact.select("key", "first_id"))


def remove_spread_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> tuple[DataFrame, str]:
    """``df`` with the spread lines gone from ``text_col``, and a column (its
    name is returned, too) with the number of lines removed."""
    if min_sites < 1:
        raise ValueError("min_sites must be at least 1")
    spark = df.sparkSession
    lines = written(spark, line_keys(df, id_col, text_col, site_col), "lines")
    spread = written(spark, spread_lines(lines, min_sites), "spread")
    hits = (
        small_join(lines.select("id", "version", "pos", "key"), spread, ["key"], "inner")
        .where(~F.col("id").eqNullSafe(F.col("first_id")))
        .groupBy("id", "version")
        .agg(F.collect_list("pos").alias("gone"))
    )
    n_col, i, v, g = (fresh(df, c) for c in ("n_removed", "_id", "_version", "_gone"))
    hits = hits.select(F.col("id").alias(i), F.col("version").alias(v), F.col("gone").alias(g))
    joined = df.join(
        hits.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(v)), "left"
    )
    lines_of = F.split(F.col(text_col), "\n", -1)
    # positions are distinct, so the hashed set difference keeps each line
    left = F.array_except(F.sequence(F.lit(0), F.size(lines_of) - 1), F.col(g))
    text = F.when(F.col(g).isNull(), F.col(text_col)).otherwise(_at(lines_of, left))
    removed = F.coalesce(F.size(F.array_distinct(F.col(g))), F.lit(0)).cast("long")
    removed = F.when(F.col(g).isNull(), F.lit(0).cast("long")).otherwise(removed)
    out = [text.alias(c) if c == text_col else F.col(c) for c in df.columns]
    return joined.select(*out, removed.alias(n_col)), n_col


def _at(lines: Column, positions: Column) -> Column:
    return let(lines, lambda x: F.array_join(F.transform(positions, lambda p: F.get(x, p)), "\n"))


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    clean, n = remove_spread_lines(docs)
    return clean.select("doc_id", "text", F.col(n).alias("n_removed"))


OP4_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS k FROM lines
), spread AS (
  SELECT k, min(doc_id) AS first_id FROM keyed WHERE k <> ''
  GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT keyed.*, spread.k IS NOT NULL AND keyed.doc_id IS DISTINCT FROM spread.first_id AS gone
  FROM keyed LEFT JOIN spread ON keyed.k = spread.k
)
SELECT doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) FILTER (WHERE gone) AS n_removed
FROM marked GROUP BY doc_id
UNION ALL
SELECT doc_id, text, 0 FROM documents WHERE text IS NULL
"""

QUERIES = {"op4_line_spread": op4_line_spread}
ORACLES = {"op4_line_spread": OP4_SQL}
