import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from routecast.llm import spelling as M

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def low(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute_counts(rows, every=97):
    out = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            w = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % every == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            out[w] += 1
    return out


def brute_variants(counts, ratio=2):
    """Near words by deleting each code point of each word."""
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1 :]]
            if (short := w[:i] + w[i + 1 :]) in counts:
                near[w].add(short)
                near[short].add(w)
        near[w].discard(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def check(spark, counts, **how):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = [tuple(r) for r in M.variants(df, **how).select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(found) == len(counts)
    assert set(found) == brute_variants(counts)


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    counts = {w: n for w, n in brute_counts(rows).items() if n >= 3 and len(w) >= 5}
    found = M.op12_spelling_variants(spark, d).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(found) == len(counts) > 5000
    assert {tuple(r) for r in found} == brute_variants(counts)


def test_random_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(1500)}
    check(spark, {w: rng.randint(1, 40) for w in words})
    check(spark, {w: rng.randint(1, 40) for w in words}, most=1)


@pytest.mark.parametrize("where", ["head", "tail", "both"])
def test_crowded_chunk(spark, where):
    """Thousands of words that share a chunk: no pair is lost and few are met."""
    rng = random.Random(5)
    own = {"".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)}
    own |= {w[:3] + w[4:] for w in list(own)[:400]} | {w[:2] + "z" + w[3:] for w in list(own)[:400]}
    head, tail = ("unterscheid" if where != "tail" else ""), ("barkeiten" if where != "head" else "")
    check(spark, {head + w + tail: rng.randint(1, 90) for w in own})


def test_pairs_stay_in_proportion(spark, monkeypatch):
    rng = random.Random(6)
    words = [("gemeinsam" + "".join(rng.choice("abcdefghijklmnop") for _ in range(9)), 1) for _ in range(6000)]
    met = []
    plain = M.written

    def counted(s, df, name, slim=False):
        out = plain(s, df, name, slim)
        if name == "load":
            met.append(name)
        return out

    monkeypatch.setattr(M, "written", counted)
    df = spark.createDataFrame(words, "word string, n long").dropDuplicates(["word"])
    left, right = M.chunks(df), M.grams(df)
    assert left.join(right, "key").count() > 30_000_000  # what the chunks alone would make
    M.near_pairs(df).count()
    assert 2 <= len(met) <= 5


def test_counts_edges(spark):
    rows = [(1, None), (2, ""), (None, "Wörter wörter ÄÖ×÷ÿ naïve's x1y"), (None, None), (3, "Ab AB ab aB日本ab"), (3, "ab")]
    rows += [(i, "etwas Äpfel etwas") for i in range(300)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int")
    for every in (2, 3, 97):
        found = {r.word: r.n for r in M.count_words(df, typo_every=every).collect()}
        assert found == {w: n for w, n in brute_counts(rows, every).items() if w}
    plain = {r.word: r.n for r in M.count_words(df).collect()}
    assert plain["ab"] == 6 and plain["Äpfel"] == 300 and "äpfel" not in plain


def test_long_text_in_slices(spark, monkeypatch):
    monkeypatch.setattr(M, "SLICE_BYTES", 64)
    monkeypatch.setattr(M, "FLUSH_BYTES", 4000)
    rows = [(9, "Straße und Größe sind Wörter; " * 400 + "é" * 1000 + " Ende")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in M.count_words(df, typo_every=3).collect()} == brute_counts(rows, 3)


def test_chain_and_ties(spark):
    counts = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 32, "ccccc": 5, "ccccd": 10, "cccce": 10}
    check(spark, counts)
    with pytest.raises(ValueError):
        M.variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert M.op12_spelling_variants(spark, str(tmp_path)).collect() == []
    other = tmp_path / "rare"
    spark.createDataFrame([(1, "seltene Wörter"), (2, None)], "doc_id long, text string").write.parquet(str(other / "documents.parquet"))
    assert M.op12_spelling_variants(spark, str(other)).collect() == []
    assert M.variants(spark.range(0).select(F.lit("w").alias("word"), "id").withColumnRenamed("id", "n")).collect() == []


def test_roots_copy_no_side_of_a_join(spark, monkeypatch):
    """Beyond any bound on small tables, too, a round of the pointers joins
    each row once."""
    from routecast.llm import common

    plans, write = [], M.written
    monkeypatch.setattr(common.small_join, "__defaults__", (0,))
    monkeypatch.setattr(M, "written", lambda s, df, *a, **k: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(s, df, *a, **k))[1])
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(40)]
    found = M.roots(spark, spark.createDataFrame(chain, "word string, form string"))
    assert {r.word: r.root for r in found.collect()} == {w: "w040" for w, _ in chain}
    assert len(plans) > 3 and not any("Generate" in p for p in plans)
