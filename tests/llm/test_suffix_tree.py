import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from routecast.llm import suffix_tree as st

SF = "/root/testdata/sf0.01"


def tokens(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return low.split()


def spelled(text):
    return b"\n" * st.DEPTH + b"".join(w + b" " for w in tokens(text)) + b"\n"


class Brute:
    """The tree by plain dictionaries."""

    def __init__(self, texts, least_share=st.LEAST_SHARE):
        counts = [defaultdict(Counter) for _ in range(st.DEPTH + 1)]
        total = 0
        for t in texts:
            x = spelled(t)
            for i in range(st.DEPTH, len(x)):
                total += 1
                for d in range(st.DEPTH + 1):
                    counts[d][x[i - d : i]][x[i]] += 1
        self.p0 = {w: (counts[0][b""][w] + st.ALPHA) / (total + 256 * st.ALPHA) for w in range(256)}
        self.states = {}
        for d in range(1, st.DEPTH + 1):
            for c, own in counts[d].items():
                n = sum(own.values())
                own = {w: m for w, m in own.items() if m >= least_share * total}
                if not own:
                    continue
                k, rest = len(own), n - sum(own.values())
                suffix = {w: self.p(c[1:], w) for w in own}
                gain = sum(m * math.log(m / n / suffix[w]) for w, m in own.items())
                if rest:
                    gain += rest * math.log(rest / n / (1 - min(sum(suffix.values()), 1 - 1e-12)))
                if gain > k / 2 * math.log(n + 1):
                    self.states[c] = (own, n + k, k + rest)

    def p(self, context, w):
        while context and context not in self.states:
            context = context[1:]
        if not context:
            return self.p0[w]
        own, n, k = self.states[context]
        return (own.get(w, 0) + k * self.p(context[1:], w)) / n

    def score(self, text):
        x = spelled(text)
        return sum(math.log10(self.p(x[i - st.DEPTH : i], x[i])) for i in range(st.DEPTH, len(x)))


TEXTS = ["the cat sat", "the cat ran the rat ran", None, "", "THE Cat\n\tsat", "äö the ö", "a", "the cat sat on the mat " * 30, "x\x00y \x0b z", "cat"] * 3


@pytest.mark.parametrize("least_share,head", [(st.LEAST_SHARE, st.HEAD_SHARE), (1e-3, 0.05), (0.01, 2)])
def test_against_dictionaries(spark, least_share, head):
    rows = [(i if i % 6 else None, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit(0), "n": F.lit("x")})
    learn = TEXTS[:16]
    model = st.train(spark.createDataFrame([(t,) for t in learn], "text string"), head_share=head, least_share=least_share)
    brute, c = Brute(learn, least_share), Counter()
    for t in learn:
        c.update([*tokens(t), b"\n"])
    n, v = sum(c.values()), len(c)
    got = st.score(df, model).collect()
    want = []
    for i, t in rows:
        own = [*tokens(t), b"\n"]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        want.append((i, len(own), sum(c[w] > 0 for w in own), n, base, brute.score(t)))
    key = lambda r: (str(r[0]), r[1], r[2], round(r[5], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:], rel=1e-9), (g, w)


@pytest.mark.parametrize("least_share", [0, 0.01])
def test_sums_to_one(least_share):
    brute = Brute(TEXTS, least_share)
    for c in list(brute.states)[:50] + [b"zzzzz"]:
        assert sum(brute.p(c, w) for w in range(256)) == pytest.approx(1)


def test_nothing_learned_and_empty(spark):
    model = st.train(spark.createDataFrame([], "text string"))
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = st.score(df, model).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (2, 0, 0, 0)
    assert r.score == pytest.approx(4 * math.log10(1 / 256))
    assert st.score(df.where("false"), model).collect() == []


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    c = Counter()
    for i, t in docs.items():
        if zlib.crc32(str(i).encode()) % 10:
            c.update([*tokens(t), b"\n"])
    n, v = sum(c.values()), len(c)
    got = st.op2_suffix_tree(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        own = [*tokens(docs[r.doc_id]), b"\n"]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), rel=1e-9)


def test_held_out_texts(spark):
    held = [r for r in st.op2_suffix_tree(spark, "/root/testdata/sf0.1").collect() if r.held_out]
    per = [sum(getattr(r, k) for r in held) / sum(r.n_tokens for r in held) for k in ("base_score", "score")]
    print("per token", per)
    assert per[1] > per[0] + 0.1


def test_rare_pairs_of_a_large_corpus_stay(spark):
    """Pairs far below 1e-7 of the symbols count as those of a small corpus."""
    text = "the cat sat on the mat " * 20
    counts = Counter()
    for t, times in ((text, 100_000), ("a quokka ran", 2)):
        x = spelled(t)
        for i in range(st.DEPTH, len(x)):
            counts[int.from_bytes(x[i - st.DEPTH : i + 1], "big")] += times
    assert sum(counts.values()) * 1e-7 > 2
    tree = st.grow(spark, spark.createDataFrame(list(counts.items()), "key long, n long"))
    assert tree.pairs[-1].count() == len(counts)
    lp = {r.key: r.lp for r in tree.pairs[-1].collect()}
    assert lp[int.from_bytes(b"quokka", "big")] > math.log10(0.5)


@pytest.mark.parametrize("head", [0, 0.01, 2])
def test_head_changes_no_score(spark, head):
    learn = [t for t in TEXTS if t] + ["zyx wvu"]
    df = spark.createDataFrame([(1, t) for t in [*TEXTS, "quite other words, zyx cats", "zyx"]], "doc_id long, text string")
    got = st.score(df, st.train(spark.createDataFrame([(t,) for t in learn], "text string"), head_share=head)).collect()
    brute = Brute(learn)
    want = sorted(brute.score(r.text) for r in df.collect())
    assert sorted(r.score for r in got) == pytest.approx(want, rel=1e-9)
