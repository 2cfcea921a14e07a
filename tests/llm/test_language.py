import random
import resource
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from routecast.llm import language

SF = "/root/testdata/sf0.01"


def brute(text, dim):
    letters = " " + "".join(c if c.isalpha() else " " for c in (text or "")) + " "
    low = [c.lower() if len(c.lower()) == 1 else c for c in " ".join([""] + letters.split() + [""])]
    out = np.zeros(dim)
    vec = lambda c: language.letter_vectors(np.array([0 if c == " " else ord(c)]), dim)[0].astype(float)
    for (a, b, c), n in Counter(zip(low, low[1:], low[2:])).items():
        if b != " ":
            out += n * np.roll(vec(a), 2) * np.roll(vec(b), 1) * vec(c)
    return out


def test_profiles_against_brute_force():
    texts = ["The cat, it's", "", "x", "12 34", "Été\n\nÉTÉ ßİ", " a  b ", "日本 語", "\U0001f600 q"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = language.profiles(raw, offs, np.arange(len(texts)), len(texts), 128)
    for g, t in zip(got, texts):
        assert np.array_equal(g, brute(t, 128)), t


def test_long_texts_in_pieces(monkeypatch):
    text = "The cat, it's  Été--ÉTÉ ßİ 日本 語😀 q" * 5
    for text in (text, "語" * 40, "é 1é" * 20, " " * 90, "a" * 70 + " "):
        raw = np.frombuffer(text.encode(), np.uint8)
        want = brute(text, 128)
        for size, block in ((8, 3), (13, 2048), (21, 1)):
            monkeypatch.setattr(language, "PIECE_BYTES", size)
            monkeypatch.setattr(language, "BLOCK", block)
            got = language.profiles(raw, np.array([0, len(raw)]), np.array([1]), 3, 128)
            assert np.array_equal(got[1], want) and not got[[0, 2]].any(), (text, size)


def test_memory_of_a_large_alphabet_and_a_long_text():
    language.letter_table()
    rng = random.Random(3)
    wide = "".join(chr(0x4E00 + rng.randrange(20000)) for _ in range(1 << 18)).encode()
    long = ("the cat sat " + "".join(rng.choice("abcdefgh ") for _ in range(1000))).encode() * 50_000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for text in (wide, long):
        raw = np.frombuffer(text, np.uint8)
        assert language.profiles(raw, np.array([0, len(raw)]), np.array([0]), 1, language.DIM).any()
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 << 10


def test_confident(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rng = random.Random(4)
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)) for _ in range(20)]
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i " \
        "sumieniem i powinni postępować wobec innych w duchu braterstwa."  # fmt: skip
    short = [t[:200] for _, t, x in docs if x == "en" and t and len(t) > 400][:50]
    rows = docs + [(-1 - i, t, None) for i, t in enumerate([*junk, polish * 2])] + [(-1000 - i, t, None) for i, t in enumerate(short)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(df, *language.prototypes(df, "text", "lang"))
    kept = language.confident(found)
    assert kept.columns == found.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & set(range(-21, 0)), [(r.doc_id, r.lang_pred, r.score, len(r.text)) for r in found.where("doc_id between -21 and -1").collect()]
    assert sum(-1000 - i in ids for i in range(50)) >= 48
    assert sum(i in ids for i, t, _ in docs if t and len(t) > 100) >= 0.99 * sum(len(t or "") > 100 for _, t, _ in docs)
    none = found.where("lang IS NULL AND lang_pred <> 'und'")  # nothing learned: no bar
    assert language.confident(none).count() == none.count() > 0
    assert language.confident(found.where("false")).collect() == []


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "123 !", None), (None, "hello", "a"), (4, "hello", "a"), (4, "hello", "a"), (5, "zzz", "b"),
            (6, "hello " * 50000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, protos = language.prototypes(df, "text", "lang")
    assert langs == ["a", "b"]
    got = language.identify(df, langs, protos)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = sorted(got.collect(), key=str)
    assert len(got) == len(rows)
    for r in got:
        want = {1: "und", 2: "und", 3: "und", 5: "b"}.get(r.doc_id, "a")
        assert r.lang_pred == want and 0 <= r.score <= 1 and (r.score == 0) == (want == "und")
    clash = language.identify(df.withColumn("score", F.lit(7)), langs, protos)
    assert clash.columns[-3:] == ["score", "lang_pred", "score_"] and {r.score for r in clash.collect()} == {7}
    none = language.identify(df, *language.prototypes(df.where("false"), "text", "lang"))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert language.identify(df.where("false"), langs, protos).collect() == []


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = language.op7_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    print("accuracy", right / len(held), [(r.doc_id, r.lang_pred, docs[r.doc_id].lang, r.score, docs[r.doc_id].text[:60]) for r in held if r.lang_pred != docs[r.doc_id].lang][:10])
    assert right >= 0.97 * len(held)
