import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from routecast.llm import fill_middle as M

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    n = len(units)
    d = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, SHA(text), SHA(text))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return (doc_id, n, form, len(pre), len(mid), SHA(out), SHA(text))


def result(spark, rows, tmp_path, schema="doc_id long, text string, n string, form int, output string, id string"):
    width = schema.count(",") + 1
    df = spark.createDataFrame([(*r, *[None] * (width - 2)) for r in rows], schema)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return [tuple(r) for r in M.op11_fill_middle(spark, str(tmp_path)).collect()]


key = lambda r: str(r)


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in M.op11_fill_middle(spark, d).collect()]
    assert sorted(found, key=key) == sorted((brute(*r) for r in docs), key=key)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_edges(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, "", " ", "\t\n", "a", " a", "a ", "  a  b  ", "x<P>y", "<M>", "<", "<P", "é" * 9])]
    rows += [(i, "über  Größe 日本 \U0001f600 <S" * 3) for i in range(20, 60)]
    rows += [(None, "no id at all"), (7, "same"), (7, "same"), (7, "other text")]
    found = result(spark, rows, tmp_path)
    assert sorted(found, key=key) == sorted((brute(*r) for r in rows), key=key)


def test_very_long_text(spark, tmp_path):
    text = "Wort für  Wort \n" * 600_000 + "z" * 3_000_000
    rows = [(i, text) for i in (1, 2)]
    assert sorted(result(spark, rows, tmp_path), key=key) == sorted((brute(*r) for r in rows), key=key)


def test_empty_table(spark, tmp_path):
    assert result(spark, [], tmp_path) == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é日\n\t <P>SM\U0001f600", max_size=120), st.integers(1, 7), st.integers(0, 10**6))
def test_small_blocks(text, block, seed):
    raw = np.frombuffer(text.encode(), np.uint8)
    units = TOKEN.findall(text)
    own = M.Units(raw, block)
    assert own.n == len(units)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert own.cut(k) == (len(head.encode()), len(head))


def test_windows(monkeypatch):
    monkeypatch.setattr(M, "WINDOW_BLOCKS", 2)
    text = "ein Wort  näher an " * 40
    units = TOKEN.findall(text)
    own = M.Units(np.frombuffer(text.encode(), np.uint8), 5)
    assert [own.cut(k) for k in range(len(units) + 1)] == [
        (len("".join(units[:k]).encode()), len("".join(units[:k]))) for k in range(len(units) + 1)
    ]


def test_other_marks(spark):
    marks = M.Marks("[[pre]]", "[[suf]]", "[[mid]]")
    df = spark.createDataFrame([(i, f"text {i} with some words. And $1 \\Q more") for i in range(50)], "k int, t string")
    out = M.fill_in_middle(df, "k", "t", seed=7, fim_percent=100, spm_percent=50, marks=marks)
    rows = out.withColumn("back", M.restored(out.output, out.form, marks)).collect()
    assert {r.form for r in rows} == {"psm", "spm"}
    assert all(r.back == f"text {r.k} with some words. And $1 \\Q more" for r in rows)
    with pytest.raises(ValueError):
        M.fill_in_middle(df, "k", "t", marks=M.Marks("a", "a", "b"))
    with pytest.raises(ValueError):
        M.restored(out.output, out.form, M.Marks("ab", "bc", "d"))
