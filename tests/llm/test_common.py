import numpy as np
import pytest

from routecast.llm import common, line_dedup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_small_join_is_the_same_beyond_its_bound(spark, how):
    left = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3, "hot") for i in range(300)], "id long, k long, t string")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (None, "n"), (9, "z")], "k long, v string")
    found = [common.small_join(left, right, ["k"], how, max_rows=n) for n in (10, 0)]
    assert found[0].columns == found[1].columns
    rows = [sorted(map(tuple, d.collect()), key=str) for d in found]
    assert rows[0] == rows[1] and len(rows[0]) == (300 if how == "left" else 220)
    assert "Broadcast" not in found[1]._jdf.queryExecution().optimizedPlan().toString()


def test_line_dedup_beyond_the_broadcast_bound(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want, n = line_dedup.remove_spread_lines(docs)
    want = sorted(map(tuple, want.collect()))
    join = common.small_join
    monkeypatch.setattr(line_dedup, "small_join", lambda *a: join(*a, max_rows=0))
    assert sorted(map(tuple, line_dedup.remove_spread_lines(docs)[0].collect())) == want


def test_words_and_their_hashes():
    texts = ["a bc\x0bdef", "", " lead", "trail ", "é\u00a0x y", "a", "bc"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0] + [len(t.encode()) for t in texts])
    s, e, doc = common.words(raw, offs)
    got = [(int(d), raw[a:b].tobytes()) for a, b, d in zip(s, e, doc)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in t.encode().split()]
    h = common.word_hashes(raw, s, e)
    by_word = {}
    for (_, w), x in zip(got, h.tolist()):
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    class Other:
        class sparkContext:  # noqa: N801
            master = "yarn"

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Other)
