import numpy as np
import pytest
from pyspark.sql import functions as F

from routecast.llm import cap_filters as M


def brute(rows, least=0.95):
    """id -> (links, component) by all pairs; rows of distinct ids."""
    use = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {i: (0, i) for i, _ in rows}
    parent = {i: i for i, _ in use}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for size in {len(v) for _, v in use}:
        ids = [i for i, v in use if len(v) == size]
        x = np.array([v / np.abs(v).max() for _, v in use if len(v) == size])
        x /= np.linalg.norm(x, axis=1)[:, None]
        linked = x @ x.T >= least
        np.fill_diagonal(linked, False)
        for k, i in enumerate(ids):
            out[i] = (int(linked[k].sum()), i)
            for j in np.flatnonzero(linked[k]):
                a, b = sorted((root(i), root(ids[j])))
                parent[b] = a
    return {i: (n, root(i) if i in parent else i) for i, (n, _) in out.items()}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def same(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    own, want = found(M.near_vectors(df, **how)), brute(rows)
    assert own.keys() == want.keys()
    return {i for i in want if own[i] != (*want[i], want[i][1] == i)}


def near(rng, v, cos):
    z = rng.standard_normal(len(v))
    z -= z @ v * v / (v @ v)
    return cos * v / np.linalg.norm(v) + np.sqrt(1 - cos * cos) * z / np.linalg.norm(z)


def planted(rng, dim, n, groups, cosines):
    rows = [rng.standard_normal(dim) for _ in range(n)]
    for size in groups:
        v = rng.standard_normal(dim)
        rows += [near(rng, v, rng.choice(cosines)) * rng.uniform(0.1, 9) for _ in range(size)]
    return [(k, r.tolist()) for k, r in enumerate(rng.permutation(np.array(rows)))]


def test_given_tables(spark):
    """The provided vectors hold no link at all; a third of them copied does."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in df.collect()]
    own = M.op13_cap_filters(spark, "/root/testdata/sf0.01")
    assert own.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert found(own) == {i: (n, c, True) for i, (n, c) in brute(rows).items()}


@pytest.mark.parametrize("dim", [64, 100])
def test_planted_groups(spark, dim):
    rng = np.random.default_rng(dim)
    rows = planted(rng, dim, 600, [2] * 60 + [5] * 20 + [60, 200], [0.975, 0.98, 0.99, 0.999])
    assert same(spark, rows) == set()


def test_pairs_at_the_bar(spark):
    rng = np.random.default_rng(8)
    rows, bases = [], rng.standard_normal((400, 48))
    for k, v in enumerate(bases):
        rows += [(2 * k, v.tolist()), (2 * k + 1, near(rng, v, 0.9501 if k % 2 else 0.9499).tolist())]
    own = found(M.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    want = brute(rows)
    assert all(own[i][0] <= want[i][0] for i in want)  # none below the bar
    assert sum(n for n, _, _ in own.values()) >= 0.99 * sum(n for n, _ in want.values())


def test_blocks_and_small_filters_agree(spark):
    """Groups counted in tiles of any size, or as pairs of ids."""
    rng = np.random.default_rng(4)
    rows = planted(rng, 32, 100, [3, 9, 40, 130], [0.98, 0.985, 0.995])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    results = [found(M.near_vectors(df, small=s, block=b)) for s, b in ((16, 1024), (1, 1024), (1, 7), (1000, 8), (5, 20))]
    assert all(r == results[0] for r in results[1:])
    want = brute(rows)
    assert {i: r[:2] for i, r in results[0].items()} == want


def test_large_group_of_copies(spark):
    """A third of all rows are copies of one vector, another part near it."""
    rng = np.random.default_rng(2)
    v = rng.standard_normal(16)
    rows = [(k, (v if k % 3 == 0 else near(rng, v, 0.99) if k % 30 == 1 else rng.standard_normal(16)).tolist()) for k in range(900)]
    assert same(spark, rows, small=4, block=16) == set()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [1.0, inf]), (6, [1.0, None]), (7, [1.0, 0.0])]
    rows += [(8, [1e200, 1e190]), (9, [1e-200, 0.0]), (10, [1.0]), (11, [5.0]), (12, [-1.0]), (13, [1.0, 0.0, 0.0]), (14, [0.0, 1.0])]
    assert same(spark, rows) == set()


def test_repeated_ids_and_clashing_columns(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [2.0, 0.1]), (None, None), (3, [0.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", 5, 7) for r in rows], "vec_id long, embedding array<float>, node string, key int, id int")
    own = sorted(M.near_vectors(df).collect(), key=str)
    a, b = [1, 2, 1, True], [2, 2, 1, False]
    want = [a, a, b, [1, 1, 1, True], [None, 2, 1, False], [None, 0, None, True], [3, 1, 1, False]]
    assert sorted([list(r) for r in own], key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert M.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in M.near_vectors(none).collect()] == [(1, 0, 1, True)]


def test_decoding_equals_all_directions():
    rng = np.random.default_rng(1)
    scores = [rng.standard_normal((9, 6)).astype(np.float32) / 4 for _ in range(3)]
    total = scores[0][:, :, None, None].astype(float) + scores[1][:, None, :, None] + scores[2][:, None, None, :]
    for height in (-2.0, 0.0, 0.5, 1.0, 9.0):
        r, k, v = M.decode(scores, height)
        want = np.argwhere(total.reshape(9, -1) >= height)
        got = np.unique(np.stack([r, k], axis=1), axis=0)
        assert len(got) == len(r) and abs(len(got) - len(want)) <= 1
        assert np.allclose(v, total.reshape(9, -1)[r, k])


def test_forest_spans():
    rng = np.random.default_rng(3)
    m = rng.random((60, 60)) < 0.02
    m |= m.T
    edges = M.forest(m)
    reach = np.eye(60, dtype=bool) | m
    for _ in range(7):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    assert len(edges) == 60 - len({tuple(r) for r in reach.tolist()})
    assert all(reach[i, j] for i, j in edges)
