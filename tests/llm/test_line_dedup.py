from collections import defaultdict

import pytest
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from routecast.llm import line_dedup

SCHEMA = "doc_id long, source string, text string"


def brute(rows, min_sites):
    key = lambda x: x.strip(line_dedup.BLANKS)
    sites, first = defaultdict(set), {}
    for i, s, t in rows:
        for x in (t or "").split("\n"):
            if key(x):
                if s is not None:
                    sites[key(x)].add(s)
                if i is not None:
                    first[key(x)] = min(i, first.get(key(x), i))
    out = []
    for i, s, t in rows:
        if not t:
            out.append((i, s, t, 0))
            continue
        lines = t.split("\n")
        left = [x for x in lines if not (key(x) and len(sites[key(x)]) >= min_sites and first.get(key(x)) != i)]
        out.append((i, s, "\n".join(left), len(lines) - len(left)))
    return sorted(out, key=str)


def run(spark, rows, min_sites):
    got, n = line_dedup.remove_spread_lines(spark.createDataFrame(rows, SCHEMA), min_sites=min_sites)
    return sorted(((r.doc_id, r.source, r.text, r[n]) for r in got.collect()), key=str)


@pytest.mark.parametrize("min_sites", [1, 2, 3, 5])
def test_against_brute_force(spark, min_sites):
    rows = [(i, f"s{i % 7}", "\n".join([f"own {i}", "common", f"mod {i % 3}", "  common\t", "", "same" if i < 9 else "x"])) for i in range(40)]
    rows += [(50, "s1", None), (51, "s1", ""), (52, None, "common\nlast"), (None, "s2", "common\nonly here"), (None, None, None)]
    rows += [(53, "s3", "common\nz")] * 2 + [(54, "s9", "common"), (54, "s9", "z\ncommon")]
    assert run(spark, rows, min_sites) == brute(rows, min_sites)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA).withColumn("n_removed", F.lit("x"))
    got, n = line_dedup.remove_spread_lines(df)
    assert n == "n_removed_" and got.collect() == []


def test_long_text(spark):
    long = "\n".join(f"line {i % 30000}" for i in range(60000))
    rows = [(i, f"s{i}", long) for i in range(3)]
    got = {r[0]: r for r in run(spark, rows, 3)}
    assert got[0][2] == long and got[2][2] == "" and got[2][3] == 60000


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    res = compare(spark, duck(sf), "op4", line_dedup.op4_line_spread, line_dedup.OP4_SQL, sf)
    assert res["hash_match"], res
