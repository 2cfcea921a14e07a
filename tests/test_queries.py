"""Every registered query against its DuckDB twin (as the driver checks),
plus the entry smoke test."""

import pytest

import __spark_entry__ as entry_mod
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"

SQLS = entry_mod.oracle_sql()
NAMES = sorted(entry_mod.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(NAMES)


@pytest.mark.parametrize("name", [n for n in NAMES if n in SQLS])
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry_mod.queries()[name], SQLS[name], SF)
    assert res["cols_match"], res
    assert res["rows_match"], res
    assert res["hash_match"], res


def test_entry(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["tbl", "topic", "kind", "n_rows", "data_bytes", "max_err_bytes"]
    assert sum(r["n_rows"] for r in rows) == spark.read.parquet(SF + "/events.parquet").count()
