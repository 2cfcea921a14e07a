"""The binding table of a log that grows, without reading it again (A4)."""

import random

import pytest
from pyspark.sql import functions as F
from test_bindings import model_state, random_log

from routecast import schema as S
from routecast.operators.bindings import append_binding_ops, binding_state, bindings_of, current_bindings, merge_states
from routecast.plans import samples
from routecast.streaming.control import IncrementalBindings


def table(df):
    return {r["topic"]: (r["library"], r["symbol"]) for r in df.collect()}


def put(spark, path, rows):
    spark.createDataFrame(rows, S.BINDING_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("seed", range(3))
def test_random_appends_equal_the_whole_log(spark, tmp_path, seed):
    rows, rnd = random_log(seed, 90), random.Random(seed)
    path, load = str(tmp_path / "log"), IncrementalBindings(str(tmp_path / "log"), str(tmp_path / "state"))
    assert load(spark, 0).collect() == [] and load.rows_read == 0
    at = 0
    while at < len(rows):
        n = rnd.randint(1, 30)
        put(spark, path, rows[at : at + n])
        if rnd.random() < 0.5:  # a restart
            load = IncrementalBindings(path, str(tmp_path / "state"))
        got = table(load(spark, at))
        assert got == model_state(rows[: at + n])
        assert got == table(current_bindings(spark.read.parquet(path)))
        assert load.rows_read == len(rows[at : at + n])
        at += n
    assert table(load(spark, at)) == model_state(rows) and load.rows_read == 0
    assert len(list((tmp_path / "state").glob("state=*"))) <= 2


def test_the_filter_reaches_the_scan(spark, tmp_path):
    put(spark, str(tmp_path / "log"), random_log(1))
    load = IncrementalBindings(str(tmp_path / "log"), str(tmp_path / "state"))
    plan = load.tail(spark, 30)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(seq,30)" in plan


def test_a_fold_that_fails_is_done_again(spark, tmp_path, monkeypatch):
    rows = random_log(5)
    path, state = str(tmp_path / "log"), str(tmp_path / "state")
    put(spark, path, rows[:30])
    IncrementalBindings(path, state)(spark, 0)
    put(spark, path, rows[30:])
    load = IncrementalBindings(path, state)
    with monkeypatch.context() as m:
        m.setattr("routecast.streaming.published.BatchRecords.publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, 1)
    assert table(load(spark, 1)) == model_state(rows)


def test_states_merge_in_any_order(spark):
    rows = random_log(7, 120)
    random.Random(7).shuffle(rows)
    log = spark.createDataFrame(rows, S.BINDING_LOG_SCHEMA)
    a, b = log.where("seq % 3 = 0"), log.where("seq % 3 > 0")
    for x, y in ((a, b), (b, a), (log, a), (log.limit(0), log)):
        assert table(bindings_of(merge_states(binding_state(x), binding_state(y)))) == model_state(rows)


def test_ties_and_a_catalog(spark, tmp_path):
    tied = [(1, 1, S.OP_BIND, "t", "lib", s, True) for s in ("a", "c", "b")] + [(1, 1, S.OP_UNBIND, "u", None, None, True)] * 2
    log = spark.createDataFrame(tied, S.BINDING_LOG_SCHEMA)
    assert table(bindings_of(binding_state(log))) == table(current_bindings(log)) == {"t": ("lib", "c")}
    path = str(tmp_path / "log")
    load = IncrementalBindings(path, str(tmp_path / "state"), samples.check_catalog(spark))
    append_binding_ops(spark, path, [(0, S.OP_BIND, "view", "samples", "json_k")])
    assert table(load(spark, 0)) == {"view": ("samples", "json_k")}
    append_binding_ops(spark, path, [(1, S.OP_BIND, "view", "samples", "missing"), (2, S.OP_SUBSCRIBE, "new", None, None)])
    assert table(load(spark, 1)) == {"view": ("samples", "json_k"), "new": (S.BUILTIN_LIBRARY, S.DEFAULT_SYMBOL)}
    assert spark.read.parquet(path).where(F.input_file_name() != "").select(F.input_file_name()).distinct().count() == 2
