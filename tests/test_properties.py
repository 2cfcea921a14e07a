"""Properties of the decode output on the provided tables."""

import pytest
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.functions.decoders import DecoderRegistry
from routecast.operators.bindings import binding_ops, current_bindings, validate_log
from routecast.operators.routing import decode, to_drain
from routecast.plans import queries, samples
from routecast.sources.envelopes import read_conversations, read_documents

SF = "/root/testdata/sf0.01"


def _event_sets(spark):
    yield "events", queries.event_events(spark, SF), spark.read.parquet(SF + "/events.parquet").count()
    docs = decode(
        read_documents(spark, SF),
        samples.bindings_df(spark, samples.DOCUMENT_BINDINGS),
        samples.sample_registry(with_python=True),
    )
    yield "documents", docs, spark.read.parquet(SF + "/documents.parquet").count()
    conv = decode(read_conversations(spark, SF), samples.bindings_df(spark, []), samples.sample_registry())
    yield "conversations", conv, spark.read.parquet(SF + "/conversations.parquet").count()


def test_output_properties(spark):
    for name, events, n_in in _event_sets(spark):
        stats = events.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("kind") == "data").alias("data"),
            F.count_if(F.col("kind") == "error").alias("error"),
            F.count_if((F.col("kind") == "data") != (F.col("err") == "")).alias("bad_err"),
            F.count_if((F.col("kind") == "error") & (F.octet_length("data") > 0)).alias("bad_data"),
            F.max(F.octet_length("err")).alias("max_err"),
            F.count_if(F.col("data").isNull() | F.col("err").isNull() | F.col("key").isNull()).alias("nulls"),
        ).first()
        assert stats["n"] == n_in, name  # rows out = rows in
        assert stats["data"] + stats["error"] == stats["n"], name
        assert stats["bad_err"] == 0 and stats["bad_data"] == 0 and stats["nulls"] == 0, name
        assert stats["max_err"] <= 200, name
        drained = to_drain(events)
        assert drained.columns == S.DRAIN_COLUMNS
        assert drained.count() == n_in


def test_registry_api(spark):
    reg = DecoderRegistry(builtins=False)

    @reg.column("c1", library="L")
    def c1(env):
        return samples.skip_all(env)

    @reg.python("p1", library="P")
    def p1(env):
        return (0, "OK", b"x", "")

    reg.register_library("old", 1)
    assert (reg.form_of("L", "c1"), reg.form_of("P", "p1")) == ("column", "python")
    assert reg.form_of("L", "p1") is None
    cat = sorted(tuple(r) for r in reg.catalog(spark).collect())
    assert cat == [("L", 2, "c1"), ("P", 2, "p1"), ("old", 1, None)]
    # re-registering a symbol as the other kind moves it
    reg.register_column("p1", samples.skip_all, library="P")
    assert reg.form_of("P", "p1") == "column"
    with pytest.raises(ValueError):
        reg.register_column("", samples.skip_all)


def test_binding_ops_and_validation(spark):
    log = binding_ops(
        spark,
        [
            (10, S.OP_BIND, "a", "samples", "json_k"),
            (20, S.OP_REBIND, "a", "samples", "missing"),  # rejected by the check
            (30, S.OP_SUBSCRIBE, "b", None, None),
            (40, S.OP_BIND, "c", "lib_gone", "x"),  # rejected
        ],
    )
    checked = validate_log(log, samples.check_catalog(spark))
    errs = {r["seq"]: (r["valid"], r["err"]) for r in checked.collect()}
    assert errs[0] == (True, "") and errs[2] == (True, "")
    assert errs[1] == (False, S.MSG_SYMBOL_NOT_FOUND + "missing")
    assert errs[3][0] is False
    got = {r["topic"]: r["symbol"] for r in current_bindings(checked).collect()}
    assert got == {"a": "json_k", "b": S.DEFAULT_SYMBOL}
    with pytest.raises(ValueError):
        binding_ops(spark, [(1, "drop", "a", None, None)])
