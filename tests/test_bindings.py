"""Binding control (A4, J2, J4, D5) against a sequential brute-force model."""

import random

import pytest
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.operators import bindings
from routecast.operators.bindings import (
    binding_intervals,
    bindings_from_text,
    check_bindings,
    current_bindings,
    route_as_of,
)

TOPICS = ["a", "b", "c", "d"]


def random_log(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        op = rnd.choice([S.OP_BIND, S.OP_REBIND, S.OP_UNBIND, S.OP_SUBSCRIBE, S.OP_BIND])
        topic = rnd.choice(TOPICS)
        t = rnd.choice([0, 10, 10, 20, 30, 40, 50, 60, 70, 80])  # ties on purpose
        binds = op in (S.OP_BIND, S.OP_REBIND)
        sym = f"s{rnd.randint(0, 5)}" if binds else None
        lib = "lib" if binds else None
        valid = rnd.random() > 0.2 if binds else True
        rows.append((t, seq, op, topic, lib, sym, valid))
    return rows


def model_state(rows, upto=None):
    """Apply ops in (effective_at, seq) order; stop after effective_at > upto."""
    state = {}
    for t, seq, op, topic, lib, sym, valid in sorted(rows, key=lambda r: (r[0], r[1])):
        if upto is not None and t > upto:
            break
        if op in (S.OP_BIND, S.OP_REBIND):
            if valid:
                state[topic] = (lib, sym)
        elif op == S.OP_UNBIND:
            state.pop(topic, None)
        elif op == S.OP_SUBSCRIBE:
            state.setdefault(topic, (S.BUILTIN_LIBRARY, S.DEFAULT_SYMBOL))
    return state


@pytest.mark.parametrize("seed", range(6))
def test_current_bindings_equals_sequential_model(spark, seed):
    rows = random_log(seed)
    log = spark.createDataFrame(rows, S.BINDING_LOG_SCHEMA)
    got = {r["topic"]: (r["library"], r["symbol"]) for r in current_bindings(log).collect()}
    assert got == model_state(rows)


def test_unbind_twice_and_rebind_without_bind(spark):
    rows = [
        (1, 1, S.OP_UNBIND, "a", None, None, True),
        (2, 2, S.OP_UNBIND, "a", None, None, True),
        (3, 3, S.OP_REBIND, "b", "lib", "x", True),
        (4, 4, S.OP_BIND, "b", "lib", "bad", False),  # rejected: old binding stays
        (5, 5, S.OP_BIND, "c", "lib", "y", True),
        (6, 6, S.OP_SUBSCRIBE, "c", None, None, True),  # subscribe after bind: kept
        (7, 7, S.OP_UNBIND, "d", None, None, True),
        (8, 8, S.OP_SUBSCRIBE, "d", None, None, True),  # subscribe after unbind: default
    ]
    log = spark.createDataFrame(rows, S.BINDING_LOG_SCHEMA)
    got = {r["topic"]: r["symbol"] for r in current_bindings(log).collect()}
    assert got == {"b": "x", "c": "y", "d": S.DEFAULT_SYMBOL}


def _messages(spark, times):
    data = [(topic, 0, i, t, None, b"m") for i, (topic, t) in enumerate(times)]
    return spark.createDataFrame(data, S.ENVELOPE_SCHEMA)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(
    "max_rows,log_block,fan",
    [(1_000_000, 3_600_000, 64), (0, 3_600_000, 64), (1_000_000, 7, 2), (1_000_000, 7, 3), (0, 25, 64)],
)
def test_route_as_of_equals_sequential_model(spark, monkeypatch, seed, max_rows, log_block, fan):
    monkeypatch.setattr(bindings, "FAN", fan)
    rows = random_log(seed)
    log = spark.createDataFrame(rows, S.BINDING_LOG_SCHEMA)
    rnd = random.Random(100 + seed)
    times = [(rnd.choice(TOPICS + ["zz"]), rnd.choice([-5, 0, 5, 10, 15, 20, 45, 80, 95])) for _ in range(120)]
    env = _messages(spark, times)
    # bucket width 7 forces many buckets on the large-log path
    routed = route_as_of(
        env, log, max_broadcast_rows=max_rows, bucket_width=7, log_block=log_block
    )
    got = {r["offset"]: r["decoder"] for r in routed.collect()}
    assert len(got) == len(times) and routed.count() == len(times)
    for i, (topic, t) in enumerate(times):
        # a negative time means "unavailable": the latest binding applies
        exp = model_state(rows, upto=t if t >= 0 else None).get(topic)
        assert got[i] == (exp[1] if exp else None), (i, topic, t)


@pytest.mark.parametrize("block", [3_600_000, 10, 1])
def test_intervals_do_not_overlap(spark, block):
    log = spark.createDataFrame(random_log(7), S.BINDING_LOG_SCHEMA)
    iv = sorted(
        binding_intervals(log, block).collect(), key=lambda r: (r["topic"], r["valid_from"])
    )
    for a, b in zip(iv, iv[1:]):
        if a["topic"] == b["topic"]:
            assert a["valid_to"] is not None and a["valid_to"] <= b["valid_from"]


def test_many_intervals_on_one_topic(spark):
    """100,000 rebinds of one topic: each message descends a tree of 64-way
    nodes, none is compared with all intervals."""
    log = spark.range(100_000).select(
        (F.col("id") * 10).alias("effective_at"), F.col("id").alias("seq"), F.lit(S.OP_REBIND).alias("op"),
        F.lit("a").alias("topic"), F.lit("lib").alias("library"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("symbol"),
        F.lit(True).alias("valid"),
    )
    times = [("a", t) for t in (0, 9, 10, 15, 640, 639, 409_599, 409_600, 999_989, 999_990, 5_000_000, -1)] + [("b", 5), (None, 5)]
    got = {r["offset"]: r["decoder"] for r in route_as_of(_messages(spark, times), log).collect()}
    for i, (topic, t) in enumerate(times):
        assert got[i] == (None if topic != "a" else f"s{min(t if t >= 0 else 10**9, 999_990) // 10}")
    plan = route_as_of(_messages(spark, times), log)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "valid_from#" not in plan.split("BroadcastHashJoin")[1].split("\n")[0]


def test_current_bindings_hashes_the_log(spark):
    log = spark.createDataFrame(random_log(3), S.BINDING_LOG_SCHEMA)
    first = log.groupBy("topic").agg(F.max(bindings.order_key(F.col("effective_at"), F.col("seq"))))
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
    key = bindings.order_key(F.lit(1_700_000_000_123), F.lit(9_000_000_000_000_000_000))
    at, seq = spark.range(1).select(*bindings.split_order_key(key)).first()
    assert (at, seq) == (1_700_000_000_123, 9_000_000_000_000_000_000)


def test_a_table_the_user_cached_stays_cached(spark):
    from routecast.operators.broadcast import bounded_broadcast

    df = spark.range(100).cache()
    assert bounded_broadcast(df, 10)[1] is False and df.storageLevel.useMemory
    assert bounded_broadcast(df, 1000)[1] is True and df.storageLevel.useMemory
    df.unpersist()


def test_a_storage_error_does_not_restart_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    bindings.append_binding_ops(spark, path, [(0, S.OP_BIND, "a", "lib", "x")])
    bindings.append_binding_ops(spark, path, [(1, S.OP_UNBIND, "a", None, None)])
    assert sorted(r.seq for r in spark.read.parquet(path).collect()) == [0, 1]
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        bindings.append_binding_ops(spark, str(tmp_path / "broken"), [(0, S.OP_BIND, "a", "lib", "x")])


def test_single_early_bind_equals_plain_route(spark):
    log = spark.createDataFrame([(0, 0, S.OP_BIND, "a", "lib", "x", True)], S.BINDING_LOG_SCHEMA)
    env = _messages(spark, [("a", 5), ("a", 100), ("b", 5)])
    got = sorted((r["topic"], r["decoder"]) for r in route_as_of(env, log).collect())
    assert got == [("a", "x"), ("a", "x"), ("b", None)]


def test_check_bindings_error_order(spark):
    catalog = spark.createDataFrame(
        [("good", 2, "dec"), ("old", 1, "dec"), ("nover", None, "dec"), ("empty", 2, None)],
        S.CATALOG_SCHEMA,
    )
    req = spark.createDataFrame(
        [
            ("t1", "gone", "dec"),
            ("t2", "nover", "dec"),
            ("t3", "old", "dec"),
            ("t4", "good", "nope"),
            ("t5", "good", "dec"),
            ("t6", "empty", "dec"),
        ],
        S.BINDING_SCHEMA,
    )
    got = {r["topic"]: (r["ok"], r["err"]) for r in check_bindings(req, catalog).collect()}
    assert got["t1"] == (False, "gone" + S.MSG_LIBRARY_MISSING_SUFFIX)
    assert got["t2"] == (False, S.MSG_VERSION_SYMBOL_MISSING)
    assert got["t3"] == (False, S.MSG_VERSION_MISMATCH)
    assert got["t4"] == (False, S.MSG_SYMBOL_NOT_FOUND + "nope")
    assert got["t5"] == (True, "")
    assert got["t6"] == (False, S.MSG_SYMBOL_NOT_FOUND + "dec")


def test_binding_file_resolution(spark):
    catalog = spark.createDataFrame(
        [("lib", 2, "decode_quote"), ("lib", 2, S.ANCHOR_SYMBOL), ("lib", 2, "exact"), ("other", 2, "x")],
        S.CATALOG_SCHEMA,
    )
    lines = spark.createDataFrame(
        [
            ("t1 exact",),
            ("t2 quote",),
            ("t3 -",),
            ("t4 missing",),
            ("# comment",),
            ("   ",),
            ("t5 too many words",),
            ("  t6   exact  ",),
            ("t7 x",),
        ],
        "value string",
    )
    got = {r["topic"]: (r["symbol"], r["ok"], r["err"]) for r in bindings_from_text(lines, "lib", catalog).collect()}
    assert got["t1"] == ("exact", True, "")
    assert got["t2"] == ("decode_quote", True, "")
    assert got["t3"] == (S.ANCHOR_SYMBOL, True, "")
    assert got["t4"] == (None, False, S.MSG_SYMBOL_NOT_FOUND + "missing")
    assert got["t5"][1] is False and got["t5"][2] == "bad binding line"
    assert got["t6"] == ("exact", True, "")
    assert got["t7"] == (None, False, S.MSG_SYMBOL_NOT_FOUND + "x")
    assert len(got) == 7


def test_control_log_feeds_check_results(spark):
    """A rejected bind (J4 ok = false) used as `valid` leaves the old binding."""
    catalog = spark.createDataFrame([("lib", 2, "x")], S.CATALOG_SCHEMA)
    req = spark.createDataFrame([("a", "lib", "x"), ("a", "lib", "missing")], S.BINDING_SCHEMA)
    checked = check_bindings(req, catalog)
    log = checked.select(
        F.when(F.col("symbol") == "x", 1).otherwise(2).cast("long").alias("effective_at"),
        F.lit(0).cast("long").alias("seq"),
        F.lit(S.OP_BIND).alias("op"),
        "topic",
        "library",
        "symbol",
        F.col("ok").alias("valid"),
    )
    assert [tuple(r) for r in current_bindings(log).collect()] == [("a", "lib", "x")]


def test_persisted_check_path(spark):
    """A control table is persisted, counted and then
    broadcast from the cache; results are unchanged."""
    from routecast.operators import broadcast as B

    rows = random_log(3)
    log = spark.createDataFrame(rows, S.BINDING_LOG_SCHEMA)
    env = _messages(spark, [(t, x) for t in TOPICS for x in (0, 10, 35, 80)])
    side, small = B.bounded_broadcast(binding_intervals(log))
    assert small and side.storageLevel.useMemory
    got = {r["offset"]: r["decoder"] for r in route_as_of(env, log).collect()}
    for i, (topic, t) in enumerate([(t, x) for t in TOPICS for x in (0, 10, 35, 80)]):
        exp = model_state(rows, upto=t).get(topic)
        assert got[i] == (exp[1] if exp else None)


def test_read_binding_file(spark, tmp_path):
    from routecast.operators.bindings import read_binding_file

    f = tmp_path / "bindings.txt"
    f.write_text("orders exact\n# note\ntrades quote\n\nfx -\n")
    catalog = spark.createDataFrame(
        [("lib", 2, "exact"), ("lib", 2, "decode_quote"), ("lib", 2, S.ANCHOR_SYMBOL)], S.CATALOG_SCHEMA
    )
    got = {r["topic"]: r["symbol"] for r in read_binding_file(spark, str(f), "lib", catalog).collect()}
    assert got == {"orders": "exact", "trades": "decode_quote", "fx": S.ANCHOR_SYMBOL}


def test_message_without_time_gets_latest_binding(spark):
    log = spark.createDataFrame(
        [(10, 0, S.OP_BIND, "a", "lib", "x", True), (20, 1, S.OP_REBIND, "a", "lib", "y", True)],
        S.BINDING_LOG_SCHEMA,
    )
    env = _messages(spark, [("a", -1), ("a", 5), ("a", 15)])
    for max_rows in (1_000_000, 0):
        got = {r["offset"]: r["decoder"] for r in route_as_of(env, log, max_broadcast_rows=max_rows).collect()}
        assert got == {0: "y", 1: None, 2: "x"}


@pytest.mark.parametrize("props", ['{"k":"x"}', '{"k":1e99}', "{}", "not json", None])
def test_sample_control_tables_of_malformed_rows(spark, props):
    """A field that is no number leaves a null, and the job runs."""
    import datetime

    from routecast.plans import samples

    ts = datetime.datetime(2024, 1, 1, 5)
    rows = [(i, ts, i, kind, 1.0, props) for i, kind in enumerate(["click", "view", "purchase", "signup", "error"])]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    for make in (samples.bind_requests, samples.binding_file_lines, samples.events_control_log, samples.bind_request_log):
        assert make(events).count() >= 0 and make(events).collect() is not None
