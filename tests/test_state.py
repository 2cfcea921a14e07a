import random
import time

import pytest
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.operators.bindings import route_as_of
from routecast.operators.stats import event_rate
from routecast.streaming import state as M
from routecast.streaming.stream import file_stream, latest_per_key, start_table_sink

EVENT = "topic string, ingest_ns long, kind string"


def rate_events(seed, n, times):
    rng = random.Random(seed)
    return [(rng.choice("ab"), rng.choice(times) * 10**9 + rng.randrange(10**9) if rng.random() < 0.97 else 0, rng.choice(["data", "error"])) for _ in range(n)]


def fold(spark, folder, keys):
    return latest_per_key(spark, folder, keys)


def plain(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("by", [[], ["topic"]])
def test_live_rate_equals_batch(spark, tmp_path, monkeypatch, by):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    # forward, idle for long, then back before everything, messages without a time throughout
    parts = [rate_events(1, 200, range(5000, 5040)), rate_events(2, 50, range(6100, 6104)), rate_events(3, 80, range(4990, 6110)), rate_events(4, 3, [5020])]
    for part in parts:  # each on a restart of the stream
        spark.createDataFrame(part, EVENT).repartition(2).write.mode("append").parquet(src)
        stream = M.live_rate_totals(file_stream(spark, src, spark.createDataFrame([], EVENT).schema), 2, by)
        with M.rocksdb_state(spark):
            q = start_table_sink(stream, out, ck, "update", available_now=True)
        q.awaitTermination()
    events = spark.createDataFrame([r for p in parts for r in p], EVENT)
    found = fold(spark, out, [*by, "bucket_start_ms"])
    for own in (["a", "b"] if by else [None]):
        want = event_rate(events if own is None else events.where(F.col("topic") == own), 2, dense=True)
        got = found if own is None else found.where(F.col("topic") == own)
        assert plain(got, M.RATE_COLUMNS) == plain(want, M.RATE_COLUMNS)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != M._ROCKSDB


def test_live_rate_without_any_time(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([("a", 0, "data"), ("b", None, "error"), ("b", 0, "data")], EVENT).write.parquet(src)
    with M.rocksdb_state(spark):
        q = start_table_sink(M.live_rate_totals(file_stream(spark, src, spark.read.parquet(src).schema)), out, str(tmp_path / "ck"), "update", available_now=True)
    q.awaitTermination()
    assert [tuple(r) for r in fold(spark, out, ["bucket_start_ms"]).select(*M.RATE_COLUMNS).collect()] == [(0, 3, 3, 2, 1, 3.0)]


def test_idle_intervals_by_timer(spark, tmp_path):
    """While nothing comes, intervals with delta 0 are reported; a message that
    falls into one of them later corrects it."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([("a", 100 * 10**9, "data"), ("a", 101 * 10**9, "error")], EVENT).coalesce(1).write.parquet(src)
    stream = M.live_rate_totals(file_stream(spark, src, spark.read.parquet(src).schema), 1, idle_seconds=1)
    with M.rocksdb_state(spark):
        q = start_table_sink(stream, out, str(tmp_path / "ck"), "update", processing_time="0 seconds")
    try:

        def shown(least):
            end = time.time() + 90
            while time.time() < end:
                try:
                    rows = {r.bucket_start_ms: r for r in fold(spark, out, ["bucket_start_ms"]).collect()}
                except Exception:  # nothing written yet
                    rows = {}
                if len(rows) >= least:
                    return rows
                time.sleep(0.5)
            raise AssertionError(f"{len(rows)} of {least} intervals")

        rows = shown(4)
        assert (rows[103_000].delta, rows[103_000].total, rows[103_000].error, rows[103_000].qps) == (0, 2, 1, 0.0)
        spark.createDataFrame([("a", 103 * 10**9, "data")] * 5, EVENT).coalesce(1).write.mode("append").parquet(src)
        end = time.time() + 60
        while time.time() < end and shown(4)[103_000].delta == 0:
            time.sleep(0.5)
        rows = shown(4)
        assert (rows[102_000].delta, rows[102_000].total) == (0, 2)
        assert (rows[103_000].delta, rows[103_000].total, rows[103_000].qps) == (5, 7, 5.0)
    finally:
        q.stop()


def test_arguments(spark):
    df = spark.createDataFrame([], EVENT)
    for how in ({"interval_seconds": 0}, {"idle_seconds": 0}):
        with pytest.raises(ValueError):
            M.live_rate_totals(df, **how)


def control_log(seed, n, span):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        op = rng.choice([S.OP_BIND, S.OP_REBIND, S.OP_UNBIND, S.OP_SUBSCRIBE, S.OP_BIND])
        bound = op in (S.OP_BIND, S.OP_REBIND)
        out.append((rng.randrange(span), seq, op, rng.choice("abc"), "lib" if bound else None, f"s{seq}" if bound else None, rng.random() < 0.85))
    return out


@pytest.mark.parametrize("keep_ms", [None, 40_000])
def test_route_as_of_stream_equals_batch(spark, tmp_path, keep_ms):
    """Control rows come late and out of order, the stream is restarted after
    every part, and messages come before, with and after their operations."""
    span, lateness = 100_000, 20_000
    log = sorted(control_log(5, 120, span), key=lambda r: r[0] + random.Random(r[1]).randrange(lateness))
    rng = random.Random(6)
    messages = [(rng.choice("abcd"), rng.randrange(3), k, rng.randrange(-1, span) if rng.random() < 0.97 else span - 1, b"k", f"m{k}".encode()) for k in range(900)]
    if keep_ms:  # else messages come in no order at all
        messages.sort(key=lambda r: (r[3] // 30_000, r[2]))
    timeless = [("a", 0, 10_000 + k, -1, None, None) for k in range(3)]
    src, ctl, out, ck = (str(tmp_path / x) for x in ("src", "ctl", "out", "ck"))
    pieces = 4
    for k in range(pieces + 1):
        rows = log[k * 30 : (k + 1) * 30]
        own = messages[k * 225 : (k + 1) * 225]
        if k == pieces:  # the clock passes everything, and then come messages without a time
            rows, own = [(10 * span, 10**6, M.CLOCK_OP, "a", None, None, True)], timeless
        spark.createDataFrame(rows, S.BINDING_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(ctl)
        spark.createDataFrame(own, S.ENVELOPE_SCHEMA).repartition(2).write.mode("append").parquet(src)
        routed = M.route_as_of_stream(
            file_stream(spark, src, S.ENVELOPE_SCHEMA), file_stream(spark, ctl, S.BINDING_LOG_SCHEMA), f"{lateness} milliseconds", salts=3, hold_ms=7000, keep_ms=keep_ms
        )
        with M.rocksdb_state(spark):
            q = start_table_sink(routed, out, ck, "append", available_now=True)
        q.awaitTermination()
    all_messages = spark.createDataFrame([m for m in messages if m[3] >= 0] + timeless, S.ENVELOPE_SCHEMA)
    want = route_as_of(all_messages, spark.createDataFrame(log, S.BINDING_LOG_SCHEMA))
    cols = [*S.ENVELOPE_COLUMNS, "decoder_library", "decoder"]
    found = spark.read.parquet(out).where("timestamp_ms >= 0 OR offset >= 10000")
    key = lambda r: str(r)
    assert sorted(map(tuple, found.select(*cols).collect()), key=key) == sorted(map(tuple, want.select(*cols).collect()), key=key)
