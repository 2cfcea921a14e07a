"""A1-A3 helpers against plain Python, and P1 on Kafka-shaped rows."""

import datetime as dt
import random

import pytest

from routecast.operators.stats import dense_grid, event_rate, event_totals, running_sums
from routecast.sources.envelopes import kafka_to_envelope


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
def test_running_sums_match_cumsum(spark, block):
    rnd = random.Random(block)
    keys = sorted(rnd.sample(range(-50, 500), 80))
    rows = [(k, rnd.randint(0, 9), rnd.randint(0, 3)) for k in keys]
    df = spark.createDataFrame(rows, "k long, a long, b long")
    got = {r["k"]: (r["a_run"], r["b_run"]) for r in running_sums(df, "k", ["a", "b"], block=block).collect()}
    acc_a = acc_b = 0
    for k, a, b in rows:
        acc_a += a
        acc_b += b
        assert got[k] == (acc_a, acc_b), k


@pytest.mark.parametrize("block", [1, 2, 4, 4096])
def test_dense_grid_covers_span(spark, block):
    df = spark.createDataFrame([(-5,), (3,), (17,)], "bucket long")
    got = sorted(r["bucket"] for r in dense_grid(df, block=block).collect())
    assert got == list(range(-5, 18))


def test_event_rate_sparse_and_dense(spark):
    s = 1_000_000_000
    rows = [(0 * s, "data"), (1 * s, "error"), (1 * s + 5, "data"), (5 * s, "data")]
    ev = spark.createDataFrame(rows, "ingest_ns long, kind string")
    sparse = [tuple(r) for r in event_rate(ev, 1).orderBy("bucket_start_ms").collect()]
    assert sparse == [(0, 1, 1, 1, 0, 1.0), (1000, 2, 3, 2, 1, 2.0), (5000, 1, 4, 3, 1, 1.0)]
    dense = [tuple(r) for r in event_rate(ev, 1, dense=True).orderBy("bucket_start_ms").collect()]
    assert [r[0] for r in dense] == [0, 1000, 2000, 3000, 4000, 5000]
    assert dense[2] == (2000, 0, 3, 2, 1, 0.0)
    totals = event_totals(ev).collect()[0]
    assert (totals["total"], totals["data"], totals["error"]) == (4, 3, 1)


def test_kafka_rows_to_envelopes(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179000, tzinfo=dt.timezone.utc)
    rows = [
        (b"k", b"v", "t", 3, 42, ts, 0),
        (None, None, "t", 0, 43, None, -1),
    ]
    kdf = spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    )
    env = {r["offset"]: r for r in kafka_to_envelope(kdf).collect()}
    assert env[42]["timestamp_ms"] == 1704067207179 and bytes(env[42]["payload"]) == b"v"
    assert env[43]["timestamp_ms"] == -1 and env[43]["payload"] is None and env[43]["partition"] == 0


def test_epoch_millis_ignores_session_time_zone(spark):
    from routecast.sources.envelopes import epoch_millis_ntz

    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-10 02:30:00.5'), (TIMESTAMP_NTZ'2024-01-01 00:00:07.179575'),"
        " (TIMESTAMP_NTZ'1969-12-31 23:59:59.9995') AS t(ts)"
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = [r[0] for r in df.select(epoch_millis_ntz("ts")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1710037800500, 1704067207179, -1]


def test_dense_rate_over_eighty_years(spark):
    s = 1_000_000_000
    ev = spark.createDataFrame([(1000 * s, "data"), (80 * 366 * 86400 * s, "error")], "ingest_ns long, kind string")
    hours = event_rate(ev, 3600, dense=True)
    assert hours.count() == 80 * 366 * 24 + 1
    assert hours.orderBy(hours.bucket_start_ms.desc()).first()["total"] == 2
    # windows without a partition see blocks of blocks only
    plan = event_rate(ev, 1, dense=True)._jdf.queryExecution().optimizedPlan().toString()
    alone = [x for x in plan.splitlines() if "Window [" in x and "windowspecdefinition(_top" in x]
    assert alone and all("windowspecdefinition(_top" in x or "windowspecdefinition(_blk" in x for x in plan.splitlines() if "Window [" in x)


def test_dense_rate_is_not_stretched_by_untimed_messages(spark):
    s = 1_000_000_000
    rows = [(0, "error"), (1000 * s, "data"), (1003 * s, "data")]
    ev = spark.createDataFrame(rows, "ingest_ns long, kind string")
    dense = [tuple(r) for r in event_rate(ev, 1, dense=True).orderBy("bucket_start_ms").collect()]
    assert [r[0] for r in dense] == [0, 1_000_000, 1_001_000, 1_002_000, 1_003_000]
    assert dense[0][1:5] == (1, 1, 0, 1) and dense[-1][2] == 3
