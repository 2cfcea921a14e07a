"""Drain pages (W1): every row in exactly one page, pages <= limit, global
order (topic, partition, offset), independent of bucket width and of the
broadcast fallback."""

import pytest
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.operators.paging import drain_pages, effective_limit
from routecast.sources.envelopes import read_events

SF = "/root/testdata/sf0.001"


def test_limit_rules():
    assert effective_limit(None) == 4096
    assert effective_limit(0) == 1
    assert effective_limit(-3) == 1
    assert effective_limit(10) == 10


@pytest.mark.parametrize("limit,width,max_rows", [(100, 1 << 20, 1_000_000), (37, 50, 0), (1, 1000, 1_000_000)])
def test_pages_partition_input_in_order(spark, limit, width, max_rows):
    env = read_events(spark, SF)
    paged = drain_pages(env, limit=limit, bucket_width=width, max_broadcast_rows=max_rows)
    rows = paged.select("topic", "partition", "offset", "pos", "page").collect()
    n = env.count()
    assert len(rows) == n
    expected = sorted((r["topic"], r["partition"], r["offset"]) for r in rows)
    by_pos = sorted(rows, key=lambda r: r["pos"])
    assert [r["pos"] for r in by_pos] == list(range(n))
    assert [(r["topic"], r["partition"], r["offset"]) for r in by_pos] == expected
    sizes = {}
    for r in rows:
        assert r["page"] == r["pos"] // limit
        sizes[r["page"]] = sizes.get(r["page"], 0) + 1
    assert max(sizes.values()) <= limit
    assert sorted(sizes) == list(range(len(sizes)))


def test_default_limit_pages(spark):
    env = read_events(spark, "/root/testdata/sf0.01")
    sizes = sorted(
        tuple(r) for r in drain_pages(env).groupBy("page").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    assert sizes == [(0, 4096), (1, 4096), (2, 1808)]
    assert S.DRAIN_LIMIT_DEFAULT == 4096


def _positions(df):
    return sorted((r["topic"], r["partition"], r["offset"], r["pos"], r["page"]) for r in df.collect())


def _check(df, limit=37, **kw):
    rows = drain_pages(df, limit=limit, **kw).collect()
    assert len(rows) == df.count()
    assert sorted(r["pos"] for r in rows) == list(range(len(rows)))
    assert all(r["page"] == r["pos"] // limit for r in rows)
    order = lambda r: (r["topic"] or "", r["partition"] or -1, r["offset"] is not None, r["offset"] or 0)
    keys = [order(r) for r in sorted(rows, key=lambda r: r["pos"])]
    assert keys == sorted(keys)


def test_positions_do_not_depend_on_where_rows_lie(spark):
    env = read_events(spark, SF).select("topic", "partition", "offset")
    shuffled = env.repartition(4)
    assert _positions(drain_pages(shuffled, limit=37)) == _positions(drain_pages(env, limit=37))
    by_aqe = env.join(env.groupBy("topic").count(), "topic")
    assert _positions(drain_pages(by_aqe, limit=37)) == _positions(drain_pages(env, limit=37))


def test_many_topics_of_one_message_after_a_repartition(spark):
    df = spark.range(200).select(F.concat(F.lit("t"), "id").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"))
    _check(df.repartition(4))
    _check(df.repartition(4).withColumn("more", F.lit("x")), bucket_width=1)


def test_rows_without_offset_after_a_repartition(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 3 > 0, F.lit("t")).alias("topic"), F.lit(0).alias("partition"),
        F.when(F.col("id") % 2 > 0, F.col("id")).alias("offset"), F.col("id").cast("string").cast("binary").alias("payload"),
    )
    _check(df.repartition(4))
    _check(df.unionByName(df).repartition(4), max_broadcast_rows=0)  # repeated rows, plain joins


def test_rows_without_offsets_are_spread_and_paged(spark):
    from pyspark.sql import functions as F2

    env = read_events(spark, SF).withColumn("offset", F2.lit(None).cast("long"))
    paged = drain_pages(env, limit=100, bucket_width=64)
    rows = paged.select("topic", "partition", "pos", "page").collect()
    assert sorted(r["pos"] for r in rows) == list(range(len(rows)))
    by_key = {}
    for r in rows:
        by_key.setdefault((r["topic"], r["partition"]), []).append(r["pos"])
    spans = sorted((min(v), max(v)) for v in by_key.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # (topic, partition) order kept


def test_a_decoder_that_is_not_repeatable(spark):
    """Each message is decoded once, so fresh answers change no position."""
    import uuid

    from routecast.functions.decoders import DecodeOut, DecoderRegistry
    from routecast.operators.routing import decode
    from routecast.plans.samples import bindings_df

    reg = DecoderRegistry()

    @reg.python("fresh", library="lib")
    def fresh(env):
        return DecodeOut(data=uuid.uuid4().bytes)

    env = read_events(spark, SF).withColumn("offset", F.lit(None).cast("long"))
    topics = [r.topic for r in env.select("topic").distinct().collect()]
    events = decode(env, bindings_df(spark, [(t, "lib", "fresh") for t in topics]), reg)
    paged = drain_pages(events, limit=16)
    assert "ArrowEvalPython" not in paged._jdf.queryExecution().toString()
    rows = paged.collect()
    assert sorted(r["pos"] for r in rows) == list(range(env.count()))
    assert len({bytes(r["data"]) for r in rows}) == len(rows)


def test_equal_rows_without_an_offset_are_spread(spark):
    """20,000 equal messages: no bucket holds more than its width, and a page
    has exactly its limit."""
    from routecast.operators.paging import stored_events

    equal = spark.range(20_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(None).cast("long").alias("offset"))
    paged = drain_pages(equal.repartition(3), limit=100, bucket_width=512)
    sizes = paged.groupBy("page").count().collect()
    assert len(sizes) == 200 and {r["count"] for r in sizes} == {100}
    assert paged.agg(F.count_distinct("pos")).first()[0] == 20_000
    rows = stored_events(equal.repartition(3))
    assert rows.select("_file", "_place").distinct().count() == 20_000
    assert rows.groupBy("_file", F.expr("_place div 512")).count().agg(F.max("count")).first()[0] <= 512
