"""A hot topic holding a third of all messages: no operator may gather it in
one task or shuffle payloads because of it."""

from pyspark.sql import functions as F

from routecast.operators.bindings import current_bindings
from routecast.operators.paging import drain_pages
from routecast.operators.routing import decode, to_drain
from routecast.operators.stats import event_totals, floor_div
from routecast.plans import samples
from routecast.sources.envelopes import events_envelopes, read_table

SF = "/root/testdata/sf0.01"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_envelopes(spark):
    table = read_table(spark, SF, "events")
    hot = F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit("hot")).otherwise(F.col("event_type"))
    return events_envelopes(table.withColumn("event_type", hot))


def test_hot_topic_decode_shuffles_no_messages(spark):
    env = hot_envelopes(spark)
    bindings = samples.bindings_df(spark, [("hot", samples.SAMPLE_LIBRARY, "json_k")] + samples.EVENT_BINDINGS)
    drained = to_drain(decode(env, bindings, samples.sample_registry(), samples.EVENT_TOPICS))
    plan = plan_text(drained)
    # one hash exchange: the aggregation that builds the (tiny) binding table
    messages = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in messages and "SinglePartition" not in plan
    counts = {r["tbl"]: r["count"] for r in drained.groupBy("tbl").count().collect()}
    assert counts["json_k"] >= env.count() // 3


def test_hot_topic_pages_stay_bounded(spark):
    env = hot_envelopes(spark)
    width = 512
    keyed = floor_div(env, F.col("offset"), width, "_b")
    biggest = keyed.groupBy("topic", "partition", "_b").count().agg(F.max("count")).first()[0]
    assert biggest <= width  # the largest window partition W1 can meet
    paged = drain_pages(env, limit=1000, bucket_width=width)
    rows = paged.select("topic", "partition", "offset", "pos").collect()
    order = sorted((r["topic"], r["partition"], r["offset"]) for r in rows)
    by_pos = [(r["topic"], r["partition"], r["offset"]) for r in sorted(rows, key=lambda r: r["pos"])]
    assert by_pos == order


def test_hot_key_aggregations_combine_map_side(spark):
    env = hot_envelopes(spark)
    events = decode(env, samples.event_bindings(spark), samples.sample_registry(), samples.EVENT_TOPICS)
    assert "partial_count" in plan_text(event_totals(events, by=["topic"]))
    log = samples.events_control_log(
        read_table(spark, SF, "events").withColumn("user_id", F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    )
    assert "partial_max(" in plan_text(current_bindings(log))
