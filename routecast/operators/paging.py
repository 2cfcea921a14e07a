"""Drain pages (W1, batch form of the bounded drain S6).

Every message lands in exactly one page and every page holds at most
``limit`` messages, in the order ``(topic, partition, offset)``; messages
without an offset come first in their ``(topic, partition)``, in the order in
which they were stored.

The events are written once, below the shared folder: a decoder runs once for
each message, and need not give the same answer twice. From there on:

1. each message gets a bucket ``offset div bucket_width`` inside its
   ``(topic, partition)``; offsets are unique there, so a bucket holds at
   most ``bucket_width`` messages whatever the skew between topics. Those
   without an offset go by their place in the stored files, as many to a
   bucket, however many of them are equal;
2. messages are counted per bucket (partial aggregation; small table);
3. running counts give each bucket's first global position: over the
   ``(topic, partition)`` totals, within one over blocks of buckets, and
   within a block over its buckets;
4. that table is joined back (broadcast when within its bound) and a
   ``row_number`` inside each bucket gives the message's position ``pos``;
5. ``page = pos div limit``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.operators.broadcast import MAX_BROADCAST_ROWS, bounded_broadcast, computed_once
from routecast.operators.stats import floor_div
from routecast.session import scratch_folder

DEFAULT_BUCKET_WIDTH = 1 << 14  # messages, with their payloads, in one sort
PLACE_BITS = 32  # low bits of a bucket by place; the others are of the file's hash
BLOCK = 4096  # buckets of one block


def effective_limit(limit: int | None) -> int:
    """Drain limit rule: unset -> 4096; anything below 1 -> 1."""
    if limit is None:
        return S.DRAIN_LIMIT_DEFAULT
    return max(S.DRAIN_LIMIT_MIN, int(limit))


_PART = ["topic", "partition", "_has_offset"]


def _before(table: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """Rows counted before each row of its group."""
    upto = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return table.withColumn(name, F.coalesce(F.sum("_n").over(upto), F.lit(0)).cast("long"))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r{k}" for k in keys])


def bucket_bases(counts: DataFrame) -> DataFrame:
    """First global position (``_base``) of each bucket."""
    counts = floor_div(counts, F.col("_bucket"), BLOCK, "_block")
    blocks = counts.groupBy(*_PART, "_block").agg(F.sum("_n").alias("_n"))
    whole = blocks.groupBy(*_PART).agg(F.sum("_n").alias("_n"))  # one row per (topic, partition)
    whole = _before(whole, [], _PART, "_b0").drop("_n")
    blocks = _before(blocks, _PART, ["_block"], "_b1").drop("_n")
    buckets = _before(counts, [*_PART, "_block"], ["_bucket"], "_b2").drop("_n")
    joined = _null_safe(_null_safe(buckets, blocks, [*_PART, "_block"], "inner"), whole, _PART, "inner")
    return joined.select(*_PART, "_bucket", (F.col("_b0") + F.col("_b1") + F.col("_b2")).alias("_base"))


def stored_events(events: DataFrame, path: str | None = None) -> DataFrame:
    """``events`` written to ``path`` (overwritten; by default a new scratch
    folder) and read back with ``_file`` and ``_place``, each row's file (as a
    hash) and its number there. Neither changes when a task runs again."""
    spark = events.sparkSession
    path = path or scratch_folder(spark, "events")
    events.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(events.schema).parquet(path)
    return rows.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))


def drain_pages(
    events: DataFrame,
    limit: int | None = S.DRAIN_LIMIT_DEFAULT,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    stored: str | None = None,
) -> DataFrame:
    """Add ``pos`` (0-based global position) and ``page`` to each row.
    ``stored``: a folder for the events, which must stay as long as the result
    is used; by default one that goes when the driver ends."""
    lim = effective_limit(limit)
    keys = [*_PART, "_bucket"]
    keyed = stored_events(events, stored).withColumn("_has_offset", F.col("offset").isNotNull())
    keyed = floor_div(keyed, F.col("offset"), bucket_width, "_by_offset")
    # a file's places count on from a start that its hash gives
    keyed = floor_div(keyed, F.col("_place"), bucket_width, "_by_place")
    place = F.shiftleft(F.shiftright("_file", PLACE_BITS), PLACE_BITS) + F.col("_by_place")
    keyed = keyed.withColumn("_bucket", F.coalesce("_by_offset", place)).drop("_by_offset", "_by_place")
    counts = computed_once(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    side, _ = bounded_broadcast(bucket_bases(counts), max_broadcast_rows)
    in_bucket = Window.partitionBy(*keys).orderBy("offset", "_file", "_place")
    numbered = keyed.withColumn("_rn", F.row_number().over(in_bucket))
    joined = _null_safe(numbered, side, keys, "left")
    pos = (F.col("_base") + F.col("_rn") - 1).cast("long")
    paged = joined.withColumn("pos", pos).withColumn("page", F.expr(f"pos div {lim}"))
    return paged.drop("_has_offset", "_bucket", "_file", "_place", "_rn", "_base")
