"""Totals, rates and dispatch counts (A1, A2, A3).

All of them are partial + final aggregations: each task pre-aggregates its
rows and only a handful of counters cross the shuffle, so a hot topic or a
hot table never concentrates rows in one task. The only window runs on the
per-bucket table (one row per interval), never on events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.operators.broadcast import computed_once

_NS_PER_SEC = 1_000_000_000


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kind") == S.EVENT_DATA).alias("data"),
        F.count_if(F.col("kind") == S.EVENT_ERROR).alias("error"),
    ]


def event_totals(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A1: total, data and error counts (grand totals, or per ``by``)."""
    if by:
        return events.groupBy(*by).agg(*_counters())
    return events.agg(*_counters())


def floor_div(df: DataFrame, column: Column, divisor: int, name: str) -> DataFrame:
    """Add ``name = floor(column / divisor)`` computed in exact integer math."""
    if divisor <= 0:
        raise ValueError("divisor must be positive")
    tmp = f"_{name}_src"
    return (
        df.withColumn(tmp, column.cast("long"))
        .withColumn(name, F.expr(f"(`{tmp}` - pmod(`{tmp}`, {divisor})) div {divisor}"))
        .drop(tmp)
    )


# Intervals per block in the two-level running sum of A2.
RATE_BLOCK = 4096


def running_sums(
    df: DataFrame,
    key: str,
    value_cols: list[str],
    block: int = RATE_BLOCK,
) -> DataFrame:
    """Add ``<c>_run`` = sum of ``c`` over all rows with a key <= this row's
    key, for a table with a unique long ``key`` (a bucket table).

    Two levels, so no single task sees the whole table: rows are grouped in
    blocks of ``block`` consecutive keys; a window over the block table gives
    each block's starting sums, itself cut once more into blocks of blocks;
    a window partitioned by block adds the running sum inside it.
    """

    def totals(t: DataFrame, by: str, cols: dict[str, str]) -> DataFrame:
        return t.groupBy(by).agg(*[F.sum(c).alias(new) for c, new in cols.items()])

    def starts(t: DataFrame, within: list[str], order: str, cols: dict[str, str]) -> DataFrame:
        w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return t.withColumns({new: F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long") for c, new in cols.items()})

    keyed = floor_div(df, F.col(key), block, "_blk")
    own = {c: f"_{c}" for c in value_cols}
    blocks = floor_div(totals(keyed, "_blk", own), F.col("_blk"), block, "_top")
    top = starts(totals(blocks, "_top", {x: x for x in own.values()}), [], "_top", {x: f"{x}_t" for x in own.values()})
    blocks = starts(blocks, ["_top"], "_blk", {x: f"{x}_b" for x in own.values()}).drop(*own.values())
    bases = blocks.join(top.drop(*own.values()), "_top").drop("_top")
    inside = Window.partitionBy("_blk").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = keyed.join(bases, "_blk", "left")  # the window below needs this partitioning, too
    out = out.withColumns(
        {f"{c}_run": (F.col(f"_{c}_t") + F.col(f"_{c}_b") + F.sum(c).over(inside)).cast("long") for c in value_cols}
    )
    return out.drop("_blk", *[f"_{c}_{x}" for c in value_cols for x in "tb"])


def dense_grid(per_bucket: DataFrame, key: str = "bucket", block: int = RATE_BLOCK) -> DataFrame:
    """Every key between the table's smallest and largest, generated in
    parallel from one row: blocks of blocks first, then the blocks of each,
    then their keys. No array is longer than ``block``, up to a span of
    ``block`` cubed."""
    n = int(per_bucket.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    span = per_bucket.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo IS NOT NULL")

    def level(df: DataFrame, name: str, width: int, of: str | None, spread: bool) -> DataFrame:
        low = F.col("lo") if of is None else F.greatest("lo", F.col(of) * width * block)
        high = F.col("hi") if of is None else F.least("hi", F.col(of) * width * block + (width * block - 1))
        df = df.withColumns({"_a": low, "_z": high})
        df = floor_div(floor_div(df, F.col("_a"), width, "_from"), F.col("_z"), width, "_to")
        df = df.select("lo", "hi", F.explode(F.sequence("_from", "_to")).alias(name))
        return df.repartition(n, name) if spread else df

    top = level(span, "_top", block * block, None, True)
    return level(level(top, "_blk", block, "_top", True), key, 1, "_blk", False).select(key)


def event_rate(
    events: DataFrame,
    interval_seconds: int = 1,
    dense: bool = False,
    time_ns: Column | None = None,
) -> DataFrame:
    """A2: running totals and rate per fixed interval.

    Events fall into tumbling buckets of ``interval_seconds`` by ``ingest_ns``
    (the message time; 0 when unavailable). Per bucket: ``delta`` events,
    running ``total``/``data``/``error`` up to that bucket, and
    ``qps = delta / interval_seconds``. ``dense=True`` also reports idle
    intervals between the first and last bucket with delta 0 (messages
    without a time stay in bucket 0 and do not stretch that span).

    Output: ``bucket_start_ms, delta, total, data, error, qps``.
    """
    if interval_seconds <= 0:
        raise ValueError("interval_seconds must be positive")
    width_ns = interval_seconds * _NS_PER_SEC
    t = time_ns if time_ns is not None else F.col("ingest_ns")
    per_bucket = (
        floor_div(events.select(t.alias("_t"), "kind"), F.col("_t"), width_ns, "bucket")
        .groupBy("bucket")
        .agg(*_counters(), F.max(F.col("_t") > 0).alias("_timed"))
    )
    per_bucket = computed_once(per_bucket)  # one row per interval
    if dense:
        # Fill idle intervals only across messages that carry a time: those
        # without one (ingest_ns 0) keep their own bucket instead of
        # stretching the grid back to the epoch.
        timed = per_bucket.filter(F.col("_timed"))
        per_bucket = dense_grid(timed).join(per_bucket, "bucket", "full").select(
            "bucket",
            *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("total", "data", "error")],
        )
    per_bucket = per_bucket.drop("_timed")
    # Running sums over the bucket table only (one row per interval), in two
    # levels so a long, fine-grained span is not one task.
    run = running_sums(per_bucket, "bucket", ["total", "data", "error"])
    return run.select(
        (F.col("bucket") * F.lit(interval_seconds * 1000)).alias("bucket_start_ms"),
        F.col("total").alias("delta"),
        F.col("total_run").alias("total"),
        F.col("data_run").alias("data"),
        F.col("error_run").alias("error"),
        (F.col("total") / F.lit(float(interval_seconds))).alias("qps"),
    )


def dispatch_counts(drained: DataFrame) -> DataFrame:
    """A3: data rows handed to each target table, ``(tbl, dispatched)``.
    The global count is the sum of the column."""
    return (
        drained.filter(F.col("kind") == S.EVENT_DATA)
        .groupBy("tbl")
        .agg(F.count(F.lit(1)).alias("dispatched"))
    )
