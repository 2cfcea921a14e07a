"""Structured Streaming surface.

* **T1** ``decode_stream``: the batch ``decode`` applied to a streaming
  DataFrame (stateless, append; the binding table is a broadcast static side).
* **S6** bounded intake: ``maxFilesPerTrigger`` for file streams
  (``maxOffsetsPerTrigger`` for Kafka, see ``sources.kafka``).
* **S7** routed sink: every micro-batch is written once, partitioned by
  ``kind`` and ``tbl``, to ``<path>/batch_id=<n>/attempt=<fresh name>``, and
  then published by one small record (``streaming.published``). A reader
  (``read_routed``) sees a batch as its last published attempt left it, whole
  or not at all: a replayed batch replaces its rows in one step. Data rows sit
  under ``kind=data/tbl=<t>``, error rows under ``kind=error``. Or the batch
  goes to a function per target (``streaming.dispatch``).
* **T2** live rebinding: the binding table is re-read at the start of every
  micro-batch (``foreachBatch``), so a change reaches every later batch
  without a restart. Use ``route_as_of`` when the cut-over must fall on an
  exact message.
* **T3** live totals (complete mode) and per-interval counts (update mode).
  No watermark: no row is ever dropped as late; the state holds one row per
  interval seen.
* **S5** progress lives in the checkpoint under the cluster's shared
  checkpoint folder (``spark.checkpoint.dir``), one per stream name, so that a
  restart goes on where the last run ended. A sink belongs to the checkpoint
  that first wrote it and refuses any other, whose batch numbers would start
  over and replace its output.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from routecast.functions.decoders import DecoderRegistry
from routecast.operators.bindings import check_bindings
from routecast.operators.paging import drain_pages
from routecast.operators.routing import decode, to_drain
from routecast.operators.stats import event_totals
from routecast.session import checkpoint_root, scratch_folder
from routecast.sources.envelopes import table_path
from routecast.sources.local import local_table
from routecast.streaming.published import BatchRecords

BindingsLoader = Callable[[SparkSession, int], DataFrame]
BatchSink = Callable[[DataFrame, int], object]


# ---------------------------------------------------------------------------
# Sources (S2 / S6 on streams)
# ---------------------------------------------------------------------------


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A file stream over ``path`` (directory or glob), at most
    ``max_files_per_trigger`` new files per micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max(1, int(max_files_per_trigger))))
    return reader.load(path)


def single_file_glob(path: str) -> str:
    """A glob matching exactly one file: file streams need a directory or a
    pattern, not a file path."""
    return path[:-1] + "[" + path[-1] + "]"


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One provided table as a file stream."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    return file_stream(spark, single_file_glob(path), schema, max_files_per_trigger=max_files_per_trigger)


# ---------------------------------------------------------------------------
# Continuous decode
# ---------------------------------------------------------------------------


def decode_stream(
    envelopes: DataFrame,
    bindings: DataFrame,
    registry: DecoderRegistry,
    topics: Iterable[str] | None = None,
    skip_policy: str = "error",
) -> DataFrame:
    """The batch decode on a streaming DataFrame (stateless)."""
    return decode(envelopes, bindings, registry, topics=topics, skip_policy=skip_policy)


# ---------------------------------------------------------------------------
# Routed, idempotent sink
# ---------------------------------------------------------------------------


def batch_path(path: str, batch_id: int) -> str:
    return os.path.join(path, f"batch_id={int(batch_id)}")


def write_routed(
    drained: DataFrame,
    path: str,
    batch_id: int,
    fmt: str = "parquet",
    rebalance: bool = True,
    max_records_per_file: int | None = None,
) -> None:
    """Write one drained batch, data and error rows in one pass, and
    publish it. An attempt that fails leaves nothing that is read.

    ``rebalance`` (default) asks AQE to group rows by ``(kind, tbl)`` into
    evenly sized partitions before the write: one batch then makes a few
    files per target table instead of one per task and table, and a hot table
    is split over several tasks. It costs one shuffle of the batch; turn it
    off for the lowest latency.

    ``max_records_per_file`` bounds every output file (the sink-side form of
    a bounded drain: a consumer reading file by file never gets more than
    that many rows at once).
    """
    own = [f.jsonValue() for f in drained.schema.fields if f.name not in ("kind", "tbl")]
    attempt = uuid.uuid4().hex
    if rebalance:
        drained = drained.hint("rebalance", "kind", "tbl")
    writer = drained.write
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", str(max(1, int(max_records_per_file))))
    writer.partitionBy("kind", "tbl").format(fmt).save(attempt_path(path, batch_id, attempt))
    BatchRecords(path).publish(batch_id, {"attempt": attempt, "fields": own})


def attempt_path(path: str, batch_id: int, attempt: str) -> str:
    return os.path.join(batch_path(path, batch_id), f"attempt={attempt}")


def read_routed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The published batches of a routed sink: ``(data, err, topic, batch_id,
    kind, tbl)``, and the columns kept. A column that some batches lack is null
    there. Without any batch, no rows."""
    found = BatchRecords(path).read()
    fields = {f["name"]: f for record in found.values() for f in record["fields"]}
    if not found:
        return local_table(spark, [], "topic string, data binary, err string, batch_id long, kind string, tbl string")
    schema = StructType.fromJson({"type": "struct", "fields": list(fields.values())})
    for name, kind in (("batch_id", "long"), ("attempt", "string"), ("kind", "string"), ("tbl", "string")):
        schema = schema.add(name, kind)
    folders = [attempt_path(path, n, record["attempt"]) for n, record in found.items()]
    return spark.read.schema(schema).format(fmt).option("basePath", path).load(folders).drop("attempt")


def vacuum_routed(path: str, older_than_seconds: float = 7 * 86_400) -> list[str]:
    """Delete attempts that failed or were replaced, once they are older than
    any reader or writer that may still use them."""
    return BatchRecords(path).remove_unpublished(older_than_seconds)


def routed_batch_writer(
    path: str,
    registry: DecoderRegistry,
    bindings_loader: BindingsLoader,
    topics: Iterable[str] | None = None,
    skip_policy: str = "error",
    rebalance: bool = True,
    drain_limit: int | None = None,
    label_bindings: BindingsLoader | None = None,
    catalog: DataFrame | None = None,
    keep: Iterable[str] = (),
    sink: BatchSink | None = None,
) -> Callable[[DataFrame, int], None]:
    """T2 + S7: a ``foreachBatch`` function that re-reads the binding table
    for each micro-batch, decodes, drains and writes the batch.

    ``catalog`` (J4): bindings that it rejects count as not made.
    ``label_bindings`` (J3): the binding table as it stands at drain, loaded
    after the decode is planned; by default the table of the decode.
    ``drain_limit`` (S6 / W1 inside the batch) adds ``pos`` and ``page`` to
    every row: pages of at most that many rows in ``(topic, partition,
    offset)`` order within the batch, which a consumer can read one by one.
    Columns of the events named in ``keep`` are written, too.
    ``sink``: takes the drained batch in place of the folder, for example a
    ``streaming.dispatch.Dispatcher``.
    """
    stored: list[str] = []
    topic_list = list(topics) if topics is not None else None

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bindings = bindings_loader(spark, batch_id)
        if catalog is not None:
            bindings = check_bindings(bindings, catalog).where("ok").select("topic", "library", "symbol")
        events = decode(batch, bindings, registry, topics=topic_list, skip_policy=skip_policy)
        if drain_limit is not None:
            # the batch before is done: its stored events make room
            if not stored:
                stored.append(scratch_folder(spark, "drain"))
            events = drain_pages(events, limit=drain_limit, stored=stored[0])
        labels = None if label_bindings is None else label_bindings(spark, batch_id)
        more = [*keep, *(("pos", "page") if drain_limit is not None else ())]
        drained = to_drain(events, label_bindings=labels, keep=more)
        if sink is not None:
            sink(drained, batch_id)
        else:
            write_routed(drained, path, batch_id, rebalance=rebalance)

    return run


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """The checkpoint folder of the stream ``name``, the same at every
    start."""
    return os.path.join(checkpoint_root(spark), "routecast", name)


def claim_sink(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Record that the sink at ``path`` belongs to ``checkpoint``; an error if
    it belongs to another, or holds batches of an unknown one."""
    jvm = spark._jvm
    owner = jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_owner"))
    files = owner.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(owner):
        found = spark.read.text(owner.toString()).first()
        if found is None or found[0] != checkpoint:
            raise ValueError(f"the sink {path} belongs to the checkpoint {found and found[0]}")
        return
    if files.exists(owner.getParent()) and len(files.listStatus(owner.getParent())):
        raise ValueError(f"the sink {path} holds output of another run")
    local_table(spark, [(checkpoint,)], "value string").coalesce(1).write.text(owner.toString())


def start_routed(
    envelopes: DataFrame,
    path: str,
    registry: DecoderRegistry,
    bindings_loader: BindingsLoader,
    checkpoint: str,
    topics: Iterable[str] | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    query_name: str | None = None,
    rebalance: bool = True,
    drain_limit: int | None = None,
    skip_policy: str = "error",
    label_bindings: BindingsLoader | None = None,
    catalog: DataFrame | None = None,
    keep: Iterable[str] = (),
    sink: BatchSink | None = None,
) -> StreamingQuery:
    """Start T1 + T2 + S7: decode every micro-batch with the bindings of that
    moment and write it to the routed sink (paged when ``drain_limit`` is
    set); see :func:`routed_batch_writer`."""
    claim_sink(envelopes.sparkSession, path, checkpoint)
    run = routed_batch_writer(
        path, registry, bindings_loader, topics, skip_policy, rebalance, drain_limit, label_bindings, catalog, keep, sink
    )
    writer = envelopes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


# ---------------------------------------------------------------------------
# Live totals and rate
# ---------------------------------------------------------------------------


def live_totals(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Running total/data/error (complete output mode)."""
    return event_totals(events, by)


def live_rate(events: DataFrame, interval_seconds: int = 1, watermark: str | None = None) -> DataFrame:
    """Per-interval total/data/error by message time (update output
    mode).

    By default there is no watermark, so nothing is dropped as late and the
    state keeps one row per interval seen. ``watermark`` (e.g. ``"1 hour"``)
    bounds that state for long-running streams, at the price of dropping
    messages older than the watermark: an explicit choice, off by default.
    """
    ts = F.expr("timestamp_micros(ingest_ns div 1000)")
    if watermark:
        events = events.withColumn("_event_time", ts).withWatermark("_event_time", watermark)
        ts = F.col("_event_time")
    counted = events.groupBy(F.window(ts, f"{int(interval_seconds)} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kind") == "data").alias("data"),
        F.count_if(F.col("kind") == "error").alias("error"),
    )
    return counted.select(
        F.unix_millis(F.col("w.start")).alias("window_start_ms"), "total", "data", "error"
    )


def start_table_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Write a streaming aggregate to ``<path>/batch_id=<n>`` per micro-batch
    (overwrite per batch, so replays are idempotent)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(path, batch_id))

    claim_sink(df.sparkSession, path, checkpoint)
    writer = (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def latest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Fold update-mode output back into one row per key: the row of the
    latest batch wins. With no key, the latest batch's rows."""
    df = spark.read.option("basePath", path).parquet(path)
    value_cols = [c for c in df.columns if c not in keys and c != "batch_id"]
    if not keys:
        last = df.agg(F.max("batch_id").alias("_last"))
        return df.join(last, df["batch_id"] == last["_last"]).select(*value_cols)
    return df.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.col("batch_id")).alias(c) for c in value_cols]
    )
