"""Stateful streams by ``transformWithState``.

* **T3** ``live_rate_totals``: a running total, data, error, qps and delta of
  every interval, with idle intervals as delta 0, in update mode.
* **J2** ``route_as_of_stream``: messages meet the binding that was in force at
  their own time, though control operations come on a stream of their own, and
  late.

Both need the RocksDB state store; start their queries inside
:func:`rocksdb_state`.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from routecast import schema as S
from routecast.session import ship_package

if TYPE_CHECKING:
    import pandas as pd

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a query takes the
    setting along when it starts, so other queries are not touched."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


# ---------------------------------------------------------------------------
# Running totals and rate
# ---------------------------------------------------------------------------

RATE_BLOCK = 512  # intervals whose sums are kept together
_COUNTS = ("delta", "data", "error")


class LiveRate(StatefulProcessor):
    """One key's intervals. Sums are kept per interval and per block of
    ``RATE_BLOCK`` of them, so the totals before an interval take as many reads
    as there are blocks and a block's intervals. An interval that changes is
    reported again with all after it, whose totals change, too."""

    def __init__(self, by: list[str], interval_seconds: int, idle_seconds: int | None):
        self.by, self.width, self.idle = by, interval_seconds, idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        counts = "n long, data long, error long"
        self.buckets = handle.getMapState("buckets", "bucket long", counts)
        self.blocks = handle.getMapState("blocks", "block long", counts)
        # the first and last interval by a message's time, and the last one reported
        self.span = handle.getValueState("span", "first long, last long, shown long, due long")

    def _add(self, state, key: int, more: tuple[int, int, int]) -> None:
        old = state.getValue((key,)) if state.containsKey((key,)) else (0, 0, 0)
        state.updateValue((key,), tuple(int(a) + int(b) for a, b in zip(old, more)))

    def _before(self, bucket: int) -> np.ndarray:
        """Sums of all intervals before ``bucket``."""
        block, total = bucket // RATE_BLOCK, np.zeros(3, np.int64)
        for (key,), value in self.blocks.iterator():
            if key < block:
                total += np.array(value, np.int64)
        for b in range(block * RATE_BLOCK, bucket):
            if self.buckets.containsKey((b,)):
                total += np.array(self.buckets.getValue((b,)), np.int64)
        return total

    def _rows(self, key, buckets: list[int]) -> pd.DataFrame:
        """Reports of ``buckets`` (ascending; all known ones from the first on)."""
        import pandas as pd

        total, out = self._before(buckets[0]), []
        for b in buckets:
            own = np.array(self.buckets.getValue((b,)) if self.buckets.containsKey((b,)) else (0, 0, 0), np.int64)
            total = total + own
            out.append((*key, b * self.width * 1000, int(own[0]), *map(int, total), int(own[0]) / self.width))
        return pd.DataFrame(out, columns=[*self.by, *RATE_COLUMNS])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        changed: dict[int, np.ndarray] = {}
        timed = []
        for part in rows:
            for b, t, *counts in part[["bucket", "timed", *_COUNTS]].itertuples(index=False):
                changed[int(b)] = changed.get(int(b), np.zeros(3, np.int64)) + np.array(counts, np.int64)
                if t:
                    timed.append(int(b))
        for b, counts in changed.items():
            self._add(self.buckets, b, tuple(counts))
            self._add(self.blocks, b // RATE_BLOCK, tuple(counts))
        first, last, shown, due = self.span.get() if self.span.exists() else (None, None, None, None)
        if timed:
            first = min(timed) if first is None else min(first, *timed, first)
            last = max(timed) if last is None else max(last, *timed, last)
            # intervals that were shown as idle stay shown
            shown = last if shown is None else max(shown, last)
        if self.idle is not None and first is not None:
            if due is not None:
                self.handle.deleteTimer(due)
            due = timerValues.getCurrentProcessingTimeInMs() + self.idle * 1000
            self.handle.registerTimer(due)
        self.span.update((first, last, shown, due))
        least = min(changed)
        # messages without a time have bucket 0, apart from the dense span
        alone = [0] if self.buckets.containsKey((0,)) and least == 0 and (first is None or first > 0) else []
        dense = [] if first is None else list(range(max(first, least), shown + 1))
        for i in range(0, len(alone + dense), 4096):
            yield self._rows(key, (alone + dense)[i : i + 4096])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Nothing came for ``idle_seconds``: one more interval, with delta 0."""
        first, last, shown, _ = self.span.get()
        due = timerValues.getCurrentProcessingTimeInMs() + self.idle * 1000
        self.handle.registerTimer(due)
        self.span.update((first, last, shown + 1, due))
        yield self._rows(key, [shown + 1])

    def close(self) -> None:
        pass


RATE_COLUMNS = ["bucket_start_ms", "delta", "total", "data", "error", "qps"]


def live_rate_totals(
    events: DataFrame, interval_seconds: int = 1, by: list[str] | None = None, idle_seconds: int | None = None
) -> DataFrame:
    """``event_rate(dense=True)`` as a stream, in update mode:
    ``bucket_start_ms, delta, total, data, error, qps`` of every interval that
    a micro-batch changes, in whole or in its totals, and of idle ones between.
    The last report of an interval holds. Messages may come in any order and
    none is dropped as late.

    Counts are summed in each Arrow batch before the shuffle, so a task sends
    a few rows for each interval, whatever its messages; ``by`` columns (for
    example ``topic``) make a key of their own each. With ``idle_seconds``, a
    timer reports one more interval with delta 0 whenever nothing came for that
    long. Processing-time timers make the engine run batches without data.
    """
    if interval_seconds <= 0 or (idle_seconds is not None and idle_seconds <= 0):
        raise ValueError("interval_seconds and idle_seconds must be positive")
    ship_package(events.sparkSession)
    by = list(by or [])
    width = interval_seconds * 1_000_000_000
    key_fields = [events.schema[c] for c in by]
    keys = by or ["_all"]
    counts = [T.StructField(c, T.LongType()) for c in ("bucket", *_COUNTS)]
    summed = T.StructType([*key_fields, *([] if by else [T.StructField("_all", T.IntegerType())]), T.StructField("timed", T.BooleanType()), *counts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by([*keys, "bucket", "timed"]).aggregate([(c, "sum") for c in _COUNTS])
            t = t.rename_columns([*keys, "bucket", "timed", *_COUNTS]).select(summed.names)
            yield from t.combine_chunks().to_batches()

    ns = F.coalesce(F.col("ingest_ns"), F.lit(0))
    own = events.select(
        *by,
        *([] if by else [F.lit(0).alias("_all")]),
        F.expr("(coalesce(ingest_ns, 0) - pmod(coalesce(ingest_ns, 0), {0})) div {0}".format(width)).alias("bucket"),
        (ns > 0).alias("timed"),
        F.lit(1).cast("long").alias("delta"),
        (F.col("kind") == S.EVENT_DATA).cast("long").alias("data"),
        (F.col("kind") == S.EVENT_ERROR).cast("long").alias("error"),
    )
    out = [*key_fields] if by else [T.StructField("_all", T.IntegerType())]
    out += [T.StructField(c, T.DoubleType() if c == "qps" else T.LongType()) for c in RATE_COLUMNS]
    processor = LiveRate(keys, interval_seconds, idle_seconds)
    mode = "None" if idle_seconds is None else "ProcessingTime"
    rate = own.mapInArrow(run, summed).groupBy(*keys).transformWithStateInPandas(processor, T.StructType(out), "Update", mode)
    return rate if by else rate.drop("_all")


# ---------------------------------------------------------------------------
# Route as of a control stream
# ---------------------------------------------------------------------------

SALTS = 8
HOLD_MS = 60_000
_CONTROL = ["effective_at", "seq", "op", "library", "symbol", "valid"]
CLOCK_OP = "clock"  # a control row that only moves the clock


class AsOf(StatefulProcessor):
    """The binding timeline of one (topic, salt) and the messages that wait for
    the control clock.

    The timeline holds valid changes and subscribes by (time, seq). Waiting messages are held as Arrow data, a piece for each micro-batch
    and ``HOLD_MS`` of their time, and leave when the clock has passed the
    latest of the piece."""

    def __init__(self, columns: list[str], hold_ms: int, keep_ms: int | None):
        self.columns, self.hold_ms, self.keep_ms = columns, hold_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timeline = handle.getMapState("timeline", "effective_at long, seq long", "op string, library string, symbol string")
        self.held = handle.getMapState("held", "release long, piece long", "rows binary")
        self.pieces = handle.getValueState("pieces", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock = timerValues.getCurrentWatermarkInMs()
        waiting = []
        for part in rows:  # operations and messages of a micro-batch come in any order
            control = part[part["op"].notna()]
            for at, seq, op, library, symbol, valid in control[_CONTROL].itertuples(index=False):
                change = op in (S.OP_BIND, S.OP_REBIND, S.OP_UNBIND) and (valid is None or valid != valid or bool(valid))
                if change or op == S.OP_SUBSCRIBE:
                    self.timeline.updateValue((int(at), int(seq)), (op, library, symbol))
            messages = part[part["op"].isna()]
            if len(messages):
                waiting.append(messages)
        ready = []
        for part in waiting:
            at = part["at"].to_numpy(np.int64)
            open_ = at <= clock
            ready.append(part[open_])
            late = part[~open_]
            for _, piece in late.groupby(late["at"] // self.hold_ms):
                n = self.pieces.get()[0] if self.pieces.exists() else 0
                self.pieces.update((n + 1,))
                release = int(piece["at"].max())
                self.held.updateValue((release, n), (_packed(piece),))
                self.handle.registerTimer(release)
        timeline = self._compacted(clock)
        for part in ready:
            if len(part):
                yield self._routed(part, timeline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        names = [k for k in self.held.keys() if k[0] == due]
        timeline = self._timeline()
        for name in names:
            part = _unpacked(self.held.getValue(name)[0])
            self.held.removeKey(name)
            yield self._routed(part, timeline)

    def _timeline(self) -> list[tuple]:
        return sorted((tuple(k), tuple(v)) for k, v in self.timeline.iterator())

    def _compacted(self, clock: int) -> list[tuple]:
        """The timeline, without operations that were replaced ``keep_ms``
        before the clock and before every waiting message."""
        own = self._timeline()
        if self.keep_ms is None:
            return own
        waiting = min((k[0] for k in self.held.keys()), default=clock) - self.hold_ms
        passed = [x for x in own if x[0][0] <= min(clock - self.keep_ms, waiting)]
        for group in ([x for x in passed if x[1][0] == S.OP_SUBSCRIBE], [x for x in passed if x[1][0] != S.OP_SUBSCRIBE]):
            for name, _ in group[:-1]:
                self.timeline.removeKey(name)
        return own

    def _routed(self, part: pd.DataFrame, timeline: list[tuple]) -> pd.DataFrame:
        changes = [x for x in timeline if x[1][0] != S.OP_SUBSCRIBE]
        subscribes = [x for x in timeline if x[1][0] == S.OP_SUBSCRIBE]
        at = part["at"].to_numpy(np.int64)
        at = np.where(at < 0, np.iinfo(np.int64).max, at)  # without a time: the latest binding
        last_change = np.searchsorted(np.array([x[0][0] for x in changes], np.int64), at, side="right") - 1
        last_subscribe = np.searchsorted(np.array([x[0][0] for x in subscribes], np.int64), at, side="right") - 1
        library, symbol = [], []
        for c, s in zip(last_change.tolist(), last_subscribe.tolist()):
            bound: tuple = (None, None)
            if c >= 0 and changes[c][1][0] != S.OP_UNBIND:
                bound = changes[c][1][1:]
            elif s >= 0 and (c < 0 or subscribes[s][0] > changes[c][0]):
                bound = (S.BUILTIN_LIBRARY, S.DEFAULT_SYMBOL)
            library.append(bound[0])
            symbol.append(bound[1])
        out = part[self.columns].copy()
        out["decoder_library"], out["decoder"] = library, symbol
        return out

    def close(self) -> None:
        pass


def _packed(part: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(part.drop(columns=["clock_at", *_CONTROL]), preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas(integer_object_nulls=True)


def route_as_of_stream(
    envelopes: DataFrame,
    control: DataFrame,
    lateness: str = "10 minutes",
    salts: int = SALTS,
    hold_ms: int = HOLD_MS,
    keep_ms: int | None = None,
) -> DataFrame:
    """J2 on two streams: ``decoder_library`` and ``decoder`` of every message,
    as :func:`routecast.operators.bindings.route_as_of` gives them for the
    whole log; in append mode.

    The control clock is the latest ``effective_at`` of the control stream,
    over all topics, less ``lateness``. A message is held until the clock has
    passed its time, so every operation that is at most ``lateness`` late is
    known by then; a later one counts for messages that leave after it. Rows
    with ``op`` ``clock`` move the clock and change nothing: a control stream
    that is quiet sends them. Messages without a time meet the binding known
    when they come.

    A topic's messages are spread over ``salts`` keys, each with the topic's
    timeline (control rows are few, and are copied to each). The whole timeline
    is kept, so messages may come however late; ``keep_ms`` drops operations
    that were replaced that long before the clock, and with them the exact
    binding of messages that come later still. Operations at one
    time and of one ``seq`` must be equal: the later row replaces the earlier.
    """
    ship_package(envelopes.sparkSession)
    columns = S.ENVELOPE_COLUMNS
    types = {f.name: f.dataType for f in S.BINDING_LOG_SCHEMA}
    at = F.when(F.col("timestamp_ms") >= 0, F.col("timestamp_ms").cast("long")).otherwise(-1)
    salt = F.pmod(F.xxhash64("topic", "partition", "offset", "timestamp_ms", "key"), F.lit(salts)).cast("int")
    messages = envelopes.select(
        F.coalesce("topic", F.lit("")).alias("of_topic"),
        salt.alias("salt"),
        F.lit(None).cast("timestamp").alias("clock_at"),
        at.alias("at"),
        *columns,
        *[F.lit(None).cast(types[c]).alias(c) for c in _CONTROL],
    )
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.ENVELOPE_SCHEMA]
    clock = F.timestamp_millis(F.col("effective_at").cast("long"))
    operations = control.select(
        F.col("topic").alias("of_topic"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.lit(None).cast("timestamp").alias("clock_at"),
        F.lit(-1).cast("long").alias("at"),
        *nothing,
        *[F.col(c).cast(types[c]).alias(c) for c in _CONTROL],
    )
    # rows that move the clock: the engine drops those behind it, and they hold nothing else
    ticks = control.select(
        F.lit("").alias("of_topic"),
        F.lit(0).alias("salt"),
        clock.alias("clock_at"),
        F.lit(-1).cast("long").alias("at"),
        *nothing,
        *[(F.lit(CLOCK_OP) if c == "op" else F.col(c)).cast(types[c]).alias(c) for c in _CONTROL],
    )
    # (a name that begins with an underscore would not reach the processor)
    both = messages.unionByName(operations.where(F.col("op") != CLOCK_OP)).unionByName(ticks).withWatermark("clock_at", lateness)
    out = T.StructType([*S.ENVELOPE_SCHEMA.fields, T.StructField("decoder_library", T.StringType()), T.StructField("decoder", T.StringType())])
    return both.groupBy("of_topic", "salt").transformWithStateInPandas(AsOf(columns, hold_ms, keep_ms), out, "Append", "EventTime")
