"""A segmented message log as a Spark data source.

A log is a folder: ``data/`` holds segments, Parquet files with the messages of
one (topic, partition) in order of offset, and ``_log/`` one small manifest per
append, which names the append's segments and their first and last offsets. A
reader follows manifests only, so it sees an append as a whole or not at all.

``spark.read`` and ``spark.readStream`` with ``format("segment_log")`` return
envelopes. Options:

* ``topics``: exact names, separated by commas (S1).
* ``startingOffsets`` (S4): ``earliest``, ``latest`` (streams), or JSON
  ``{"topic": {"0": 17}}``, where -2 is earliest and -1 latest; partitions not
  named start at earliest. A restarted stream goes on at its checkpoint (S5);
  partitions that appear later are read from their first offset.
* ``endingOffsets``: ``latest`` or JSON, not included (batch reads).
* ``maxOffsetsPerTrigger`` (S6): most offsets of a micro-batch, shared among
  the partitions in proportion to what they hold. It needs
  ``progressLocation``, a shared folder for the reader's cursor: the engine
  does not tell a reader where its checkpoint stands. The cursor is written
  before the engine notes the offset, so it is never behind; after a crash
  between the two, one batch may hold up to twice as much.

A task reads neighbouring segments of about ``TASK_ROWS`` rows in all (a larger
one is a task of its own) in Arrow batches, so the number of tasks follows the
rows, however short the segments are. Files are reached by Arrow's file systems
(local or mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Mapping
from typing import Any, NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from routecast.schema import ENVELOPE_COLUMNS, ENVELOPE_SCHEMA
from routecast.session import ship_package
from routecast.sources.kafka import source_options, subscription

FORMAT = "segment_log"
EARLIEST, LATEST = -2, -1
SEGMENT_WIDTH = 1 << 18  # offsets of a segment
BATCH_ROWS = 2048
TASK_ROWS = 1 << 15
_FILE_SCHEMA = pa.schema(
    [("offset", pa.int64()), ("timestamp_ms", pa.int64()), ("key", pa.binary()), ("payload", pa.binary())]
)
_OUT_SCHEMA = pa.schema([("topic", pa.string()), ("partition", pa.int32()), *_FILE_SCHEMA])

Offsets = dict[tuple[str, int], int]


class Segment(NamedTuple):
    topic: str
    partition: int
    first: int
    last: int
    rows: int
    name: str


class Log:
    """The manifests of a log folder."""

    def __init__(self, path: str):
        self.files, self.root = fs.FileSystem.from_uri(path)
        self.root = self.root.rstrip("/")

    def data_path(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def manifests(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/_log", allow_not_found=True))
        return sorted(f.path for f in found if f.path.endswith(".json"))

    def segments(self, topics: Iterable[str] | None = None) -> list[Segment]:
        """In order of append, then of offset."""
        wanted, out = None if topics is None else set(topics), []
        for path in self.manifests():
            with self.files.open_input_stream(path) as f:
                own = [Segment(*s) for s in json.loads(f.read())]
            out += sorted(s for s in own if wanted is None or s.topic in wanted)
        return out

    def publish(self, new: list[Segment]) -> None:
        """Make ``new`` visible, all at once. Offsets must go on where the log
        ends; one append at a time."""
        ends = bounds(self.segments())[1]
        for s in sorted(new):
            if s.first < ends.get((s.topic, s.partition), s.first):
                raise ValueError(f"{s.topic}/{s.partition}: offset {s.first} is below the end of the log")
            ends[s.topic, s.partition] = s.last + 1
        self.files.create_dir(f"{self.root}/_log", recursive=True)
        at = f"{self.root}/_log/{len(self.manifests()):020d}"
        if self.files.get_file_info(f"{at}.json").type != fs.FileType.NotFound:
            raise ValueError("another append published first")
        write_whole(self.files, f"{at}.json", json.dumps(sorted(new)))


def write_whole(files: fs.FileSystem, path: str, text: str) -> None:
    """A small file that readers see whole or not at all."""
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(temporary) as f:
        f.write(text.encode())
    files.move(temporary, path)


def bounds(segments: list[Segment]) -> tuple[Offsets, Offsets]:
    """First offset, and the one after the last, of each (topic, partition)."""
    begins: Offsets = {}
    ends: Offsets = {}
    for s in segments:
        key = (s.topic, s.partition)
        begins[key] = min(s.first, begins.get(key, s.first))
        ends[key] = max(s.last + 1, ends.get(key, 0))
    return begins, ends


def to_json(offsets: Offsets) -> dict[str, dict[str, int]]:
    out: dict[str, dict[str, int]] = {}
    for (topic, partition), offset in sorted(offsets.items()):
        out.setdefault(topic, {})[str(partition)] = offset
    return out


def from_json(value: Mapping[str, Mapping[str, int]]) -> Offsets:
    return {(t, int(p)): int(o) for t, own in value.items() for p, o in own.items()}


def resolve(option: str, begins: Offsets, ends: Offsets) -> Offsets:
    """A starting or ending option as offsets of all known partitions."""
    text = option.strip()
    if text.lower() == "earliest":
        return dict(begins)
    if text.lower() == "latest":
        return dict(ends)
    named = from_json(json.loads(text))
    if unknown := {t for t, _ in named} - {t for t, _ in begins}:
        if begins:
            raise ValueError(f"offsets are given for topics that are not read: {sorted(unknown)}")
    out = dict(begins)
    for key, offset in named.items():
        out[key] = begins.get(key, 0) if offset == EARLIEST else ends.get(key, 0) if offset == LATEST else offset
    return out


class Slices(InputPartition):
    """Segments, each with its offsets [begin, end), that one task reads."""

    def __init__(self, own: list[tuple[Segment, int, int]]):
        super().__init__([(tuple(s), begin, end) for s, begin, end in own])


def slices(segments: list[Segment], start: Offsets, end: Offsets) -> list[Slices]:
    """The offsets from ``start`` to ``end``, dealt to tasks in order."""
    out: list[Slices] = []
    own: list[tuple[Segment, int, int]] = []
    held = 0
    for s in segments:
        key = (s.topic, s.partition)
        begin, stop = max(s.first, start.get(key, s.first)), min(s.last + 1, end.get(key, 0))
        if begin >= stop:
            continue
        rows = min(s.rows, stop - begin)
        if own and held + rows > TASK_ROWS:
            out.append(Slices(own))
            own, held = [], 0
        own.append((s, begin, stop))
        held += rows
    return [*out, Slices(own)] if own else out


class _Base:
    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        if not options.get("topics"):
            raise ValueError("the option topics is required")
        self.topics = [t for t in options["topics"].split(",") if t]
        self.starting = options.get("startingOffsets", "earliest")
        self.ending = options.get("endingOffsets", "latest")
        self.limit = int(options.get("maxOffsetsPerTrigger", 0))
        self.progress = options.get("progressLocation")

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        log = Log(self.path)
        for own, begin, end in partition.value:
            segment = Segment(*own)
            with log.files.open_input_file(log.data_path(segment.name)) as f:
                for batch in pq.ParquetFile(f).iter_batches(batch_size=BATCH_ROWS):
                    offsets = batch.column("offset").to_numpy()
                    a, b = offsets.searchsorted([begin, end])
                    if a == b:
                        continue
                    batch = batch.slice(a, b - a)
                    n = batch.num_rows
                    topic = pa.array([segment.topic] * n, pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [topic, pa.array([segment.partition] * n, pa.int32()), *batch.columns], schema=_OUT_SCHEMA
                    )


class SegmentReader(_Base, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        segments = Log(self.path).segments(self.topics)
        begins, ends = bounds(segments)
        if self.starting.strip().lower() == "latest":
            raise ValueError("a batch read cannot start at 'latest'")
        found = slices(segments, resolve(self.starting, begins, ends), resolve(self.ending, begins, ends))
        return found or [Slices([])]  # an empty read has a task, too

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return iter([pa.RecordBatch.from_pylist([], _OUT_SCHEMA)])
        return super().read(partition)


class SegmentStreamReader(_Base, DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        super().__init__(options)
        if self.limit and not self.progress:
            raise ValueError("maxOffsetsPerTrigger needs a progressLocation")
        self.start: Offsets | None = None
        self.cursor: Offsets = {}

    def _known(self) -> tuple[list[Segment], Offsets, Offsets]:
        segments = Log(self.path).segments(self.topics)
        return segments, *bounds(segments)

    def initialOffset(self) -> dict:
        _, begins, ends = self._known()
        if not self.limit:
            return to_json(resolve(self.starting, begins, ends))
        self._load(begins, ends)
        return to_json(self.start)

    def latestOffset(self) -> dict:
        _, begins, ends = self._known()
        if not self.limit:
            return to_json(ends)
        self._load(begins, ends)
        at = {key: self.cursor.get(key, begins[key]) for key in ends}
        left = {key: max(0, end - at[key]) for key, end in ends.items()}
        total = sum(left.values())
        spent, out = 0, {}
        for key, n in sorted(left.items()):
            take = min(n, max(n * self.limit // max(total, 1), 1), self.limit - spent)
            spent += take
            out[key] = at[key] + take
        if out != self.cursor:
            self.cursor = out
            self._store()
        return to_json(out)

    def _place(self) -> tuple[fs.FileSystem, str]:
        files, root = fs.FileSystem.from_uri(self.progress)
        return files, f"{root.rstrip('/')}/cursor.json"

    def _load(self, begins: Offsets, ends: Offsets) -> None:
        """The first offsets and the cursor, as kept, or the starting option's
        (the engine asks for the latest offset first)."""
        if self.start is not None:
            return
        files, path = self._place()
        if files.get_file_info(path).type == fs.FileType.NotFound:
            self.start = self.cursor = resolve(self.starting, begins, ends)
            self._store()
            return
        with files.open_input_stream(path) as f:
            kept = json.loads(f.read())
        self.start, self.cursor = from_json(kept["start"]), from_json(kept["cursor"])

    def _store(self) -> None:
        files, path = self._place()
        files.create_dir(path.rpartition("/")[0], recursive=True)
        write_whole(files, path, json.dumps({"start": to_json(self.start), "cursor": to_json(self.cursor)}))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        segments, begins, _ = self._known()
        return slices(segments, begins | from_json(start), from_json(end))

    def commit(self, end: dict) -> None:
        """Progress is the checkpoint's; segments stay."""


class _Written(WriterCommitMessage):
    def __init__(self, segments: list[Segment]):
        self.segments = [tuple(s) for s in segments]


class SegmentWriter(DataSourceArrowWriter):
    """Writes rows that come in order of (topic, partition, offset), a new
    segment for every (topic, partition, block of offsets)."""

    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.width = int(options.get("segmentWidth", SEGMENT_WIDTH))

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        log, done = Log(self.path), []
        log.files.create_dir(f"{log.root}/data", recursive=True)
        key, out, stream, first, last, rows, name = None, None, None, 0, 0, 0, ""

        def close() -> None:
            if out is not None:
                out.close()
                stream.close()
                done.append(Segment(key[0], key[1], first, last, rows, name))

        for batch in batches:
            table = pa.Table.from_batches([batch]).select(ENVELOPE_COLUMNS).cast(_OUT_SCHEMA)
            if any(table.column(c).null_count for c in ("topic", "partition", "offset")):
                raise ValueError("a logged message needs a topic, a partition and an offset")
            keys = list(
                zip(table["topic"].to_pylist(), table["partition"].to_pylist(), [o // self.width for o in table["offset"].to_pylist()])
            )
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                part = table.slice(at, end - at).select(_FILE_SCHEMA.names)
                if keys[at] != key:
                    close()
                    key, rows, name = keys[at], 0, f"{uuid.uuid4().hex}.parquet"
                    first = part["offset"][0].as_py()
                    stream = log.files.open_output_stream(log.data_path(name))
                    out = pq.ParquetWriter(stream, _FILE_SCHEMA)
                out.write_table(part)
                last, rows, at = part["offset"][-1].as_py(), rows + part.num_rows, end
        close()
        return _Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        new = [Segment(*s) for m in messages if m is not None for s in m.segments]
        try:
            Log(self.path).publish(new)
        except Exception:
            self.abort(messages)
            raise

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        log = Log(self.path)
        for m in messages:
            for s in m.segments if m is not None else []:
                log.files.delete_file(log.data_path(Segment(*s).name))


class SegmentLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return ENVELOPE_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return SegmentReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return SegmentStreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a log is appended to; mode('append') only")
        return SegmentWriter(self.options)


def _registered(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    spark.dataSource.register(SegmentLog)
    return spark


def append_segments(envelopes: DataFrame, path: str, width: int = SEGMENT_WIDTH) -> None:
    """Append messages to the log. Their offsets must lie behind those that
    the log holds already; blocks of ``width`` offsets are dealt to tasks, so
    a topic of any share is spread."""
    _registered(envelopes.sparkSession)
    block = F.floor(F.col("offset") / width)
    order = ["topic", "partition", "offset"]
    dealt = envelopes.select(*ENVELOPE_COLUMNS).repartition("topic", "partition", block).sortWithinPartitions(*order)
    dealt.write.format(FORMAT).mode("append").option("segmentWidth", str(width)).save(path)


def read_segments(
    spark: SparkSession,
    path: str,
    topics: str | Iterable[str],
    cfg: Mapping[str, Any] | None = None,
    stream: bool = True,
    default_start: str = "earliest",
    starting_offsets: str | Mapping[str, Mapping[str, int]] | None = None,
    ending_offsets: str | Mapping[str, Mapping[str, int]] | None = None,
    progress: str | None = None,
) -> DataFrame:
    """Envelopes of the log at ``path``, with the same consumer configuration
    as :func:`routecast.sources.kafka.read_topics` (``auto.offset.reset``,
    ``maxOffsetsPerTrigger``; the rest has no meaning here).
    ``starting_offsets`` overrides ``auto.offset.reset``."""
    mapped = source_options(cfg, default_start).reader

    def text(value: str | Mapping[str, Mapping[str, int]]) -> str:
        return value if isinstance(value, str) else json.dumps(value)

    options = {"topics": subscription(topics), "startingOffsets": mapped["startingOffsets"]}
    if starting_offsets is not None:
        options["startingOffsets"] = text(starting_offsets)
    if ending_offsets is not None:
        options["endingOffsets"] = text(ending_offsets)
    if stream and "maxOffsetsPerTrigger" in mapped:
        options["maxOffsetsPerTrigger"] = mapped["maxOffsetsPerTrigger"]
    if progress is not None:
        options["progressLocation"] = progress
    reader = _registered(spark).readStream if stream else spark.read
    return reader.format(FORMAT).options(**options).load(path)
