"""S7 to user code: each drained batch is handed to a function per target.

A :class:`Dispatcher` is the sink of a routed stream (``start_routed(...,
sink=Dispatcher(...))``) or is called with any drained batch. Every task hands
its data rows to ``upd(tbl, data, token)``, an Arrow array of the payloads of
one target in the rows' order, and its error rows to ``on_error(topics, errs,
token)``. Nothing is shuffled: a target with a third of all rows is called by
every task that holds some.

``token`` names one attempt at a task. When all tasks are done, one record per
batch is written that names the tokens that count; a batch with a record isn't
dispatched again. A failed attempt gets ``undo(token)``, in the task or, if
another task failed, at the driver. An executor that is lost says nothing, so
its token just never counts: a receiver that keeps the token with what it
stores has each row of a recorded batch exactly once (:func:`dispatched`).

Functions run in the executors' Python workers and are pickled.

Odd input: a null target is handed on as None; a batch without rows makes no
call and an empty record; nulls in ``data`` are handed on; rows whose kind is
neither ``data`` nor ``error`` (null, too) are an error of the caller's and
raise one.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from routecast import schema as S
from routecast.session import ship_package
from routecast.sources.segments import write_whole

Upd = Callable[[str | None, pa.Array, str], Any]
OnError = Callable[[pa.Array, pa.Array, str], Any]
Undo = Callable[[str], Any]

DRAINED = "tbl string, topic string, kind string, data binary, err string"
RECORDED = "batch_id long, token string, kind string, tbl string, n_rows long"


class _Handed(WriterCommitMessage):
    def __init__(self, token: str, rows: Counter):
        self.token = token
        self.rows = list(rows.items())


def runs_by_target(batch: pa.RecordBatch) -> Iterator[tuple[str | None, pa.Array]]:
    """The payloads of each target, in the order of the rows."""
    if not batch.num_rows:
        return
    order = pc.sort_indices(batch.column("tbl"))  # a stable sort
    targets, data = batch.column("tbl").take(order), batch.column("data").take(order)
    codes = targets.dictionary_encode(null_encoding="encode").indices.to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
    for begin, end in zip(cuts, cuts[1:]):
        yield targets[begin].as_py(), data.slice(begin, end - begin)


class DispatchWriter(DataSourceArrowWriter):
    def __init__(self, place: str, batch_id: int, upd: Upd, on_error: OnError | None, undo: Undo | None):
        self.place, self.batch_id = place, batch_id
        self.upd, self.on_error, self.undo = upd, on_error, undo

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        context = TaskContext.get()
        token = f"{self.batch_id}-{context.partitionId() if context else 0}-{uuid.uuid4().hex}"
        rows: Counter = Counter()
        try:
            for batch in iterator:
                self._hand(batch, token, rows)
        except BaseException:
            if self.undo is not None:
                self.undo(token)
            raise
        return _Handed(token, rows)

    def _hand(self, batch: pa.RecordBatch, token: str, rows: Counter) -> None:
        kind = batch.column("kind")
        is_data, is_error = (pc.fill_null(pc.equal(kind, k), False) for k in (S.EVENT_DATA, S.EVENT_ERROR))
        errors = batch.filter(is_error)
        data = batch.filter(is_data)
        if data.num_rows + errors.num_rows < batch.num_rows:
            raise ValueError("a drained row is of kind data or error")
        for tbl, payloads in runs_by_target(data):
            self.upd(tbl, payloads, token)
            rows[S.EVENT_DATA, tbl] += len(payloads)
        if errors.num_rows:
            if self.on_error is not None:
                self.on_error(errors.column("topic"), errors.column("err"), token)
            rows[S.EVENT_ERROR, None] += errors.num_rows

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        lines = [
            json.dumps({"batch_id": self.batch_id, "token": m.token, "kind": kind, "tbl": tbl, "n_rows": n})
            for m in messages
            if m is not None
            for (kind, tbl), n in m.rows
        ]
        files, path = fs.FileSystem.from_uri(self.place)
        write_whole(files, path, "\n".join(lines))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            if m is not None and self.undo is not None:
                self.undo(m.token)


class Dispatcher:
    """``Dispatcher(path, upd)(drained, batch_id)``; ``path`` is a shared
    folder that holds the records."""

    def __init__(self, path: str, upd: Upd, on_error: OnError | None = None, undo: Undo | None = None):
        self.path, self.calls = path.rstrip("/"), (upd, on_error, undo)
        self.format = f"dispatch_{uuid.uuid4().hex}"

    def _source(self, place: str, batch_id: int) -> type[DataSource]:
        calls, format_name = self.calls, self.format

        class Dispatch(DataSource):
            @classmethod
            def name(cls) -> str:
                return format_name

            def schema(self) -> str:
                return DRAINED

            def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
                return DispatchWriter(place, batch_id, *calls)

        return Dispatch

    def __call__(self, drained: DataFrame, batch_id: int) -> bool:
        """Hand the batch on; False, and no call, if that was done before."""
        files, root = fs.FileSystem.from_uri(f"{self.path}/dispatched")
        name = f"batch-{int(batch_id):020d}.json"
        if files.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:
            return False
        files.create_dir(root, recursive=True)
        spark = drained.sparkSession
        ship_package(spark)
        spark.dataSource.register(self._source(f"{self.path}/dispatched/{name}", int(batch_id)))
        drained.select(S.DRAIN_COLUMNS).write.format(self.format).mode("append").save()
        return True


def dispatched(spark: SparkSession, path: str) -> DataFrame:
    """What counts of all that was handed on: ``(batch_id, token, kind, tbl,
    n_rows)``, one row per task and target."""
    return spark.read.schema(RECORDED).option("pathGlobFilter", "batch-*.json").json(f"{path.rstrip('/')}/dispatched")
