"""A4 while a stream runs: the binding table without reading the log again.

:class:`IncrementalBindings` keeps, per topic, the last change and the last
subscribe of the log up to some ``seq``. Each micro-batch reads the operations
after that ``seq`` only (the filter reaches the Parquet scan, whose statistics
leave out the older row groups), merges them with the table kept, writes the
result under a fresh name and publishes it with one small record: a loader that
fails half-way, or is started again, goes on from the last record.

Both parts are maxima by ``(effective_at, seq)``, so operations may come late
in ``effective_at``. They must come in order of ``seq``, and an append must
appear as a whole, as ``append_binding_ops`` writes it. With a ``catalog``, a
bind is judged by the catalog of the moment it is folded, once.

Odd input: no log yet, or no operations, is an empty binding table; repeated
operations change nothing; of several with the same time and ``seq`` the
largest decides, as in ``current_bindings``; columns beyond the log's own are
not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.operators.bindings import binding_state, bindings_of, log_begun, merge_states, validate_log
from routecast.sources.local import local_table
from routecast.streaming.published import BatchRecords

_ONLY = 0  # the state is one thing, replaced as a whole


class IncrementalBindings:
    """A ``bindings_loader``: ``IncrementalBindings(log, state)(spark,
    batch_id)``. ``state`` is a shared folder of this loader alone.
    ``rows_read`` is the number of operations the last call folded."""

    def __init__(self, log: str, state: str, catalog: DataFrame | None = None):
        self.log, self.state, self.catalog = log, state.rstrip("/"), catalog
        self.rows_read = 0

    def _folder(self, name: str) -> str:
        return f"{self.state}/state={name}"

    def tail(self, spark: SparkSession, after: int | None) -> DataFrame:
        log = spark.read.schema(S.BINDING_LOG_SCHEMA).parquet(self.log)
        return log if after is None else log.where(F.col("seq") > after)

    def __call__(self, spark: SparkSession, batch_id: int) -> DataFrame:
        records = BatchRecords(self.state)
        kept = records.read().get(_ONLY)
        self.rows_read = 0
        if log_begun(spark, self.log):
            tail = self.tail(spark, kept and kept["seq"])
            last, self.rows_read = tail.agg(F.max("seq"), F.count(F.lit(1))).first()
            if self.rows_read:
                kept = self._fold(spark, records, kept, tail.where(F.col("seq") <= last), last)
        if kept is None:
            return local_table(spark, [], S.BINDING_SCHEMA)
        return bindings_of(spark.read.parquet(self._folder(kept["attempt"])))

    def _fold(self, spark: SparkSession, records: BatchRecords, kept: dict | None, tail: DataFrame, last: int) -> dict:
        state = binding_state(tail if self.catalog is None else validate_log(tail, self.catalog))
        if kept is not None:
            state = merge_states(spark.read.parquet(self._folder(kept["attempt"])), state)
        record = {"attempt": uuid.uuid4().hex, "seq": last, "before": kept and kept["attempt"]}
        state.write.parquet(self._folder(record["attempt"]))
        records.publish(_ONLY, record)
        # the one before may still be read by a batch at work; older ones not
        if kept is not None and kept["before"]:
            records.files.delete_dir(f"{records.sink}/state={kept['before']}")
        return record
