"""Broadcast only behind a checked size bound."""

from __future__ import annotations

from collections import deque

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most rows, and most bytes in memory, that are broadcast. Control tables
# (bindings, binding intervals, drain-page prefix tables) are far below; past
# either the caller falls back to a shuffle plan that AQE can split for skew.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# Control tables persisted by a size check, newest last; the oldest are
# released so repeated checks (one per micro-batch) do not pile up.
_KEEP_PERSISTED = 16
_persisted: deque[DataFrame] = deque()


def _bytes_in_memory(cached: DataFrame) -> int:
    """Size of a cached, counted table: what its partitions hold."""
    size = cached._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def _remember(df: DataFrame) -> None:
    _persisted.append(df)
    while len(_persisted) > _KEEP_PERSISTED:
        old = _persisted.popleft()
        try:
            old.unpersist()
        except Exception:  # its session may be gone; nothing left to free
            pass


def computed_once(df: DataFrame) -> DataFrame:
    """A small derived table (one row per interval, bucket or the like) that a
    plan reads more than once, persisted when first computed."""
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    _remember(cached)
    return cached


def within_bound(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """``(df, True)``, persisted, when it has at most ``max_rows`` rows (always
    counted) and ``max_bytes`` bytes; else ``(df, False)``.

    The count is bounded by a limit, and the table is computed once for the
    check and for its use. A table that the caller has cached stays as it is.
    """
    if df.isStreaming:
        return df, False
    own = not (df.storageLevel.useMemory or df.storageLevel.useDisk)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK) if own else df
    if cached.limit(max_rows + 1).count() <= max_rows and _bytes_in_memory(cached) <= max_bytes:
        if own:
            _remember(cached)
        return cached, True
    if own:
        cached.unpersist()
    return df, False


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Return ``(broadcast(df), True)`` when ``df`` is :func:`within_bound`,
    else ``(df, False)``."""
    cached, small = within_bound(df, max_rows)
    return (F.broadcast(cached), True) if small else (df, False)
