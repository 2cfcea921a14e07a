"""Kafka topic source (S1) with its option mapping (S3) and start position
(S4).

The consumer settings a user of a native Kafka bridge is used to
(``bootstrap.servers``, ``group.id``, ``auto.offset.reset``, ...) are mapped
onto the options of Spark's Kafka source. Progress is tracked by the
streaming checkpoint, not by auto-commit (S5): replay from the checkpoint
plus an idempotent sink gives exactly-once output, where auto-commit could
lose messages that were read but not yet drained.

The Kafka connector jar is an optional dependency; without it ``load()``
fails with Spark's own "Failed to find data source: kafka" error.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from routecast.sources.envelopes import kafka_to_envelope

# Consumer defaults being reproduced.
DEFAULT_DECODE_THREADS = 4
DEFAULT_QUEUE_SIZE = 8192

# Options of Spark's Kafka source that are passed through unchanged.
SPARK_KAFKA_OPTIONS = frozenset(
    {
        "startingOffsets",
        "endingOffsets",
        "startingTimestamp",
        "endingTimestamp",
        "startingOffsetsByTimestamp",
        "endingOffsetsByTimestamp",
        "maxOffsetsPerTrigger",
        "minOffsetsPerTrigger",
        "maxTriggerDelay",
        "minPartitions",
        "failOnDataLoss",
        "includeHeaders",
        "groupIdPrefix",
        "kafkaConsumer.pollTimeoutMs",
        "fetchOffset.numRetries",
        "fetchOffset.retryIntervalMs",
    }
)

# Consumer settings Spark's Kafka source manages itself and refuses.
REFUSED_KAFKA_KEYS = frozenset(
    {
        "key.deserializer",
        "value.deserializer",
        "interceptor.classes",
        "auto.offset.reset",
        "enable.auto.commit",
    }
)

_START_ALIASES = {
    "earliest": "earliest",
    "smallest": "earliest",
    "beginning": "earliest",
    "latest": "latest",
    "largest": "latest",
    "end": "latest",
}

_TOPIC_RE = re.compile(r"^[A-Za-z0-9._-]+$")


@dataclass
class SourceOptions:
    """Result of :func:`source_options`."""

    reader: dict[str, str] = field(default_factory=dict)
    auto_commit: bool = True
    decode_threads: int = DEFAULT_DECODE_THREADS
    raw_queue_size: int = DEFAULT_QUEUE_SIZE
    evt_queue_size: int = DEFAULT_QUEUE_SIZE
    notes: list[str] = field(default_factory=list)


def _to_text(key: str, value: Any) -> str:
    """Stringify an option value: text as is, booleans as true/false,
    integers in decimal. Other types are refused (rather than sent empty)."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, str):
        return value
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode("utf-8")
    raise TypeError(f"option {key!r}: unsupported value type {type(value).__name__}")


def _count(key: str, value: Any, default: int) -> int:
    """Integer option, at least 1; other value types keep the default."""
    if isinstance(value, int) and not isinstance(value, bool):
        return max(1, value)
    return default


def _flag(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value != 0
    return _to_text("enable.auto.commit", value) == "true"


def source_options(cfg: Mapping[str, Any] | None, default_start: str = "earliest") -> SourceOptions:
    """S3: map a consumer configuration onto Spark Kafka source options.

    * ``bootstrap.servers`` (else ``metadata.broker.list``) ->
      ``kafka.bootstrap.servers``
    * ``group.id`` -> ``kafka.group.id`` when non-empty
    * ``auto.offset.reset`` -> ``startingOffsets`` (S4; default
      ``default_start``; applies only when no checkpoint exists)
    * ``enable.auto.commit`` -> recorded, not passed (checkpoint instead)
    * ``decode_threads`` -> ``minPartitions`` when given (min 1)
    * ``raw_queue_size``, ``evt_queue_size`` -> accepted, no Spark equivalent
      (a buffer's size is no limit on the rows of a trigger; that is
      ``maxOffsetsPerTrigger``, which passes unchanged)
    * any other key -> ``kafka.<key>`` stringified; Spark option names and
      ``kafka.``-prefixed keys pass unchanged
    """
    cfg = dict(cfg or {})
    out = SourceOptions()
    reader = out.reader

    if "decode_threads" in cfg:
        out.decode_threads = _count("decode_threads", cfg["decode_threads"], DEFAULT_DECODE_THREADS)
        reader["minPartitions"] = str(out.decode_threads)
    if "raw_queue_size" in cfg:
        out.raw_queue_size = _count("raw_queue_size", cfg["raw_queue_size"], DEFAULT_QUEUE_SIZE)
        out.notes.append("raw_queue_size has no Spark equivalent; limit a trigger with maxOffsetsPerTrigger")
    if "evt_queue_size" in cfg:
        out.evt_queue_size = _count("evt_queue_size", cfg["evt_queue_size"], DEFAULT_QUEUE_SIZE)
        out.notes.append("evt_queue_size has no Spark equivalent; ignored")

    servers = cfg.get("bootstrap.servers")
    if servers is None:
        servers = cfg.get("metadata.broker.list")
    if servers is not None:
        reader["kafka.bootstrap.servers"] = _to_text("bootstrap.servers", servers)

    group = cfg.get("group.id")
    if group is not None and _to_text("group.id", group) != "":
        reader["kafka.group.id"] = _to_text("group.id", group)

    start = cfg.get("auto.offset.reset", default_start)
    start_text = _to_text("auto.offset.reset", start).strip().lower()
    if start_text not in _START_ALIASES:
        raise ValueError(f"auto.offset.reset: unsupported value {start!r}")
    reader["startingOffsets"] = _START_ALIASES[start_text]

    if "enable.auto.commit" in cfg:
        out.auto_commit = _flag(cfg["enable.auto.commit"])
        out.notes.append("enable.auto.commit is replaced by the streaming checkpoint")

    handled = {
        "decode_threads",
        "raw_queue_size",
        "evt_queue_size",
        "bootstrap.servers",
        "metadata.broker.list",
        "group.id",
        "auto.offset.reset",
        "enable.auto.commit",
    }
    for key, value in cfg.items():
        if key in handled:
            continue
        text = _to_text(key, value)
        if key in SPARK_KAFKA_OPTIONS:
            reader[key] = text
        elif key.startswith("kafka."):
            if key[len("kafka."):] in REFUSED_KAFKA_KEYS:
                raise ValueError(f"option {key!r} is managed by Spark's Kafka source")
            reader[key] = text
        elif key in REFUSED_KAFKA_KEYS:
            raise ValueError(f"option {key!r} is managed by Spark's Kafka source")
        else:
            reader["kafka." + key] = text
    return out


def subscription(topics: str | Iterable[str]) -> str:
    """One topic or a list -> the ``subscribe`` option (exact names)."""
    names = [topics] if isinstance(topics, str) else list(topics)
    if not names:
        raise ValueError("at least one topic is required")
    for t in names:
        if not _TOPIC_RE.match(t):
            raise ValueError(f"invalid topic name {t!r}")
    return ",".join(dict.fromkeys(names))


def read_topics(
    spark: SparkSession,
    topics: str | Iterable[str],
    cfg: Mapping[str, Any] | None = None,
    stream: bool = True,
    default_start: str = "earliest",
) -> DataFrame:
    """Kafka topics -> envelopes (streaming by default, or a bounded
    batch read)."""
    opts = source_options(cfg, default_start)
    if "kafka.bootstrap.servers" not in opts.reader:
        raise ValueError("bootstrap.servers (or metadata.broker.list) is required")
    reader_opts = dict(opts.reader)
    if not stream:
        if reader_opts.get("startingOffsets") == "latest":
            raise ValueError("a batch read cannot start at 'latest'")
        reader_opts.pop("maxOffsetsPerTrigger", None)
    reader = spark.readStream if stream else spark.read
    raw = reader.format("kafka").options(**reader_opts).option("subscribe", subscription(topics)).load()
    return kafka_to_envelope(raw)
