"""Table source (S2) and envelope projection.

Any DataFrame becomes an envelope ``(topic, partition, offset, timestamp_ms,
key, payload)`` through a column mapping; the mapping is a plain projection,
so Catalyst prunes the scan to the columns the mapping reads and pushes
filters below it. Works on ``spark.read`` and ``spark.readStream`` alike.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast.schema import ENVELOPE_COLUMNS, ENVELOPE_SCHEMA


def _col(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


def envelopes_from_table(
    df: DataFrame,
    topic,
    payload,
    partition=0,
    offset=None,
    timestamp_ms=-1,
    key=None,
) -> DataFrame:
    """Project ``df`` into the envelope shape.

    Each argument is a column name, a Column or a literal. ``offset`` defaults
    to NULL, ``timestamp_ms`` to -1 (unavailable), ``key`` to NULL.
    """
    cols = {
        "topic": _col(topic).cast("string"),
        "partition": _col(partition).cast("int"),
        "offset": (F.lit(None) if offset is None else _col(offset)).cast("long"),
        "timestamp_ms": _col(timestamp_ms).cast("long"),
        "key": (F.lit(None) if key is None else _col(key)).cast("binary"),
        "payload": _col(payload).cast("binary"),
    }
    return df.select(*[cols[c].alias(c) for c in ENVELOPE_COLUMNS])


def epoch_micros_ntz(ts_column: str) -> str:
    """SQL for the microseconds since epoch of a TIMESTAMP_NTZ column, read
    from its wall-clock parts, so the session time zone plays no part (a cast
    to TIMESTAMP would shift local times that do not exist in that zone)."""
    c = f"`{ts_column}`"
    return (
        f"(CAST(unix_date(to_date({c})) AS BIGINT) * 86400000000"
        f" + CAST(hour({c}) AS BIGINT) * 3600000000"
        f" + CAST(minute({c}) AS BIGINT) * 60000000"
        f" + CAST(date_part('SECOND', {c}) * 1000000 AS BIGINT))"
    )


def epoch_millis_ntz(ts_column: str) -> Column:
    """Milliseconds since epoch (floored) of a TIMESTAMP_NTZ column,
    independent of the session time zone."""
    us = epoch_micros_ntz(ts_column)
    return F.expr(f"({us} - pmod({us}, 1000)) div 1000")


def kafka_to_envelope(kafka_df: DataFrame) -> DataFrame:
    """A Kafka source row -> envelope; an absent timestamp gives -1."""
    return kafka_df.select(
        F.col("topic").cast("string").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.coalesce(F.unix_millis(F.col("timestamp")), F.lit(-1).cast("long")).alias("timestamp_ms"),
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("payload"),
    )


# ---------------------------------------------------------------------------
# Mappings of the provided tables (see FIXTURES.md)
# ---------------------------------------------------------------------------


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def events_envelopes(df: DataFrame) -> DataFrame:
    """``events``: topic = event_type, partition = user_id % 4, offset =
    event_id, timestamp = ts in ms, key = user_id as text, payload = props."""
    return envelopes_from_table(
        df,
        topic="event_type",
        partition=F.pmod(F.col("user_id"), F.lit(4)),
        offset="event_id",
        timestamp_ms=epoch_millis_ntz("ts"),
        key=F.col("user_id").cast("string"),
        payload="props",
    )


def documents_envelopes(df: DataFrame, topic: str = "lang") -> DataFrame:
    """``documents``: topic = lang (or source), one partition, offset =
    doc_id, no timestamp, key = doc_id as text, payload = text."""
    return envelopes_from_table(
        df,
        topic=topic,
        partition=0,
        offset="doc_id",
        timestamp_ms=-1,
        key=F.col("doc_id").cast("string"),
        payload="text",
    )


def conversations_envelopes(df: DataFrame) -> DataFrame:
    """``conversations``: topic = role, offset = conv_id * 1000 + turn."""
    return envelopes_from_table(
        df,
        topic="role",
        partition=0,
        offset=F.col("conv_id") * 1000 + F.col("turn"),
        timestamp_ms=-1,
        key=F.col("conv_id").cast("string"),
        payload="text",
    )


# Session setting: least number of partitions a table scan should feed the
# decode with (the table-source form of the consumer's decode parallelism).
# Unset by default: many input files already give one task per split, and a
# round-robin repartition would only add a shuffle.
DECODE_PARTITIONS_CONF = "spark.routecast.decodePartitions"


def decode_partitions(spark: SparkSession) -> int | None:
    value = spark.conf.get(DECODE_PARTITIONS_CONF, None)
    return int(value) if value else None


def with_decode_partitions(df: DataFrame, partitions: int | None) -> DataFrame:
    """Spread a scan over ``partitions`` tasks, round-robin: for a scan of few
    splits (e.g. one file of one row group), when the setting asks for it."""
    if not partitions or df.isStreaming:
        return df
    return df.repartition(partitions)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return with_decode_partitions(df, decode_partitions(spark))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_envelopes(read_table(spark, sf_dir, "events"))


def read_documents(spark: SparkSession, sf_dir: str, topic: str = "lang") -> DataFrame:
    return documents_envelopes(read_table(spark, sf_dir, "documents"), topic)


def read_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations_envelopes(read_table(spark, sf_dir, "conversations"))

