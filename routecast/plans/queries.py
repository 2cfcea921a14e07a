"""Registered queries over the provided tables, each with a DuckDB twin.

Every query reads whole tables (no id subsets, no row caps) and returns a
DataFrame whose column names equal the twin's. Binary values are compared
as ``hex``/``md5`` text and lengths, because the checker hashes values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from routecast import schema as S
from routecast.functions.contract import ingest_ns
from routecast.functions.text import error_line, event_text
from routecast.operators.bindings import (
    bindings_from_text,
    check_bindings,
    current_bindings,
    decode_as_of,
    validate_log,
)
from routecast.operators.paging import drain_pages
from routecast.operators.routing import decode, decode_routed, split_events, to_drain
from routecast.operators.stats import dispatch_counts, event_rate, event_totals
from routecast.plans import samples
from routecast.sources.local import local_table
from routecast.sources.segments import append_segments, read_segments
from routecast.streaming.control import IncrementalBindings
from routecast.streaming.dispatch import Dispatcher, dispatched
from routecast.streaming.state import CLOCK_OP, RATE_COLUMNS, live_rate_totals, rocksdb_state, route_as_of_stream
from routecast.streaming.stream import (
    decode_stream,
    file_stream,
    latest_per_key,
    live_rate,
    live_totals,
    read_routed,
    start_routed,
    start_table_sink,
    scratch_folder,
)
from routecast.sources.envelopes import (
    epoch_millis_ntz,
    events_envelopes,
    kafka_to_envelope,
    read_conversations,
    read_documents,
    read_events,
    read_table,
)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


# ---------------------------------------------------------------------------
# Shared SQL fragments for the DuckDB twins
# ---------------------------------------------------------------------------

# Envelope of `events` in DuckDB.
SQL_EVENT_ENV = """
env AS (
  SELECT event_type AS topic,
         CAST(user_id % 4 AS INTEGER) AS "partition",
         event_id AS "offset",
         epoch_us(ts) // 1000 AS timestamp_ms,
         encode(CAST(user_id AS VARCHAR)) AS "key",
         props AS payload
  FROM events
)"""

# Decoders + contract in DuckDB, reading a CTE `routed` (envelope columns +
# `decoder`). Mirrors the sample decoders of `samples.py`.
SQL_DECODE_BODY = """
dec AS (
  SELECT *,
    CASE
      WHEN decoder IS NULL THEN 'error'
      WHEN decoder = 'default_decoder' THEN 'data'
      WHEN decoder = 'json_k' THEN CASE WHEN json_extract_string(payload, '$.k') IS NULL THEN 'error' ELSE 'data' END
      WHEN decoder = 'even_k' THEN CASE WHEN TRY_CAST(json_extract_string(payload, '$.k') AS BIGINT) % 2 = 0 THEN 'data' ELSE 'error' END
      ELSE 'error'
    END AS kind,
    CASE
      WHEN decoder = 'default_decoder' THEN encode(payload)
      WHEN decoder = 'json_k' THEN encode(coalesce(json_extract_string(payload, '$.k'), ''))
      WHEN decoder = 'even_k' THEN encode(payload)
      ELSE encode('')
    END AS raw_data,
    CASE
      WHEN decoder IS NULL THEN 'decoder not bound'
      WHEN decoder = 'skip_all' THEN 'decode failed'
      WHEN decoder = 'json_k' AND json_extract_string(payload, '$.k') IS NULL THEN 'field k missing'
      WHEN decoder = 'even_k'
        THEN rpad('field k is not even: ' || coalesce(json_extract_string(payload, '$.k'), 'missing'), 120, '-')
      WHEN decoder IN ('default_decoder', 'json_k') THEN ''
      ELSE 'decoder symbol not found: ' || decoder
    END AS err
  FROM routed
),
events_out AS (
  SELECT topic, "partition", "offset", timestamp_ms, "key",
         CASE WHEN timestamp_ms >= 0 THEN timestamp_ms * 1000000 ELSE 0 END AS ingest_ns,
         decoder, kind,
         CASE WHEN kind = 'data' THEN raw_data ELSE encode('') END AS data,
         CASE WHEN kind = 'data' THEN '' ELSE err END AS err,
         coalesce(decoder, topic) AS tbl
  FROM dec
)"""

# Flagship routing of `events`: the fixed binding table plus the subscription
# default for click; signup stays unbound.
SQL_EVENT_ROUTED = """
routed AS (
  SELECT env.*, CASE topic WHEN 'click' THEN 'default_decoder'
                           WHEN 'view' THEN 'json_k'
                           WHEN 'error' THEN 'skip_all'
                           WHEN 'purchase' THEN 'even_k' END AS decoder
  FROM env
)"""

SQL_EVENT_DECODE = "WITH" + SQL_EVENT_ENV + "," + SQL_EVENT_ROUTED + "," + SQL_DECODE_BODY


def event_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship decode of `events` (J1 + U1 + D3), as event rows."""
    return decode(
        read_events(spark, sf_dir),
        samples.event_bindings(spark),
        samples.sample_registry(),
        topics=samples.EVENT_TOPICS,
    )


# ---------------------------------------------------------------------------
# envelopes
# ---------------------------------------------------------------------------


@register(
    "envelope_events",
    "WITH"
    + SQL_EVENT_ENV
    + """
SELECT topic, "partition", "offset", timestamp_ms,
       CASE WHEN timestamp_ms >= 0 THEN timestamp_ms * 1000000 ELSE 0 END AS ingest_ns,
       hex("key") AS key_hex, hex(encode(payload)) AS payload_hex
FROM env""",
)
def envelope_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = read_events(spark, sf_dir)
    return env.select(
        "topic",
        "partition",
        "offset",
        "timestamp_ms",
        ingest_ns(F.col("timestamp_ms")).alias("ingest_ns"),
        F.hex("key").alias("key_hex"),
        F.hex("payload").alias("payload_hex"),
    )


@register(
    "kafka_projection",
    "WITH" + SQL_EVENT_ENV + """
SELECT topic, "partition", "offset", timestamp_ms, hex("key") AS key_hex, hex(encode(payload)) AS payload_hex
FROM env""",
)
def q_kafka_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as rows of the Kafka source, projected to envelopes."""
    rows = read_table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis(epoch_millis_ntz("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    env = kafka_to_envelope(rows)
    return env.select(
        "topic", "partition", "offset", "timestamp_ms", F.hex("key").alias("key_hex"), F.hex("payload").alias("payload_hex")
    )


# ---------------------------------------------------------------------------
# Passthrough under the default symbol
# ---------------------------------------------------------------------------


@register(
    "passthrough_documents",
    """
SELECT 'default_decoder' AS tbl, lang AS topic, doc_id AS "offset", 'data' AS kind,
       CAST(strlen(text) AS BIGINT) AS data_len, md5(text) AS data_md5, '' AS err
FROM documents""",
)
def passthrough_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = read_documents(spark, sf_dir, topic="lang")
    # Every language is subscribed and none is bound: all get the default.
    langs = env.select("topic").distinct().select(
        "topic", F.lit(S.BUILTIN_LIBRARY).alias("library"), F.lit(S.DEFAULT_SYMBOL).alias("symbol")
    )
    events = decode(env, langs, samples.sample_registry())
    return events.select(
        F.coalesce("decoder", "topic").alias("tbl"),
        "topic",
        "offset",
        "kind",
        F.octet_length("data").cast("long").alias("data_len"),
        F.md5("data").alias("data_md5"),
        "err",
    )


# ---------------------------------------------------------------------------
# Route, decode, drain
# ---------------------------------------------------------------------------


@register(
    "route_decode_drain",
    SQL_EVENT_DECODE
    + """
SELECT tbl, topic, kind, hex(data) AS data_hex, err FROM events_out""",
)
def route_decode_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    drained = to_drain(event_events(spark, sf_dir))
    return drained.select("tbl", "topic", "kind", F.hex("data").alias("data_hex"), "err")


@register(
    "route_counts",
    SQL_EVENT_DECODE
    + """
SELECT tbl, topic, kind, count(*) AS n_rows,
       CAST(sum(octet_length(data)) AS BIGINT) AS data_bytes,
       CAST(max(strlen(err)) AS INTEGER) AS max_err_bytes
FROM events_out GROUP BY tbl, topic, kind""",
)
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship slice: decode `events`, drain, count per (tbl, topic, kind)."""
    drained = to_drain(event_events(spark, sf_dir))
    return drained.groupBy("tbl", "topic", "kind").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.octet_length("data")).cast("long").alias("data_bytes"),
        F.max(F.octet_length("err")).cast("int").alias("max_err_bytes"),
    )


# ---------------------------------------------------------------------------
# split data / error
# ---------------------------------------------------------------------------


def _drain_hex(df: DataFrame) -> DataFrame:
    return df.select("tbl", "topic", "kind", F.hex("data").alias("data_hex"), "err")


@register(
    "split_data",
    SQL_EVENT_DECODE + """
SELECT tbl, topic, kind, hex(data) AS data_hex, err FROM events_out WHERE kind = 'data'""",
)
def split_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _ = split_events(to_drain(event_events(spark, sf_dir)))
    return _drain_hex(data)


@register(
    "split_error",
    SQL_EVENT_DECODE + """
SELECT tbl, topic, kind, hex(data) AS data_hex, err FROM events_out WHERE kind = 'error'""",
)
def split_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, errors = split_events(to_drain(event_events(spark, sf_dir)))
    return _drain_hex(errors)


# ---------------------------------------------------------------------------
# A1, A2, A3: totals, rate, dispatch counts
# ---------------------------------------------------------------------------


@register(
    "event_totals",
    SQL_EVENT_DECODE + """
SELECT count(*) AS total,
       count(*) FILTER (WHERE kind = 'data') AS data,
       count(*) FILTER (WHERE kind = 'error') AS error
FROM events_out""",
)
def q_event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_totals(event_events(spark, sf_dir))


@register(
    "event_totals_by_topic",
    SQL_EVENT_DECODE + """
SELECT topic, count(*) AS total,
       count(*) FILTER (WHERE kind = 'data') AS data,
       count(*) FILTER (WHERE kind = 'error') AS error
FROM events_out GROUP BY topic""",
)
def q_event_totals_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_totals(event_events(spark, sf_dir), by=["topic"])


RATE_INTERVAL_S = 3600

_SQL_RATE_BUCKETS = SQL_EVENT_DECODE + f""",
b AS (
  SELECT ingest_ns // {RATE_INTERVAL_S * 1_000_000_000} AS bucket,
         count(*) AS n,
         count(*) FILTER (WHERE kind = 'data') AS nd,
         count(*) FILTER (WHERE kind = 'error') AS ne
  FROM events_out GROUP BY 1
)"""

_SQL_RATE_SELECT = f"""
SELECT bucket * {RATE_INTERVAL_S * 1000} AS bucket_start_ms,
       n AS delta,
       CAST(sum(n) OVER (ORDER BY bucket) AS BIGINT) AS total,
       CAST(sum(nd) OVER (ORDER BY bucket) AS BIGINT) AS data,
       CAST(sum(ne) OVER (ORDER BY bucket) AS BIGINT) AS error,
       n / {float(RATE_INTERVAL_S)} AS qps
"""


@register("event_rate", _SQL_RATE_BUCKETS + _SQL_RATE_SELECT + "FROM b")
def q_event_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rate(event_events(spark, sf_dir), RATE_INTERVAL_S)


@register(
    "event_rate_dense",
    _SQL_RATE_BUCKETS
    + """,
g AS (SELECT unnest(generate_series(min(bucket), max(bucket))) AS bucket FROM b),
d AS (SELECT g.bucket, coalesce(b.n, 0) AS n, coalesce(b.nd, 0) AS nd, coalesce(b.ne, 0) AS ne
      FROM g LEFT JOIN b USING (bucket))"""
    + _SQL_RATE_SELECT.replace("FROM b", "")
    + "FROM d",
)
def q_event_rate_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rate(event_events(spark, sf_dir), RATE_INTERVAL_S, dense=True)


@register(
    "dispatch_counts",
    SQL_EVENT_DECODE + """
SELECT tbl, count(*) AS dispatched FROM events_out WHERE kind = 'data' GROUP BY tbl""",
)
def q_dispatch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch_counts(to_drain(event_events(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Event text
# ---------------------------------------------------------------------------

@register(
    "event_text",
    """
WITH c AS (SELECT role AS topic, conv_id * 1000 + turn AS "offset", text FROM conversations)
SELECT topic, "offset",
       CASE WHEN topic = 'system' THEN 'error' ELSE 'data' END AS kind,
       CASE WHEN topic = 'system' THEN '[ERROR] topic=' || topic || ' msg=decode failed'
            ELSE '[DATA] topic=' || topic || ' len=' || CAST(strlen(text) AS VARCHAR)
                 || CASE WHEN strlen(text) > 0 THEN ' payload=' || text ELSE '' END
       END AS line,
       CASE WHEN topic = 'system' THEN '[drain] system decode failed' ELSE '' END AS notice
FROM c""",
)
def q_event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = read_conversations(spark, sf_dir)
    system = F.col("topic") == "system"
    bindings = env.select("topic").distinct().select(
        "topic",
        F.when(system, F.lit(samples.SAMPLE_LIBRARY)).otherwise(F.lit(S.BUILTIN_LIBRARY)).alias("library"),
        F.when(system, F.lit("skip_all")).otherwise(F.lit(S.DEFAULT_SYMBOL)).alias("symbol"),
    )
    events = decode(env, bindings, samples.sample_registry())
    return events.select(
        "topic",
        "offset",
        "kind",
        event_text(F.col("topic"), F.col("kind"), F.col("data"), F.col("err")).alias("line"),
        F.when(F.col("kind") == S.EVENT_ERROR, error_line(F.col("topic"), F.col("err")))
        .otherwise(F.lit(""))
        .alias("notice"),
    )


# ---------------------------------------------------------------------------
# A4: current bindings after a control log derived from every event
# ---------------------------------------------------------------------------


@register(
    "current_bindings",
    """
WITH log AS (
  SELECT epoch_us(ts) // 1000 AS effective_at, event_id AS seq,
         CASE event_type WHEN 'click' THEN 'bind' WHEN 'view' THEN 'rebind'
                         WHEN 'purchase' THEN 'unbind' WHEN 'signup' THEN 'subscribe' ELSE 'bind' END AS op,
         'user_' || CAST(user_id AS VARCHAR) AS topic,
         CASE WHEN event_type IN ('click', 'view', 'error') THEN 'samples' END AS library,
         CASE WHEN event_type IN ('click', 'view', 'error')
              THEN 'dec_' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) END AS symbol,
         event_type <> 'error' AS valid
  FROM events
),
ch AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY topic ORDER BY effective_at DESC, seq DESC) AS rn
    FROM log WHERE op IN ('bind', 'rebind', 'unbind') AND coalesce(valid, true)) WHERE rn = 1
),
sb AS (
  SELECT * FROM (
    SELECT topic, effective_at, seq,
           row_number() OVER (PARTITION BY topic ORDER BY effective_at DESC, seq DESC) AS rn
    FROM log WHERE op = 'subscribe') WHERE rn = 1
)
SELECT coalesce(ch.topic, sb.topic) AS topic,
       CASE WHEN ch.op IN ('bind', 'rebind') THEN ch.library ELSE 'builtin' END AS library,
       CASE WHEN ch.op IN ('bind', 'rebind') THEN ch.symbol ELSE 'default_decoder' END AS symbol
FROM ch FULL OUTER JOIN sb ON ch.topic = sb.topic
WHERE ch.op IN ('bind', 'rebind')
   OR (sb.topic IS NOT NULL AND (ch.topic IS NULL OR sb.effective_at > ch.effective_at
                                 OR (sb.effective_at = ch.effective_at AND sb.seq > ch.seq)))""",
)
def q_current_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_bindings(samples.events_control_log(read_table(spark, sf_dir, "events")))


# ---------------------------------------------------------------------------
# Route as of a daily binding log
# ---------------------------------------------------------------------------

SQL_ASOF_ROUTED = """
first_ev AS (
  SELECT topic, day, ms AS effective_at, event_id AS seq FROM (
    SELECT event_type AS topic, (epoch_us(ts) // 1000) // 86400000 AS day,
           epoch_us(ts) // 1000 AS ms, event_id,
           row_number() OVER (PARTITION BY event_type, (epoch_us(ts) // 1000) // 86400000
                              ORDER BY epoch_us(ts) // 1000, event_id) AS rn
    FROM events) WHERE rn = 1
),
log AS (
  SELECT effective_at, seq, topic,
         CASE day % 5 WHEN 0 THEN 'bind' WHEN 1 THEN 'rebind' WHEN 2 THEN 'unbind'
                      WHEN 3 THEN 'subscribe' ELSE 'bind' END AS op,
         CASE day % 5 WHEN 0 THEN 'json_k' WHEN 1 THEN 'even_k' WHEN 4 THEN 'skip_all' END AS symbol,
         day % 5 <> 4 AS valid
  FROM first_ev
),
ch AS (SELECT topic, effective_at, seq, op, symbol FROM log WHERE op IN ('bind', 'rebind', 'unbind') AND valid),
sb AS (SELECT topic, effective_at, seq FROM log WHERE op = 'subscribe'),
r0 AS (
  SELECT env.*, ch.effective_at AS c_t, ch.seq AS c_s, ch.op AS c_op, ch.symbol AS c_sym
  FROM env ASOF LEFT JOIN ch ON env.topic = ch.topic AND env.timestamp_ms >= ch.effective_at
),
r1 AS (
  SELECT r0.*, sb.effective_at AS s_t, sb.seq AS s_s
  FROM r0 ASOF LEFT JOIN sb ON r0.topic = sb.topic AND r0.timestamp_ms >= sb.effective_at
),
routed AS (
  SELECT topic, "partition", "offset", timestamp_ms, "key", payload,
         CASE WHEN c_op IN ('bind', 'rebind') THEN c_sym
              WHEN s_t IS NOT NULL AND (c_t IS NULL OR s_t > c_t OR (s_t = c_t AND s_s > c_s))
                THEN 'default_decoder' END AS decoder
  FROM r1
)"""


@register(
    "route_as_of",
    "WITH" + SQL_EVENT_ENV + "," + SQL_ASOF_ROUTED + "," + SQL_DECODE_BODY + """
SELECT topic, "offset", tbl, kind, hex(data) AS data_hex, err FROM events_out""",
)
def q_route_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "events")
    events = decode_as_of(events_envelopes(table), samples.daily_binding_log(table), samples.sample_registry())
    return events.select(
        "topic",
        "offset",
        F.coalesce("decoder", "topic").alias("tbl"),
        "kind",
        F.hex("data").alias("data_hex"),
        "err",
    )


# ---------------------------------------------------------------------------
# Check bind requests (one per event) against a catalog
# ---------------------------------------------------------------------------


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _catalog_values_sql() -> str:
    rows = samples.sample_registry(with_python=True).catalog_rows() + samples.EXTRA_CATALOG
    body = ",\n  ".join("(" + ", ".join(_sql_value(x) for x in r) + ")" for r in rows)
    return f"cat(library, contract_version, symbol) AS (VALUES\n  {body})"


@register(
    "check_bindings",
    "WITH "
    + _catalog_values_sql()
    + """,
req AS (
  SELECT event_id AS "offset", event_type AS topic,
         CASE user_id % 5 WHEN 0 THEN 'samples' WHEN 1 THEN 'pysamples' WHEN 2 THEN 'lib_old'
                          WHEN 3 THEN 'lib_nover' ELSE 'lib_gone' END AS library,
         CASE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 4
              WHEN 0 THEN 'json_k' WHEN 1 THEN 'skip_all' WHEN 2 THEN 'py_checksum'
              ELSE 'even_k' END AS symbol
  FROM events
),
libs AS (SELECT library, max(contract_version) AS ver FROM cat GROUP BY library),
syms AS (SELECT DISTINCT library, symbol FROM cat WHERE symbol IS NOT NULL),
checked AS (
  SELECT r."offset", r.topic, r.library, r.symbol,
         CASE WHEN l.library IS NULL THEN r.library || ': cannot open shared object file: No such file or directory'
              WHEN l.ver IS NULL THEN 'symbol decoder_abi_version not found'
              WHEN l.ver <> 2 THEN 'decoder ABI version mismatch'
              WHEN s.symbol IS NULL THEN 'decoder symbol not found: ' || r.symbol
              ELSE '' END AS err
  FROM req r
  LEFT JOIN libs l ON r.library = l.library
  LEFT JOIN syms s ON r.library = s.library AND r.symbol = s.symbol
)
SELECT "offset", topic, library, symbol, err = '' AS ok, err FROM checked""",
)
def q_check_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = samples.bind_requests(read_table(spark, sf_dir, "events"))
    return check_bindings(requests, samples.check_catalog(spark))


# ---------------------------------------------------------------------------
# Binding file (one line per event)
# ---------------------------------------------------------------------------


@register(
    "binding_file",
    "WITH "
    + _catalog_values_sql()
    + """,
ks AS (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
lines AS (
  SELECT CASE WHEN k % 10 = 9 THEN '# ' || event_type
              ELSE event_type || ' ' || CASE k % 4 WHEN 0 THEN '-' WHEN 1 THEN 'k' WHEN 2 THEN 'json_k'
                                                   ELSE 'nope' || CAST(k AS VARCHAR) END END AS value
  FROM ks
),
parsed AS (
  SELECT split_part(trim(value), ' ', 1) AS topic, split_part(trim(value), ' ', 2) AS target
  FROM lines WHERE trim(value) <> '' AND NOT starts_with(trim(value), '#')
),
wanted AS (SELECT topic, target, CASE WHEN target = '-' THEN 'decoder_entry' ELSE target END AS want FROM parsed),
exported AS (SELECT DISTINCT symbol FROM cat WHERE library = 'samples' AND symbol IS NOT NULL),
resolved AS (
  SELECT topic, want,
         CASE WHEN want IN (SELECT symbol FROM exported) THEN want
              WHEN target <> '-' AND 'decode_' || target IN (SELECT symbol FROM exported) THEN 'decode_' || target
         END AS symbol
  FROM wanted
)
SELECT topic, 'samples' AS library, symbol, symbol IS NOT NULL AS ok,
       CASE WHEN symbol IS NULL THEN 'decoder symbol not found: ' || want ELSE '' END AS err
FROM resolved""",
)
def q_binding_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = samples.binding_file_lines(read_table(spark, sf_dir, "events"))
    return bindings_from_text(lines, samples.SAMPLE_LIBRARY, samples.check_catalog(spark))


# ---------------------------------------------------------------------------
# Label at drain after a rebind / unbind
# ---------------------------------------------------------------------------

# The table as it stands at drain: view rebound, purchase unbound.
DRAIN_TIME_BINDINGS = [
    ("view", samples.SAMPLE_LIBRARY, "json_k_v2"),
    ("error", samples.SAMPLE_LIBRARY, "skip_all"),
    ("click", S.BUILTIN_LIBRARY, S.DEFAULT_SYMBOL),
]


@register(
    "relabel_after_rebind",
    SQL_EVENT_DECODE + """
SELECT CASE topic WHEN 'view' THEN 'json_k_v2' WHEN 'error' THEN 'skip_all'
                  WHEN 'click' THEN 'default_decoder' ELSE topic END AS tbl,
       topic, kind, hex(data) AS data_hex, err
FROM events_out""",
)
def q_relabel_after_rebind(spark: SparkSession, sf_dir: str) -> DataFrame:
    at_drain = samples.bindings_df(spark, DRAIN_TIME_BINDINGS)
    drained = to_drain(event_events(spark, sf_dir), label_bindings=at_drain)
    return _drain_hex(drained)


# ---------------------------------------------------------------------------
# Drain pages of 4096
# ---------------------------------------------------------------------------


@register(
    "drain_pages",
    SQL_EVENT_DECODE + """
SELECT topic, "partition", "offset", tbl, kind,
       row_number() OVER (ORDER BY topic, "partition", "offset") - 1 AS pos,
       (row_number() OVER (ORDER BY topic, "partition", "offset") - 1) // 4096 AS page
FROM events_out""",
)
def q_drain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    paged = drain_pages(event_events(spark, sf_dir), limit=S.DRAIN_LIMIT_DEFAULT)
    return paged.select(
        "topic", "partition", "offset", F.coalesce("decoder", "topic").alias("tbl"), "kind", "pos", "page"
    )


@register(
    "drain_page_sizes",
    SQL_EVENT_DECODE + """
SELECT page, count(*) AS n_rows FROM (
  SELECT (row_number() OVER (ORDER BY topic, "partition", "offset") - 1) // 4096 AS page FROM events_out)
GROUP BY page""",
)
def q_drain_page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    paged = drain_pages(event_events(spark, sf_dir), limit=S.DRAIN_LIMIT_DEFAULT)
    return paged.groupBy("page").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------
# Python decoders on documents (one Arrow UDF for all of them)
# ---------------------------------------------------------------------------


@register(
    "python_decoder",
    """
WITH d AS (SELECT lang AS topic, doc_id AS "offset", coalesce(text, '') AS text FROM documents),
o AS (
  SELECT topic, "offset",
    CASE topic WHEN 'en' THEN 'py_strict' WHEN 'fr' THEN 'py_normal_form' WHEN 'de' THEN 'py_checksum' WHEN 'es' THEN 'default_decoder'
               ELSE topic END AS tbl,
    CASE WHEN topic = 'fr' AND strlen(text) = 0 THEN 'error'
         WHEN topic = 'en' AND contains(text, '!!') THEN 'error'
         WHEN topic IN ('en', 'fr', 'de', 'es') THEN 'data' ELSE 'error' END AS kind,
    CASE topic WHEN 'en' THEN replace(text, chr(10), ' ')
               WHEN 'de' THEN left(md5(text), 16) || ' ' || text
               WHEN 'fr' THEN nfc_normalize(text) ELSE text END AS out_text,
    CASE WHEN topic = 'fr' AND strlen(text) = 0 THEN 'empty payload'
         WHEN topic = 'en' AND contains(text, '!!')
           THEN 'ValueError: payload shouts ' || CAST((strlen(text) - strlen(replace(text, '!!', ''))) // 2 AS VARCHAR) || ' times'
         WHEN topic IN ('en', 'fr', 'de', 'es') THEN '' ELSE 'decoder not bound' END AS err
  FROM d
)
SELECT topic, "offset", tbl, kind,
       CAST(CASE WHEN kind = 'data' THEN strlen(out_text) ELSE 0 END AS BIGINT) AS data_len,
       CASE WHEN kind = 'data' THEN md5(out_text) ELSE md5('') END AS data_md5,
       err
FROM o""",
)
def q_python_decoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = read_documents(spark, sf_dir, topic="lang")
    events = decode(env, samples.bindings_df(spark, samples.DOCUMENT_BINDINGS), samples.sample_registry(with_python=True))
    return events.select(
        "topic",
        "offset",
        F.coalesce("decoder", "topic").alias("tbl"),
        "kind",
        F.octet_length("data").cast("long").alias("data_len"),
        F.md5("data").alias("data_md5"),
        "err",
    )


# ---------------------------------------------------------------------------
# The same work as a stream (run to completion with
# availableNow, read back from the sink, compared with the batch oracle)
# ---------------------------------------------------------------------------


STREAM_PARTS = 3


def _write_part(table: DataFrame, part: int, src: str) -> None:
    """Append one part of `events` (by event_id) to the folder of a stream, in
    as many files as the scan has tasks."""
    table.filter(F.pmod("event_id", F.lit(STREAM_PARTS)) == part).write.mode("append").parquet(src)


def _part_stream(spark: SparkSession, src: str, schema: StructType, parts: int) -> DataFrame:
    """The ``parts`` parts in the folder ``src`` as a stream of about as many
    micro-batches, however many files they have: a micro-batch costs the same
    whatever it holds."""
    files = len(spark.read.schema(schema).parquet(src).inputFiles())
    return events_envelopes(file_stream(spark, src, schema, max_files_per_trigger=-(-files // parts)))


def _event_stream(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """`events`, which is one file, as a stream of `STREAM_PARTS`
    micro-batches."""
    table = read_table(spark, sf_dir, "events")
    for part in range(STREAM_PARTS):
        _write_part(table, part, base + "/src")
    return _part_stream(spark, base + "/src", table.schema, STREAM_PARTS)


def _constant_bindings(spark: SparkSession, batch_id: int) -> DataFrame:
    return samples.event_bindings(spark)


@register("stream_decode", SQL_EVENT_DECODE + """
SELECT tbl, topic, kind, hex(data) AS data_hex, err FROM events_out""")
def q_stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_folder(spark, "stream_decode")
    events = decode_stream(
        _event_stream(spark, sf_dir, base), samples.event_bindings(spark), samples.sample_registry(), samples.EVENT_TOPICS
    )
    q = start_table_sink(to_drain(events), base + "/out", base + "/ck", "append", available_now=True)
    q.awaitTermination()
    out = spark.read.option("basePath", base + "/out").parquet(base + "/out")
    return _drain_hex(out)


@register("routed_sink", SQL_EVENT_DECODE + """
SELECT tbl, topic, kind, hex(data) AS data_hex, err FROM events_out""")
def q_routed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_folder(spark, "routed_sink")
    q = start_routed(
        _event_stream(spark, sf_dir, base),
        base + "/out",
        samples.sample_registry(),
        _constant_bindings,
        base + "/ck",
        topics=samples.EVENT_TOPICS,
        available_now=True,
    )
    q.awaitTermination()
    return _drain_hex(read_routed(spark, base + "/out"))


@register("stream_totals", SQL_EVENT_DECODE + """
SELECT count(*) AS total,
       count(*) FILTER (WHERE kind = 'data') AS data,
       count(*) FILTER (WHERE kind = 'error') AS error
FROM events_out""")
def q_stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_folder(spark, "stream_totals")
    events = decode_stream(
        _event_stream(spark, sf_dir, base), samples.event_bindings(spark), samples.sample_registry(), samples.EVENT_TOPICS
    )
    q = start_table_sink(live_totals(events), base + "/out", base + "/ck", "complete", available_now=True)
    q.awaitTermination()
    return latest_per_key(spark, base + "/out", [])


@register("stream_rate", SQL_EVENT_DECODE + f"""
SELECT (ingest_ns // {RATE_INTERVAL_S * 1_000_000_000}) * {RATE_INTERVAL_S * 1000} AS window_start_ms,
       count(*) AS total,
       count(*) FILTER (WHERE kind = 'data') AS data,
       count(*) FILTER (WHERE kind = 'error') AS error
FROM events_out GROUP BY 1""")
def q_stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_folder(spark, "stream_rate")
    events = decode_stream(
        _event_stream(spark, sf_dir, base), samples.event_bindings(spark), samples.sample_registry(), samples.EVENT_TOPICS
    )
    q = start_table_sink(
        live_rate(events, RATE_INTERVAL_S), base + "/out", base + "/ck", "update", available_now=True
    )
    q.awaitTermination()
    return latest_per_key(spark, base + "/out", ["window_start_ms"])


# Binding versions (T2), one for each part of the stream.
@register("dispatch_targets", SQL_EVENT_DECODE + """
SELECT CASE kind WHEN 'data' THEN tbl END AS tbl, CASE kind WHEN 'error' THEN topic END AS topic,
       CASE kind WHEN 'data' THEN hex(data) END AS data_hex, CASE kind WHEN 'error' THEN err END AS err
FROM events_out""")
def q_dispatch_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data rows go to a function per target, error rows to the side
    channel. The receiver stores what it gets with the token; the tokens that
    count are the records'."""
    base = scratch_folder(spark, "dispatch_targets")
    dispatcher = Dispatcher(base + "/sent", *samples.storing_receiver(base + "/got"))
    q = start_routed(
        _event_stream(spark, sf_dir, base),
        base + "/sent",
        samples.sample_registry(),
        _constant_bindings,
        base + "/ck",
        topics=samples.EVENT_TOPICS,
        available_now=True,
        sink=dispatcher,
    )
    q.awaitTermination()
    got = spark.read.schema("token string, tbl string, topic string, data binary, err string").parquet(base + "/got")
    counted = dispatched(spark, base + "/sent").select("token").distinct()
    return got.join(counted, "token", "left_semi").select("tbl", "topic", F.hex("data").alias("data_hex"), "err")


@register("incremental_bindings", ORACLES["current_bindings"])
def q_incremental_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the control log arrives in parts; after each, the loader folds what
    is new into the state it keeps. A new loader goes on after the second."""
    base = scratch_folder(spark, "incremental_bindings")
    log = samples.events_control_log(read_table(spark, sf_dir, "events"))
    first, last = log.agg(F.min("seq"), F.max("seq")).first()
    part = F.floor((F.col("seq") - F.lit(first or 0)) * STREAM_PARTS / F.lit((last or 0) - (first or 0) + 1))
    for p in range(STREAM_PARTS):
        log.where(part == p).write.mode("append").parquet(base + "/log")
        if p != 1:
            loader = IncrementalBindings(base + "/log", base + "/state")
        bindings = loader(spark, p)
    return bindings


REBIND_VERSIONS = [
    samples.EVENT_BINDINGS,
    [("view", samples.SAMPLE_LIBRARY, "even_k")] + samples.EVENT_BINDINGS[1:],
    samples.EVENT_BINDINGS[1:],
]


@register(
    "stream_rebind_per_batch",
    "WITH" + SQL_EVENT_ENV + f""",
routed AS (
  SELECT env.*, CASE topic WHEN 'click' THEN 'default_decoder' WHEN 'error' THEN 'skip_all' WHEN 'purchase' THEN 'even_k'
                           WHEN 'view' THEN CASE "offset" % {STREAM_PARTS} WHEN 0 THEN 'json_k' WHEN 1 THEN 'even_k'
                                                                        ELSE 'default_decoder' END END AS decoder
  FROM env
),""" + SQL_DECODE_BODY + f"""
SELECT "offset" % {STREAM_PARTS} AS part, tbl, topic, kind, hex(data) AS data_hex, err FROM events_out""",
)
def q_stream_rebind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, never restarted. Before each part arrives the binding
    table is rewritten; every micro-batch reads it anew, so the part is decoded
    by its own version."""
    base = scratch_folder(spark, "stream_rebind_per_batch")
    src, out, held = base + "/src", base + "/out", base + "/bindings"
    table = read_table(spark, sf_dir, "events")
    rows = [(part, *row) for part, version in enumerate(REBIND_VERSIONS) for row in version]
    versions = local_table(spark, rows, "part int, topic string, library string, symbol string")

    def load(s: SparkSession, batch_id: int) -> DataFrame:
        now = s.read.parquet(held)
        last = now.agg(F.max("part")).first()[0]
        return now.filter(F.col("part") == last).drop("part")

    query = None
    for part in range(STREAM_PARTS):
        versions.filter(F.col("part") == part).write.mode("append").parquet(held)
        _write_part(table, part, src)
        if query is None:
            stream = _part_stream(spark, src, table.schema, 1)
            query = start_routed(
                stream, out, samples.sample_registry(), load, base + "/ck", topics=samples.EVENT_TOPICS, keep=["offset"]
            )
        query.processAllAvailable()
    query.stop()
    routed = read_routed(spark, out)
    return routed.select(
        (F.col("offset") % STREAM_PARTS).alias("part"), "tbl", "topic", "kind", F.hex("data").alias("data_hex"), "err"
    )


@register("stream_restart", SQL_EVENT_DECODE + """
SELECT tbl, topic, kind, hex(data) AS data_hex, err FROM events_out""")
def q_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S7: the stream is stopped after each part and started again on its
    checkpoint and sink; no row is lost or doubled."""
    base = scratch_folder(spark, "stream_restart")
    table = read_table(spark, sf_dir, "events")
    for part in range(STREAM_PARTS):
        _write_part(table, part, base + "/src")
        stream = _part_stream(spark, base + "/src", table.schema, part + 1)
        query = start_routed(
            stream,
            base + "/out",
            samples.sample_registry(),
            _constant_bindings,
            base + "/ck",
            topics=samples.EVENT_TOPICS,
            available_now=True,
        )
        query.awaitTermination()
    return _drain_hex(read_routed(spark, base + "/out"))


# ---------------------------------------------------------------------------
# The segmented log as a source
# ---------------------------------------------------------------------------

SUBSCRIBED = ["click", "purchase", "view"]


def _log_part(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """One part of `events` (of consecutive offsets) as envelopes."""
    env = read_events(spark, sf_dir)
    span = env.agg((F.max("offset") + 1).alias("n")).first()["n"] or 1
    at = F.expr(f"(offset * {STREAM_PARTS}) div {span}")
    return env.where(at == part)


def _append_part(spark: SparkSession, sf_dir: str, path: str, part: int) -> None:
    append_segments(_log_part(spark, sf_dir, part), path, width=4096)


def _envelope_hex(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", "partition", "offset", "timestamp_ms", F.hex("key").alias("key_hex"), F.hex("payload").alias("payload_hex")
    )


_SQL_ENVELOPE_HEX = "WITH" + SQL_EVENT_ENV + """
SELECT topic, "partition", "offset", timestamp_ms, hex("key") AS key_hex, hex(encode(payload)) AS payload_hex
FROM env WHERE topic IN ('click', 'purchase', 'view')"""


def _sunk(spark: SparkSession, base: str) -> DataFrame:
    out = spark.read.option("basePath", base + "/out").schema(S.ENVELOPE_SCHEMA).parquet(base + "/out")
    return _envelope_hex(out)


@register("segment_source", _SQL_ENVELOPE_HEX)
def q_segment_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly the named topics, from the earliest offset, with a
    consumer's configuration; each part of the log arrives while it runs."""
    base = scratch_folder(spark, "segment_source")
    _append_part(spark, sf_dir, base + "/log", 0)
    cfg = {"group.id": "routecast", "auto.offset.reset": "beginning", "enable.auto.commit": True, "decode_threads": 4}
    df = read_segments(spark, base + "/log", SUBSCRIBED, cfg)
    q = start_table_sink(df, base + "/out", base + "/ck", "append", processing_time="0 seconds")
    try:
        q.processAllAvailable()
        for part in range(1, STREAM_PARTS):
            _append_part(spark, sf_dir, base + "/log", part)
            q.processAllAvailable()
    finally:
        q.stop()
    return _sunk(spark, base)


@register("segment_source_latest", _SQL_ENVELOPE_HEX + f"""
AND "offset" * {STREAM_PARTS} // (SELECT max("offset") + 1 FROM env) = {STREAM_PARTS - 1}""")
def q_segment_source_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts at the latest offset reads the last part only,
    which arrives after it started."""
    base = scratch_folder(spark, "segment_source_latest")
    for part in range(STREAM_PARTS - 1):
        _append_part(spark, sf_dir, base + "/log", part)
    df = read_segments(spark, base + "/log", SUBSCRIBED, {"auto.offset.reset": "latest"})
    q = start_table_sink(df, base + "/out", base + "/ck", "append", processing_time="0 seconds")
    try:
        q.processAllAvailable()
        _append_part(spark, sf_dir, base + "/log", STREAM_PARTS - 1)
        q.processAllAvailable()
    finally:
        q.stop()
    return _sunk(spark, base)


@register("segment_source_offsets", _SQL_ENVELOPE_HEX + """
AND CASE WHEN topic = 'click' THEN "offset" >= (SELECT max("offset") // 2 FROM env) + 100 * "partition"
         WHEN topic = 'view' AND "partition" = 1 THEN "offset" < (SELECT max("offset") // 2 FROM env)
         ELSE topic <> 'purchase' OR "partition" <> 0 END""")
def q_segment_source_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded read between given offsets of single partitions."""
    base = scratch_folder(spark, "segment_source_offsets")
    for part in range(STREAM_PARTS):
        _append_part(spark, sf_dir, base + "/log", part)
    half = (read_events(spark, sf_dir).agg(F.max("offset")).first()[0] or 0) // 2
    start = {"click": {str(p): half + 100 * p for p in range(4)}}
    end = {topic: {str(p): -1 for p in range(4)} for topic in SUBSCRIBED}
    end["view"]["1"], end["purchase"]["0"] = half, 0
    return _envelope_hex(
        read_segments(spark, base + "/log", SUBSCRIBED, stream=False, starting_offsets=start, ending_offsets=end)
    )


@register("segment_source_bounded", _SQL_ENVELOPE_HEX)
def q_segment_source_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of at most a third of a part's offsets, stopped
    after each part and started again on the same checkpoint."""
    base = scratch_folder(spark, "segment_source_bounded")
    for part in range(STREAM_PARTS):
        _append_part(spark, sf_dir, base + "/log", part)
        ends = _log_part(spark, sf_dir, part).groupBy("topic", "partition").agg((F.max("offset") - F.min("offset") + 1).alias("n"))
        n = ends.where(F.col("topic").isin(SUBSCRIBED)).agg(F.sum("n")).first()[0] or 1
        cfg = {"auto.offset.reset": "earliest", "maxOffsetsPerTrigger": max(1, n // 3 + 1)}
        df = read_segments(spark, base + "/log", SUBSCRIBED, cfg, progress=base + "/progress")
        q = start_table_sink(df, base + "/out", base + "/ck", "append", processing_time="0 seconds")
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    return _sunk(spark, base)


# ---------------------------------------------------------------------------
# T3 and J2 with state
# ---------------------------------------------------------------------------


@register("stream_rate_totals", ORACLES["event_rate_dense"])
def q_stream_rate_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals, rate and idle intervals, live; the stream is stopped
    after each part and started again."""
    base = scratch_folder(spark, "stream_rate_totals")
    table = read_table(spark, sf_dir, "events")
    for part in range(STREAM_PARTS):
        _write_part(table, part, base + "/src")
        env = _part_stream(spark, base + "/src", table.schema, part + 1)
        events = decode_stream(env, samples.event_bindings(spark), samples.sample_registry(), samples.EVENT_TOPICS)
        with rocksdb_state(spark):
            q = start_table_sink(
                live_rate_totals(events, RATE_INTERVAL_S), base + "/out", base + "/ck", "update", available_now=True
            )
        q.awaitTermination()
    return latest_per_key(spark, base + "/out", ["bucket_start_ms"]).select(*RATE_COLUMNS)


@register("stream_route_as_of", ORACLES["route_as_of"])
def q_stream_route_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 on two streams: each part of the messages comes before the part of
    the control log that it needs, and the stream is restarted between. A last
    clock row lets go of what still waits."""
    base = scratch_folder(spark, "stream_route_as_of")
    table = read_table(spark, sf_dir, "events")
    log = samples.daily_binding_log(table)
    order = log.agg(F.min("effective_at").alias("lo"), F.max("effective_at").alias("hi")).first()
    lo, hi = order.lo or 0, order.hi or 0
    part_of = F.least(F.expr(f"((effective_at - {lo}) * {STREAM_PARTS}) div {max(1, hi - lo)}"), F.lit(STREAM_PARTS - 1))
    last = local_table(spark, [(hi + 10 * 86_400_000, 0, CLOCK_OP, "", None, None, True)], S.BINDING_LOG_SCHEMA)
    for part in range(STREAM_PARTS + 1):
        if part < STREAM_PARTS:
            _write_part(table, part, base + "/src")
            operations = log.where(part_of == part)
        else:
            operations = last
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.BINDING_LOG_SCHEMA]
        operations.select(*columns).write.mode("append").parquet(base + "/control")
        env = events_envelopes(file_stream(spark, base + "/src", table.schema))
        control = file_stream(spark, base + "/control", S.BINDING_LOG_SCHEMA)
        with rocksdb_state(spark):
            q = start_table_sink(
                route_as_of_stream(env, control, "1 day", hold_ms=86_400_000), base + "/out", base + "/ck", "append", available_now=True
            )
        q.awaitTermination()
    events = decode_routed(spark.read.parquet(base + "/out").drop("batch_id"), samples.sample_registry(), "error", None)
    return events.select(
        "topic",
        "offset",
        F.coalesce("decoder", "topic").alias("tbl"),
        "kind",
        F.hex("data").alias("data_hex"),
        "err",
    )


# ---------------------------------------------------------------------------
# J4 + A4: bind requests checked, then the last valid one per topic
# ---------------------------------------------------------------------------


@register(
    "validated_bindings",
    "WITH "
    + _catalog_values_sql()
    + """,
req AS (
  SELECT epoch_us(ts) // 1000 AS effective_at, event_id AS seq, event_type AS topic,
         CASE user_id % 5 WHEN 0 THEN 'samples' WHEN 1 THEN 'pysamples' WHEN 2 THEN 'lib_old'
                          WHEN 3 THEN 'lib_nover' ELSE 'lib_gone' END AS library,
         CASE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 4
              WHEN 0 THEN 'json_k' WHEN 1 THEN 'skip_all' WHEN 2 THEN 'py_checksum'
              ELSE 'even_k' END AS symbol
  FROM events
),
libs AS (SELECT library, max(contract_version) AS ver FROM cat GROUP BY library),
syms AS (SELECT DISTINCT library, symbol FROM cat WHERE symbol IS NOT NULL),
ok_req AS (
  SELECT r.* FROM req r
  JOIN libs l ON r.library = l.library
  JOIN syms s ON r.library = s.library AND r.symbol = s.symbol
  WHERE l.ver = 2
),
last_ok AS (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY effective_at DESC, seq DESC) AS rn FROM ok_req
)
SELECT topic, library, symbol FROM last_ok WHERE rn = 1""",
)
def q_validated_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = samples.bind_request_log(read_table(spark, sf_dir, "events"))
    return current_bindings(validate_log(log, samples.check_catalog(spark)))


# ---------------------------------------------------------------------------
# J1 with many topics: documents routed by source (20 topics)
# ---------------------------------------------------------------------------

SOURCE_SUBSCRIBED = [f"src{i}" for i in range(0, 10)]
SOURCE_BINDINGS = [(f"src{i}", samples.SAMPLE_LIBRARY, "one_line") for i in range(10, 15)]


@register(
    "source_routing_counts",
    """
WITH d AS (
  SELECT source AS topic, text,
         CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'default_decoder'
              WHEN CAST(substr(source, 4) AS INTEGER) < 15 THEN 'one_line' END AS decoder
  FROM documents
),
o AS (
  SELECT coalesce(decoder, topic) AS tbl, topic,
         CASE WHEN decoder = 'default_decoder' THEN 'data'
              WHEN decoder = 'one_line' AND NOT contains(text, chr(10)) THEN 'data'
              ELSE 'error' END AS kind,
         text, decoder
  FROM d
)
SELECT tbl, topic, kind, count(*) AS n_rows,
       CAST(sum(CASE WHEN kind = 'data' THEN strlen(text) ELSE 0 END) AS BIGINT) AS data_bytes,
       CAST(max(CASE WHEN kind = 'data' THEN 0
                     WHEN decoder IS NULL THEN strlen('decoder not bound')
                     ELSE strlen('more than one line') END) AS INTEGER) AS max_err_bytes
FROM o GROUP BY tbl, topic, kind""",
)
def q_source_routing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source: ten subscribed (default decoder), five bound to
    `one_line`, five neither (`decoder not bound`)."""
    env = read_documents(spark, sf_dir, topic="source")
    events = decode(
        env, samples.bindings_df(spark, SOURCE_BINDINGS), samples.sample_registry(), topics=SOURCE_SUBSCRIBED
    )
    return to_drain(events).groupBy("tbl", "topic", "kind").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.octet_length("data")).cast("long").alias("data_bytes"),
        F.max(F.octet_length("err")).cast("int").alias("max_err_bytes"),
    )


# ---------------------------------------------------------------------------
# D3 + D4: the whole decode contract over every event
# ---------------------------------------------------------------------------

EVENT_TYPES = ["click", "view", "error", "purchase", "signup"]


@register(
    "decode_contract",
    "WITH" + SQL_EVENT_ENV + """,
c AS (SELECT env.*, TRY_CAST(json_extract_string(payload, '$.k') AS BIGINT) % 7 AS cls FROM env)
SELECT topic, "offset", 'contract_mix' AS tbl,
       CASE WHEN cls = 0 THEN 'data' ELSE 'error' END AS kind,
       CASE WHEN cls = 0 THEN hex(encode(payload)) ELSE '' END AS data_hex,
       CASE cls WHEN 0 THEN ''
                WHEN 2 THEN 'bad k=' || CAST(TRY_CAST(json_extract_string(payload, '$.k') AS BIGINT) AS VARCHAR)
                WHEN 6 THEN repeat('w', 200)
                ELSE 'decode failed' END AS err
FROM c""",
)
def q_decode_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    bindings = samples.bindings_df(spark, [(t, samples.SAMPLE_LIBRARY, "contract_mix") for t in EVENT_TYPES])
    events = decode(read_events(spark, sf_dir), bindings, samples.sample_registry())
    return events.select(
        "topic",
        "offset",
        F.coalesce("decoder", "topic").alias("tbl"),
        "kind",
        F.hex("data").alias("data_hex"),
        "err",
    )


# ---------------------------------------------------------------------------
# J1 + U1: one symbol in two libraries
# ---------------------------------------------------------------------------


@register(
    "two_libraries",
    "WITH" + SQL_EVENT_ENV + """,
k AS (SELECT env.*, json_extract_string(payload, '$.k') AS k FROM env),
o AS (
  SELECT topic, "offset",
         CASE WHEN topic IN ('click', 'error') THEN k
              WHEN topic = 'view' THEN CAST(2 * TRY_CAST(k AS BIGINT) AS VARCHAR) END AS out_text
  FROM k
)
SELECT topic, "offset",
       CASE topic WHEN 'click' THEN 'decoder_entry' WHEN 'view' THEN 'decoder_entry' WHEN 'purchase' THEN 'decoder_entry'
                  WHEN 'error' THEN 'json_k' ELSE topic END AS tbl,
       CASE WHEN out_text IS NULL THEN 'error' ELSE 'data' END AS kind,
       coalesce(hex(encode(out_text)), '') AS data_hex,
       CASE WHEN topic = 'purchase' THEN 'decoder symbol not found: decoder_entry'
            WHEN topic = 'signup' THEN 'decoder not bound'
            WHEN out_text IS NULL THEN 'field k missing' ELSE '' END AS err
FROM o""",
)
def q_two_libraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`click` and `view` are bound to the anchor symbol of two libraries,
    `purchase` to that of a library that is not there."""
    rows = [
        ("click", samples.SAMPLE_LIBRARY, S.ANCHOR_SYMBOL),
        ("view", samples.OTHER_LIBRARY, S.ANCHOR_SYMBOL),
        ("purchase", "lib_gone", S.ANCHOR_SYMBOL),
        ("error", samples.SAMPLE_LIBRARY, "json_k"),
    ]
    events = decode(read_events(spark, sf_dir), samples.bindings_df(spark, rows), samples.sample_registry())
    return events.select(
        "topic",
        "offset",
        F.coalesce("decoder", "topic").alias("tbl"),
        "kind",
        F.hex("data").alias("data_hex"),
        "err",
    )
