"""Sample decoders and binding tables used by the registered queries.

These play the part of user plugins: small decoders a user registers next to
the built-ins. The queries bind them to topics of the provided tables.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.functions.contract import decode_result
from routecast.functions.decoders import BatchOut, DecodeOut, DecoderRegistry, Env, PyBatch, PyEnvelope
from routecast.sources.envelopes import epoch_millis_ntz
from routecast.sources.local import local_table

SAMPLE_LIBRARY = "samples"
PY_LIBRARY = "pysamples"
OTHER_LIBRARY = "others"

# Subscription of the events topics; `signup` is deliberately not
# subscribed and not bound, so it yields `decoder not bound`.
EVENT_TOPICS = ["click", "view", "error", "purchase"]

# Bindings of the flagship slice (click gets the default by subscription).
EVENT_BINDINGS = [
    ("view", SAMPLE_LIBRARY, "json_k"),
    ("error", SAMPLE_LIBRARY, "skip_all"),
    ("purchase", SAMPLE_LIBRARY, "even_k"),
]

ODD_MESSAGE_WIDTH = 120


# -- column decoders ---------------------------------------------------------


def json_k(env: Env) -> Column:
    """Data = text of the JSON field ``k``; ERR when it is absent."""
    k = F.get_json_object(env.payload.cast("string"), "$.k")
    return F.when(k.isNull(), decode_result(kind=S.KIND_ERR, err="field k missing")).otherwise(
        decode_result(kind=S.KIND_OK, data=k.cast("binary"))
    )


def skip_all(env: Env) -> Column:
    """Always SKIP, without a message (so the event says `decode failed`)."""
    return decode_result(kind=S.KIND_SKIP)


def _k_of(env: Env) -> Column:
    return F.get_json_object(env.payload.cast("string"), "$.k").try_cast("long")


def even_k(env: Env) -> Column:
    """Passthrough for payloads whose JSON field ``k`` is an even whole number;
    others are ERR with a 120-character message."""
    k = F.coalesce(F.get_json_object(env.payload.cast("string"), "$.k"), F.lit("missing"))
    message = F.rpad(F.concat(F.lit("field k is not even: "), k), ODD_MESSAGE_WIDTH, "-")
    return F.when(F.pmod(_k_of(env), F.lit(2)) == 0, decode_result(kind=S.KIND_OK, data=env.payload)).otherwise(
        decode_result(kind=S.KIND_ERR, err=message)
    )


def one_line(env: Env) -> Column:
    """Passthrough for payloads without a line break, else ERR."""
    payload = F.coalesce(env.payload, F.lit(b"").cast("binary"))
    broken = F.contains(payload, F.lit(b"\n").cast("binary"))
    return F.when(broken, decode_result(kind=S.KIND_ERR, err="more than one line")).otherwise(
        decode_result(kind=S.KIND_OK, data=payload)
    )


def k_doubled(env: Env) -> Column:
    """Data = twice the JSON field ``k``; ERR when it is no whole number. Other
    libraries export it under a symbol that the samples also use."""
    k = F.try_multiply(_k_of(env), F.lit(2).cast("long"))
    return F.when(k.isNull(), decode_result(kind=S.KIND_ERR, err="field k missing")).otherwise(
        decode_result(kind=S.KIND_OK, data=k.cast("string").cast("binary"))
    )


def contract_mix(env: Env) -> Column:
    """Every row of the decode contract, chosen by the payload's ``k`` mod 7:
    0 OK with a message (ignored), 1 rc != 0 with OK, 2 ERR whose message has
    a NUL inside, 3 ERR without a message, 4 SKIP, 5 NEED_MORE, 6 an unknown
    kind with a 200-byte message. Written field by field (one small CASE per
    answer field, one struct), which keeps the generated code compact."""
    k = _k_of(env)
    cls = F.pmod(k, F.lit(7))
    payload = F.coalesce(env.payload, F.lit(b"").cast("binary"))
    kind = (
        F.when(cls.isin(0, 1), F.lit(S.KIND_OK))
        .when(cls.isin(2, 3), F.lit(S.KIND_ERR))
        .when(cls == 4, F.lit(S.KIND_SKIP))
        .when(cls == 5, F.lit(S.KIND_NEED_MORE))
        .otherwise(F.lit("WAT"))
    )
    err = (
        F.when(cls == 0, F.lit("ignored on success"))
        .when(cls == 2, F.concat(F.lit("bad k="), k.cast("string"), F.lit("\u0000hidden")))
        .when(cls == 6, F.lit("w" * 200))
        .otherwise(F.lit(""))
    )
    return decode_result(
        rc=F.when(cls == 1, F.lit(1)).otherwise(F.lit(0)),
        kind=kind,
        data=F.when(cls.isin(0, 1), payload).otherwise(F.lit(b"").cast("binary")),
        err=err,
    )


# -- batch and Python decoders -------------------------------------------------


def py_normal_form(batch: PyBatch) -> BatchOut:
    """Data = the text in Unicode normal form C, which Spark has no function
    for; ERR on an empty payload."""
    import unicodedata

    import pyarrow as pa

    texts = [(p or b"").decode("utf-8", "replace") for p in batch.payload.to_pylist()]
    return BatchOut(
        pa.array([unicodedata.normalize("NFC", t) for t in texts], pa.large_string()),
        pa.array([None if t else "empty payload" for t in texts], pa.large_string()),
    )


def py_checksum(env: PyEnvelope) -> DecodeOut:
    """Data = the payload behind the first half of its MD5 checksum and a blank."""
    import hashlib

    payload = env.payload or b""
    return DecodeOut(data=f"{hashlib.md5(payload).hexdigest()[:16]} ".encode() + payload)


def py_strict(env: PyEnvelope) -> DecodeOut:
    """Raises on payloads that shout (the error becomes an ERR row); otherwise
    data = the whole payload on one line (newlines become spaces)."""
    payload = env.payload or b""
    if b"!!" in payload:
        raise ValueError(f"payload shouts {payload.count(b'!!')} times")
    return DecodeOut(data=payload.replace(b"\n", b" "))


_REGISTRIES: dict[bool, DecoderRegistry] = {}


def sample_registry(with_python: bool = False) -> DecoderRegistry:
    """The sample decoders (built once per process; the registry caches its
    dispatch expression)."""
    reg = _REGISTRIES.get(with_python)
    if reg is None:
        reg = _REGISTRIES[with_python] = build_sample_registry(with_python)
    return reg


def build_sample_registry(with_python: bool) -> DecoderRegistry:
    reg = DecoderRegistry()
    reg.register_column("json_k", json_k, library=SAMPLE_LIBRARY)
    reg.register_column("skip_all", skip_all, library=SAMPLE_LIBRARY)
    reg.register_column("even_k", even_k, library=SAMPLE_LIBRARY)
    reg.register_column("one_line", one_line, library=SAMPLE_LIBRARY)
    reg.register_column("contract_mix", contract_mix, library=SAMPLE_LIBRARY)
    # Names a binding file resolves to: an alias target and the anchor.
    reg.register_column(S.ALIAS_PREFIX + "k", json_k, library=SAMPLE_LIBRARY)
    reg.register_column(S.ANCHOR_SYMBOL, json_k, library=SAMPLE_LIBRARY)
    # A second library with the same anchor and one more shared name.
    reg.register_column(S.ANCHOR_SYMBOL, k_doubled, library=OTHER_LIBRARY)
    reg.register_column("json_k", k_doubled, library=OTHER_LIBRARY)
    if with_python:
        reg.register_batch("py_normal_form", py_normal_form, library=PY_LIBRARY)
        reg.register_python("py_checksum", py_checksum, library=PY_LIBRARY)
        reg.register_python("py_strict", py_strict, library=PY_LIBRARY)
    return reg


# Documents by language: a batch, two Python and one column decoder.
DOCUMENT_BINDINGS = [
    ("en", PY_LIBRARY, "py_strict"),
    ("fr", PY_LIBRARY, "py_normal_form"),
    ("de", PY_LIBRARY, "py_checksum"),
    ("es", S.BUILTIN_LIBRARY, S.DEFAULT_SYMBOL),
]


def bindings_df(spark: SparkSession, rows) -> DataFrame:
    return local_table(spark, rows, S.BINDING_SCHEMA)


def event_bindings(spark: SparkSession) -> DataFrame:
    return bindings_df(spark, EVENT_BINDINGS)


# ---------------------------------------------------------------------------
# Control tables derived from `events` (so their size grows with the data)
# ---------------------------------------------------------------------------

def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").try_cast("long")


def events_control_log(events_table: DataFrame) -> DataFrame:
    """One control operation per event (for A4 at the size of the data).

    topic = ``user_<user_id>``; click binds ``dec_<k>``, view rebinds
    ``dec_<k>``, purchase unbinds, signup subscribes, error is a rejected
    bind. Order = (event time in ms, event_id).
    """
    op = (
        F.when(F.col("event_type") == "click", F.lit(S.OP_BIND))
        .when(F.col("event_type") == "view", F.lit(S.OP_REBIND))
        .when(F.col("event_type") == "purchase", F.lit(S.OP_UNBIND))
        .when(F.col("event_type") == "signup", F.lit(S.OP_SUBSCRIBE))
        .otherwise(F.lit(S.OP_BIND))
    )
    binds = F.col("op").isin(S.OP_BIND, S.OP_REBIND)
    return (
        events_table.select(
            epoch_millis_ntz("ts").alias("effective_at"),
            F.col("event_id").cast("long").alias("seq"),
            op.alias("op"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("topic"),
            F.concat(F.lit("dec_"), _k().cast("string")).alias("_sym"),
            (F.col("event_type") != "error").alias("valid"),
        )
        .select(
            "effective_at",
            "seq",
            "op",
            "topic",
            F.when(binds, F.lit(SAMPLE_LIBRARY)).alias("library"),
            F.when(binds, F.col("_sym")).alias("symbol"),
            "valid",
        )
    )


DAY_MS = 86_400_000

# Daily cycle of the as-of log: (op, symbol, valid) by day number mod 5.
DAILY_CYCLE = [
    (S.OP_BIND, "json_k", True),
    (S.OP_REBIND, "even_k", True),
    (S.OP_UNBIND, None, True),
    (S.OP_SUBSCRIBE, None, True),
    (S.OP_BIND, "skip_all", False),
]


def daily_binding_log(events_table: DataFrame) -> DataFrame:
    """A control log with one operation per (event_type, day) (for J2).

    The operation takes effect at the first event of that topic and day;
    which one follows the day number (``DAILY_CYCLE``). Its size grows with
    topics x days, not with messages: a control log.
    """
    ms = epoch_millis_ntz("ts")
    per_day = events_table.select(
        F.col("event_type").alias("topic"), ms.alias("_ms"), F.col("event_id").alias("_id")
    ).groupBy("topic", F.expr(f"_ms div {DAY_MS}").alias("_day")).agg(
        F.min(F.struct("_ms", "_id")).alias("_first")
    )
    slot = F.pmod(F.col("_day"), F.lit(len(DAILY_CYCLE)))

    def pick(i: int) -> Column:
        expr = None
        for n, row in enumerate(DAILY_CYCLE):
            v = F.lit(row[i])
            expr = F.when(slot == n, v) if expr is None else expr.when(slot == n, v)
        return expr

    symbol = pick(1)
    return per_day.select(
        F.col("_first._ms").alias("effective_at"),
        F.col("_first._id").cast("long").alias("seq"),
        pick(0).alias("op"),
        "topic",
        F.when(symbol.isNotNull(), F.lit(SAMPLE_LIBRARY)).alias("library"),
        symbol.cast("string").alias("symbol"),
        pick(2).alias("valid"),
    )


# Extra catalog rows: an old-contract library and one without a version.
EXTRA_CATALOG = [
    ("lib_old", 1, "json_k"),
    ("lib_nover", None, "json_k"),
]
REQUEST_LIBRARIES = [SAMPLE_LIBRARY, PY_LIBRARY, "lib_old", "lib_nover", "lib_gone"]
REQUEST_SYMBOLS = ["json_k", "skip_all", "py_checksum", "even_k"]


def check_catalog(spark: SparkSession) -> DataFrame:
    reg = sample_registry(with_python=True)
    return local_table(spark, reg.catalog_rows() + EXTRA_CATALOG, S.CATALOG_SCHEMA)


def _choose(index: Column, values: list[str]) -> Column:
    expr = None
    for n, v in enumerate(values):
        expr = F.when(index == n, F.lit(v)) if expr is None else expr.when(index == n, F.lit(v))
    return expr


def bind_requests(events_table: DataFrame) -> DataFrame:
    """One bind request per event (for J4): library by user, symbol by k."""
    return events_table.select(
        F.col("event_id").alias("offset"),
        F.col("event_type").alias("topic"),
        _choose(F.pmod(F.col("user_id"), F.lit(len(REQUEST_LIBRARIES))), REQUEST_LIBRARIES).alias("library"),
        _choose(F.pmod(_k(), F.lit(len(REQUEST_SYMBOLS))), REQUEST_SYMBOLS).alias("symbol"),
    )


def bind_request_log(events_table: DataFrame) -> DataFrame:
    """The bind requests of :func:`bind_requests` as a control log (one
    projection, ordered by event time and id), to be validated (J4)."""
    return events_table.select(
        epoch_millis_ntz("ts").alias("effective_at"),
        F.col("event_id").cast("long").alias("seq"),
        F.lit(S.OP_BIND).alias("op"),
        F.col("event_type").alias("topic"),
        _choose(F.pmod(F.col("user_id"), F.lit(len(REQUEST_LIBRARIES))), REQUEST_LIBRARIES).alias("library"),
        _choose(F.pmod(_k(), F.lit(len(REQUEST_SYMBOLS))), REQUEST_SYMBOLS).alias("symbol"),
        F.lit(True).alias("valid"),
    )


def binding_file_lines(events_table: DataFrame) -> DataFrame:
    """Binding-file text, one line per event (for D5), in column ``value``:
    ``<event_type> <target>`` with target ``-``, ``k`` (alias), ``json_k``
    (exported name) or ``nope<k>`` (unknown) by k; k ending in 9 gives a
    comment line."""
    k = _k()
    target = (
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit("-"))
        .when(F.pmod(k, F.lit(4)) == 1, F.lit("k"))
        .when(F.pmod(k, F.lit(4)) == 2, F.lit("json_k"))
        .otherwise(F.concat(F.lit("nope"), k.cast("string")))
    )
    line = F.when(
        F.pmod(k, F.lit(10)) == 9, F.concat(F.lit("# "), F.col("event_type"))
    ).otherwise(F.concat(F.col("event_type"), F.lit(" "), target))
    return events_table.select(line.alias("value"))


# -- a receiver of dispatched rows -------------------------------------------


def storing_receiver(folder: str):
    """``(upd, on_error, undo)`` that store what they get below ``folder``, a
    file a call, named by the token."""
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)

    def store(token: str, **columns) -> None:
        files, root = fs.FileSystem.from_uri(folder)
        n = max(len(c) for c in columns.values() if isinstance(c, pa.Array))
        types = {"token": pa.string(), "tbl": pa.string(), "topic": pa.string(), "data": pa.binary(), "err": pa.string()}
        columns["token"] = token
        values = {
            name: columns[name].cast(kind) if isinstance(columns.get(name), pa.Array) else pa.array([columns.get(name)] * n, kind)
            for name, kind in types.items()
        }
        with files.open_output_stream(f"{root}/{token}-{uuid.uuid4().hex}.parquet") as out:
            pq.write_table(pa.table(values), out)

    def upd(tbl: str | None, data: pa.Array, token: str) -> None:
        store(token, tbl=tbl, data=data)

    def on_error(topics: pa.Array, errs: pa.Array, token: str) -> None:
        store(token, topic=topics, err=errs)

    def undo(token: str) -> None:
        files, root = fs.FileSystem.from_uri(folder)
        for f in files.get_file_info(fs.FileSelector(root)):
            if f.base_name.startswith(token + "-"):
                files.delete_file(f.path)

    return upd, on_error, undo
