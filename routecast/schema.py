"""Schemas and fixed values shared by every operator.

A message travels through four shapes:

    envelope  (topic, partition, offset, timestamp_ms, key, payload)
    decoded   struct<rc, kind, data, err>            -- a decoder's answer
    event     envelope columns + (ingest_ns, decoder, kind, data, err)
    drain     (tbl, topic, kind, data, err)

The same shapes serve batch DataFrames and Structured Streaming ones.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being reproduced; they are
# listed here together, in natural order, and nowhere else.
# ---------------------------------------------------------------------------

# Decoder outcome kinds, in contract order 0..3.
KIND_OK = "OK"
KIND_ERR = "ERR"
KIND_NEED_MORE = "NEED_MORE"
KIND_SKIP = "SKIP"
DECODE_KINDS = (KIND_OK, KIND_ERR, KIND_NEED_MORE, KIND_SKIP)

# Event kinds.
EVENT_DATA = "data"
EVENT_ERROR = "error"

# Decoder contract version accepted by the binding check.
CONTRACT_VERSION = 2

# Bytes of a 96-byte error field without its terminator, for callers that want
# error texts cut to it; whole texts are kept unless asked.
ERR_FIELD_BYTES = 95

# Drain batch: default and minimum limit.
DRAIN_LIMIT_DEFAULT = 4096
DRAIN_LIMIT_MIN = 1

# Error messages.
MSG_NOT_BOUND = "decoder not bound"
MSG_DECODE_FAILED = "decode failed"
MSG_VERSION_MISMATCH = "decoder ABI version mismatch"
MSG_SYMBOL_NOT_FOUND = "decoder symbol not found: "
MSG_LIBRARY_MISSING_SUFFIX = ": cannot open shared object file: No such file or directory"
MSG_VERSION_SYMBOL_MISSING = "symbol decoder_abi_version not found"

# Symbols and names used by the built-in decoders and the binding file.
DEFAULT_SYMBOL = "default_decoder"
PASSTHROUGH_SYMBOL = "passthrough_decoder"
BUILTIN_LIBRARY = "builtin"
ANCHOR_SYMBOL = "decoder_entry"
ALIAS_PREFIX = "decode_"

# Binding-log operations.
OP_BIND = "bind"
OP_REBIND = "rebind"
OP_UNBIND = "unbind"
OP_SUBSCRIBE = "subscribe"

# Event text prefixes.
TEXT_DATA_PREFIX = "[DATA]"
TEXT_ERROR_PREFIX = "[ERROR]"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp_ms", T.LongType(), True),
        T.StructField("key", T.BinaryType(), True),
        T.StructField("payload", T.BinaryType(), True),
    ]
)
ENVELOPE_COLUMNS = [f.name for f in ENVELOPE_SCHEMA.fields]

DRAIN_COLUMNS = ["tbl", "topic", "kind", "data", "err"]

BINDING_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("library", T.StringType(), True),
        T.StructField("symbol", T.StringType(), True),
    ]
)

BINDING_LOG_SCHEMA = T.StructType(
    [
        T.StructField("effective_at", T.LongType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("op", T.StringType(), False),
        T.StructField("topic", T.StringType(), False),
        T.StructField("library", T.StringType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("valid", T.BooleanType(), True),
    ]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("library", T.StringType(), False),
        T.StructField("contract_version", T.IntegerType(), True),
        T.StructField("symbol", T.StringType(), True),
    ]
)
