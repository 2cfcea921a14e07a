"""Column expressions for the decode contract (D3, D4) and event fields.

Everything here is a built-in Spark expression: it stays inside whole-stage
codegen and never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from routecast import schema as S


def empty_bytes() -> Column:
    return F.lit(b"").cast("binary")


_ANSWER_FIELDS = (("rc", "INT"), ("kind", "STRING"), ("data", "BINARY"), ("err", "STRING"))


def _sql_literal(value, sql_type: str) -> str:
    if value is None:
        return f"CAST(NULL AS {sql_type})"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({int(value)} AS {sql_type})"


def decode_result(
    kind: Column | str = S.KIND_OK,
    data: Column | bytes | None = None,
    err: Column | str = "",
    rc: Column | int = 0,
) -> Column:
    """Build a decoder answer ``struct<rc, kind, data, err>``.

    Column decoders return this. Plain Python values become literals; the
    literal part is one SQL expression and each Column value is set with
    ``withField`` (both fold into a single struct in the optimized plan).
    """
    values = {"rc": rc, "kind": kind, "data": b"" if data is None else data, "err": err}
    parts = []
    for name, sql_type in _ANSWER_FIELDS:
        v = values[name]
        lit = _sql_literal(None if isinstance(v, Column) else v, sql_type)
        parts.append(f"'{name}', {lit}")
    out = F.expr("named_struct(" + ", ".join(parts) + ")")
    for name, sql_type in _ANSWER_FIELDS:
        v = values[name]
        if isinstance(v, Column):
            out = out.withField(name, v.cast(sql_type.lower()))
    return out


def ingest_ns(timestamp_ms: Column) -> Column:
    """Message time in ns; 0 when the timestamp is unavailable (< 0).

    ``try_multiply`` keeps ANSI mode from failing on overflow; an overflowing
    value is treated like an unavailable one.
    """
    ts = timestamp_ms.cast("long")
    return F.when(ts >= 0, F.coalesce(F.try_multiply(ts, F.lit(1_000_000)), F.lit(0).cast("long"))).otherwise(
        F.lit(0).cast("long")
    )


def normalize_key(key: Column) -> Column:
    """A null key and an empty key are both empty bytes."""
    return F.coalesce(key.cast("binary"), empty_bytes())


def err_text(message: Column, max_bytes: int | None = None) -> Column:
    """The error text kept on an error event.

    The decoder's message when it is non-empty, else ``decode failed``; cut at
    the first NUL, and whole unless ``max_bytes`` is given: then at most that
    many bytes, ending before a character that would be split.
    """
    msg = F.substring_index(F.make_valid_utf8(F.coalesce(message.cast("string"), F.lit(""))), "\u0000", 1)
    chosen = F.when(msg == "", F.lit(S.MSG_DECODE_FAILED)).otherwise(msg)
    if max_bytes is None:
        return chosen
    raw = F.encode(chosen, "UTF-8")
    # a character has at most four bytes: one of these cuts falls between two
    cuts = [F.substring(raw, 1, max(0, max_bytes - back)).cast("string") for back in range(4)]
    return F.coalesce(*[F.when(F.is_valid_utf8(c), c) for c in cuts], F.lit(""))


def apply_contract(
    decoded: Column, bound: Column, max_error_bytes: int | None = None
) -> tuple[Column, Column, Column]:
    """D3: turn a decoder answer into the event's (kind, data, err).

    ``bound`` is false when the topic has no decoder at all. The first
    matching rule wins:

    * not bound                      -> error, ``decoder not bound``
    * rc != 0, or kind != OK         -> error, D4 text (SKIP and NEED_MORE
                                        included: output here has no capacity
                                        to ask more of)
    * rc == 0 and kind == OK         -> data, decoder bytes, empty err
    """
    ok = (decoded["rc"] == 0) & (decoded["kind"] == S.KIND_OK)
    ok = F.coalesce(ok, F.lit(False))
    kind = F.when(~bound, F.lit(S.EVENT_ERROR)).when(ok, F.lit(S.EVENT_DATA)).otherwise(F.lit(S.EVENT_ERROR))
    data = F.when(bound & ok, F.coalesce(decoded["data"], empty_bytes())).otherwise(empty_bytes())
    err = (
        F.when(~bound, F.lit(S.MSG_NOT_BOUND))
        .when(ok, F.lit(""))
        .otherwise(err_text(decoded["err"], max_error_bytes))
    )
    return kind, data, err
