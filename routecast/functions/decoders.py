"""Decoder registry and dispatch.

A *decoder* turns one envelope into one answer ``struct<rc, kind, data, err>``
(see :func:`routecast.functions.contract.decode_result`). It is known by its
library and symbol: two libraries may export the same symbol. Three kinds:

* **column decoders** (U1, preferred): ``fn(env) -> Column`` built from
  Spark expressions. The decoders that can occur (the bound ones, when known)
  are combined into one ``CASE`` so decoding stays a single codegen'd
  projection. A column decoder must not raise: under ANSI rules use
  ``try_cast``, ``try_divide`` and the like, and answer ERR on null.
* **batch decoders** (U2): ``fn(PyBatch) -> BatchOut``, Arrow arrays in and
  out, called once per Arrow batch with the rows bound to it.
* **Python decoders** (U2): ``fn(PyEnvelope) -> DecodeOut | tuple`` called
  per message, for decoders with no array form.

Batch and Python decoders share **one** Arrow UDF that dispatches by library
and symbol. Inputs are masked to NULL unless the row is bound to one of them,
so rows bound to column decoders cost only a null slot in the Arrow batch. An
exception raised by a decoder, or an answer of a wrong type, becomes an ERR
answer, never a failed task. The UDF counts as nondeterministic, so that no
filter above it makes Catalyst evaluate it a second time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.functions.contract import decode_result

Key = tuple[str, str]  # (library, symbol)


@dataclass(frozen=True)
class Env:
    """Envelope columns handed to a column decoder."""

    topic: Column
    partition: Column
    offset: Column
    timestamp_ms: Column
    key: Column
    payload: Column

    @staticmethod
    def of(df_cols: Callable[[str], Column] = F.col) -> "Env":
        return Env(*[df_cols(c) for c in S.ENVELOPE_COLUMNS])


@dataclass
class PyEnvelope:
    """Envelope values handed to a Python decoder (one message)."""

    topic: str | None
    partition: int | None
    offset: int | None
    timestamp_ms: int | None
    key: bytes | None
    payload: bytes | None


@dataclass
class DecodeOut:
    """A Python decoder's answer."""

    rc: int = 0
    kind: str = S.KIND_OK
    data: bytes = b""
    err: str = ""


@dataclass
class PyBatch:
    """Envelope arrays handed to a batch decoder (the rows bound to it)."""

    topic: pa.Array
    partition: pa.Array
    offset: pa.Array
    timestamp_ms: pa.Array
    key: pa.Array
    payload: pa.Array


@dataclass
class BatchOut:
    """A batch decoder's answer: ``data`` (binary or text) of every row, and
    ``err``: a row with a non-null text there is an ERR row."""

    data: pa.Array
    err: pa.Array | None = None


@dataclass(frozen=True)
class Decoder:
    library: str
    symbol: str
    form: str  # column, python or batch
    fn: Callable[..., Any]


# ---------------------------------------------------------------------------
# Built-in decoders
# ---------------------------------------------------------------------------


def passthrough(env: Env) -> Column:
    """output = payload, OK, empty message."""
    return decode_result(kind=S.KIND_OK, data=F.coalesce(env.payload, F.lit(b"").cast("binary")))


class DecoderRegistry:
    """(library, symbol) -> decoder, and the catalog of J4."""

    def __init__(self, builtins: bool = True):
        self._decoders: dict[Key, Decoder] = {}
        self._libraries: dict[str, int | None] = {}
        self._answer_cache: dict[tuple, Column] = {}
        if builtins:
            self.register_column(S.PASSTHROUGH_SYMBOL, passthrough)
            self.register_column(S.DEFAULT_SYMBOL, passthrough)

    # -- registration ------------------------------------------------------

    def register_library(self, library: str, contract_version: int | None = S.CONTRACT_VERSION) -> None:
        """Declare a library (with its contract version, None = no version
        symbol) even before it holds decoders."""
        self._libraries[library] = contract_version

    def _register(self, form: str, symbol: str, fn: Callable[..., Any], library: str) -> "DecoderRegistry":
        if not symbol:
            raise ValueError("decoder symbol must be a non-empty string")
        self._answer_cache.clear()
        self._decoders[library, symbol] = Decoder(library, symbol, form, fn)
        self._libraries.setdefault(library, S.CONTRACT_VERSION)
        return self

    def register_column(
        self, symbol: str, fn: Callable[[Env], Column], library: str = S.BUILTIN_LIBRARY
    ) -> "DecoderRegistry":
        return self._register("column", symbol, fn, library)

    def register_python(
        self, symbol: str, fn: Callable[[PyEnvelope], Any], library: str = S.BUILTIN_LIBRARY
    ) -> "DecoderRegistry":
        return self._register("python", symbol, fn, library)

    def register_batch(
        self, symbol: str, fn: Callable[[PyBatch], BatchOut], library: str = S.BUILTIN_LIBRARY
    ) -> "DecoderRegistry":
        return self._register("batch", symbol, fn, library)

    def column(self, symbol: str, library: str = S.BUILTIN_LIBRARY):
        """Decorator form of :meth:`register_column`."""
        return lambda fn: self.register_column(symbol, fn, library) and fn

    def python(self, symbol: str, library: str = S.BUILTIN_LIBRARY):
        """Decorator form of :meth:`register_python`."""
        return lambda fn: self.register_python(symbol, fn, library) and fn

    def batch(self, symbol: str, library: str = S.BUILTIN_LIBRARY):
        """Decorator form of :meth:`register_batch`."""
        return lambda fn: self.register_batch(symbol, fn, library) and fn

    # -- introspection -----------------------------------------------------

    def form_of(self, library: str, symbol: str) -> str | None:
        d = self._decoders.get((library, symbol))
        return d.form if d else None

    def catalog_rows(self) -> list[tuple[str, int | None, str | None]]:
        rows: list[tuple[str, int | None, str | None]] = [
            (d.library, self._libraries.get(d.library), d.symbol) for d in self._decoders.values()
        ]
        held = {d.library for d in self._decoders.values()}
        return rows + [(lib, ver, None) for lib, ver in self._libraries.items() if lib not in held]

    def catalog(self, spark: SparkSession) -> DataFrame:
        """The registry as a ``(library, contract_version, symbol)`` table."""
        from routecast.sources.local import local_table

        return local_table(spark, self.catalog_rows(), S.CATALOG_SCHEMA)

    # -- dispatch ----------------------------------------------------------

    def answer(self, bound: frozenset[Key] | None = None) -> Column:
        """``dispatch`` over the standard envelope columns, ``decoder`` and
        ``decoder_library``, built once per (registry state, bound set) and
        reused: micro-batches rebuild their plan each trigger, the expression
        need not be."""
        active = SparkSession.getActiveSession()
        key = (id(active.sparkContext) if active is not None else None, bound)
        col = self._answer_cache.get(key)
        if col is None:
            col = self.dispatch(F.col("decoder_library"), F.col("decoder"), Env.of(F.col), bound)
            self._answer_cache[key] = col
        return col

    def dispatch(self, library: Column, symbol: Column, env: Env, bound: frozenset[Key] | None = None) -> Column:
        """The decoder answer for each row, chosen by ``library`` (null:
        the built-in one) and ``symbol``.

        ``symbol`` NULL (unbound) yields NULL; the contract handles it. A
        decoder bound but not registered yields an ERR answer naming its
        symbol. ``bound``, when known, is every (library, symbol) the rows can
        carry: decoders outside it are left out of the expression, and with no
        Python decoder among them the plan holds no Python UDF at all.
        """
        library = F.coalesce(library, F.lit(S.BUILTIN_LIBRARY))
        wanted = [d for k, d in self._decoders.items() if bound is None or k in bound]

        def among(decoders: list[Decoder]) -> Column:
            of: dict[str, list[str]] = {}
            for d in decoders:
                of.setdefault(d.library, []).append(d.symbol)
            cond = F.lit(False)
            for lib, symbols in of.items():
                cond = cond | ((library == lib) & symbol.isin(symbols))
            return cond

        branches: list[tuple[Column, Column]] = []
        in_python = {(d.library, d.symbol): d for d in wanted if d.form != "column"}
        if in_python:
            own = among(list(in_python.values()))
            args = [library, symbol, *[getattr(env, c) for c in S.ENVELOPE_COLUMNS]]
            branches.append((own, _python_dispatch_udf(in_python)(*[F.when(own, c) for c in args])))
        # One branch per distinct decoder function: symbols that share a
        # function (aliases, the default and passthrough) share the branch.
        groups: dict[int, list[Decoder]] = {}
        for d in wanted:
            if d.form == "column":
                groups.setdefault(id(d.fn), []).append(d)
        branches += [(among(ds), ds[0].fn(env)) for ds in groups.values()]
        missing = decode_result(rc=-2, kind=S.KIND_ERR, err=F.concat(F.lit(S.MSG_SYMBOL_NOT_FOUND), symbol))
        branches.append((symbol.isNotNull(), missing))
        expr = F
        for cond, value in branches:
            expr = expr.when(cond, value)
        return expr


# ---------------------------------------------------------------------------
# Python and batch decoders (inside the executor's Python worker)
# ---------------------------------------------------------------------------

_ANSWER_DDL = "rc int, kind string, data binary, err string"


def _text(value: Any) -> str:
    """``value`` as text that UTF-8 can carry."""
    return "" if value is None else str(value).encode("utf-8", "replace").decode("utf-8")


def _failed(exc: BaseException) -> tuple[int, str, bytes, str]:
    return -1, S.KIND_ERR, b"", _text(f"{type(exc).__name__}: {exc}")


def call_python_decoder(fn: Callable[[PyEnvelope], Any], env: PyEnvelope) -> tuple[int, str, bytes, str]:
    """(rc, kind, data, err) of one message. A decoder that raises, or whose
    answer has a wrong type or range, gives ERR."""
    try:
        out = fn(env)
        if isinstance(out, tuple):
            out = DecodeOut(*out)
        if not isinstance(out, DecodeOut):
            raise TypeError(f"decoder returned {type(out).__name__}, expected DecodeOut or tuple")
        if isinstance(out.rc, bool) or not isinstance(out.rc, int) or not -(1 << 31) <= out.rc < 1 << 31:
            raise TypeError(f"rc must be a 32-bit integer, not {out.rc!r}")
        data = b"" if out.data is None else out.data
        data = bytes(data) if isinstance(data, (bytes, bytearray, memoryview)) else _text(data).encode("utf-8")
        return out.rc, _text(out.kind), data, _text(out.err)
    except Exception as exc:  # a decoder failure is an ERR row, not a task failure
        return _failed(exc)


def call_batch_decoder(fn: Callable[[PyBatch], BatchOut], batch: PyBatch) -> list[tuple[int, str, bytes, str]]:
    n = len(batch.topic)
    try:
        out = fn(batch)
        data = out.data.cast(pa.large_binary()).to_pylist()
        err = [None] * n if out.err is None else out.err.cast(pa.large_string()).to_pylist()
        if len(data) != n or len(err) != n:
            raise ValueError(f"decoder returned {len(data)} answers for {n} messages")
    except Exception as exc:
        return [_failed(exc)] * n
    return [(0, S.KIND_OK, d or b"", "") if e is None else (0, S.KIND_ERR, b"", e) for d, e in zip(data, err)]


def _python_dispatch_udf(decoders: dict[Key, Decoder]):
    calls = {k: (d.form, d.fn) for k, d in decoders.items()}

    def run(library: pa.Array, symbol: pa.Array, *envelope: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        n = len(symbol)
        answers: list[tuple | None] = [None] * n
        names = list(zip(library.to_pylist(), symbol.to_pylist()))
        for key, (form, fn) in calls.items():
            idx = [i for i, x in enumerate(names) if x == key]
            if not idx:
                continue
            own = [pc.take(a, pa.array(idx)) for a in envelope]
            if form == "batch":
                found = call_batch_decoder(fn, PyBatch(*own))
            else:
                found = [call_python_decoder(fn, PyEnvelope(*row)) for row in zip(*[a.to_pylist() for a in own])]
            for i, x in zip(idx, found):
                answers[i] = x
        fields = list(zip(*[x or (None,) * 4 for x in answers])) or [()] * 4
        types = [pa.int32(), pa.large_string(), pa.large_binary(), pa.large_string()]
        return pa.StructArray.from_arrays(
            [pa.array(v, t) for v, t in zip(fields, types)],
            names=["rc", "kind", "data", "err"],
            mask=pa.array([x is None for x in answers], pa.bool_()),
        )

    return F.arrow_udf(run, _ANSWER_DDL).asNondeterministic()
