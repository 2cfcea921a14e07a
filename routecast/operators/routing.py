"""Route, decode and drain (J1, J3, D3, P3, F1, T1 core).

``decode`` is the heart of the engine:

    envelopes --(broadcast left join on topic: J1)--> + decoder symbol
              --(one CASE over the bound decoders)---> decoder answer
              --(contract: D3/D4)--------------------> event rows

It is one map-only stage over the messages: the only exchange is the
broadcast of the (small, size-checked) binding table, so payloads are never
shuffled and a hot topic costs nothing extra. Every input row gives exactly
one output row (unless ``skip_policy="drop"``), so the same function works on
a batch DataFrame and on a streaming one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.functions.contract import apply_contract, ingest_ns, normalize_key
from routecast.functions.decoders import DecoderRegistry
from routecast.operators.broadcast import MAX_BROADCAST_ROWS, bounded_broadcast
from routecast.sources.local import local_table


def binding_table(bindings: DataFrame, topics: Iterable[str] | None = None) -> DataFrame:
    """One ``(topic, library, symbol)`` row per topic.

    Subscription: every topic in ``topics`` without a binding gets the default
    decoder; a bound topic keeps its binding. Binding tables are exact-match
    maps; should one carry duplicates, the smallest ``(symbol, library)`` is
    kept, deterministically, so a left join can never multiply messages.
    Both rules are one aggregation over the (small) binding rows.
    """
    rows = bindings.select("topic", "library", "symbol", F.lit(0).alias("_prio"))
    topics = list(dict.fromkeys(topics or []))
    if topics:
        spark = bindings.sparkSession
        subscribed = local_table(spark, [(t,) for t in topics], "topic string").select(
            "topic",
            F.lit(S.BUILTIN_LIBRARY).alias("library"),
            F.lit(S.DEFAULT_SYMBOL).alias("symbol"),
            F.lit(1).alias("_prio"),
        )
        rows = rows.unionByName(subscribed)
    return (
        rows.groupBy("topic")
        .agg(F.min(F.struct("_prio", "symbol", "library")).alias("_b"))
        .select("topic", F.col("_b.library").alias("library"), F.col("_b.symbol").alias("symbol"))
    )


def unique_bindings(bindings: DataFrame) -> DataFrame:
    """One binding per topic (see :func:`binding_table`)."""
    return binding_table(bindings, None)


# Partitions that a topic's messages are spread over when the binding table is
# too large to broadcast.
SALTS = 16


def _join_on_topic(big: DataFrame, small: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Left join with a table of distinct topics, and whether it was small
    enough to broadcast. If not, a topic's messages are spread over ``SALTS``
    keys by a hash of their columns, each with a copy of the topic's row."""
    side, within = bounded_broadcast(small, max_rows)
    if within or big.isStreaming:
        return big.join(side, "topic", "left"), within
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)).cast("int"))
    return spread.join(copies, ["topic", "_salt"], "left").drop("_salt"), False


# Up to this many distinct symbols are read back to the driver to trim the
# decoder expression; a larger binding table keeps every decoder.
MAX_SYMBOLS_TO_READ = 10_000


def bound_decoders(
    table: DataFrame, library: str = "library", symbol: str = "symbol"
) -> frozenset[tuple[str, str]] | None:
    """The distinct (library, symbol) of a small control table, or None when
    there are too many to read back (then no decoder is left out)."""
    lib = F.coalesce(F.col(library), F.lit(S.BUILTIN_LIBRARY))
    named = table.select(lib, F.col(symbol)).where(F.col(symbol).isNotNull()).distinct()
    rows = named.limit(MAX_SYMBOLS_TO_READ + 1).collect()
    if len(rows) > MAX_SYMBOLS_TO_READ:
        return None
    return frozenset((r[0], r[1]) for r in rows)


def route(
    envelopes: DataFrame,
    bindings: DataFrame,
    topics: Iterable[str] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``decoder_library`` and ``decoder`` (the bound library and
    symbol, NULL when unbound) to each envelope.

    Exact-match lookup by topic through a broadcast left join; unbound
    messages are kept (they become ``decoder not bound`` errors), never
    dropped.
    """
    routed, _ = _route(envelopes, bindings, topics, max_broadcast_rows, read_bound=False)
    return routed


def _route(
    envelopes: DataFrame,
    bindings: DataFrame,
    topics: Iterable[str] | None,
    max_broadcast_rows: int,
    read_bound: bool,
) -> tuple[DataFrame, frozenset[tuple[str, str]] | None]:
    table = binding_table(bindings, topics).select(
        "topic", F.col("library").alias("decoder_library"), F.col("symbol").alias("decoder")
    )
    routed, small = _join_on_topic(envelopes, table, max_broadcast_rows)
    bound = bound_decoders(table, "decoder_library", "decoder") if small and read_bound else None
    return routed, bound


def require_envelope(df: DataFrame, extra: Iterable[str] = ()) -> None:
    """Fail early, naming them, when envelope columns are missing."""
    missing = [c for c in list(S.ENVELOPE_COLUMNS) + list(extra) if c not in df.columns]
    if missing:
        raise ValueError(f"not an envelope DataFrame; missing columns: {', '.join(missing)}")


def decode_routed(
    routed: DataFrame,
    registry: DecoderRegistry,
    skip_policy: str = "error",
    bound: frozenset[tuple[str, str]] | None = None,
    max_error_bytes: int | None = None,
) -> DataFrame:
    """D3 on envelopes that already carry ``decoder_library`` and ``decoder``
    (J1 or J2). ``bound``: every (library, symbol) they can hold, when known.
    Error texts are whole unless ``max_error_bytes`` is given."""
    if skip_policy not in ("error", "drop"):
        raise ValueError("skip_policy must be 'error' or 'drop'")
    require_envelope(routed, ["decoder_library", "decoder"])
    symbol = F.col("decoder")
    answer = registry.answer(bound)
    staged = routed.withColumn("_ans", answer)
    if skip_policy == "drop":
        staged = staged.filter(F.coalesce(F.col("_ans.kind") != S.KIND_SKIP, F.lit(True)))
    kind, data, err = apply_contract(F.col("_ans"), symbol.isNotNull(), max_error_bytes)
    return staged.select(
        "topic",
        "partition",
        "offset",
        "timestamp_ms",
        normalize_key(F.col("key")).alias("key"),
        ingest_ns(F.col("timestamp_ms")).alias("ingest_ns"),
        symbol.alias("decoder"),
        kind.alias("kind"),
        data.alias("data"),
        err.alias("err"),
    )


def decode(
    envelopes: DataFrame,
    bindings: DataFrame,
    registry: DecoderRegistry,
    topics: Iterable[str] | None = None,
    skip_policy: str = "error",
    max_error_bytes: int | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """T1 core: envelopes -> events (one row per message).

    ``topics`` is the subscription list: those topics fall back to the
    default decoder when unbound. Topics outside it stay unbound.
    ``skip_policy="error"`` (faithful) turns SKIP into an error row;
    ``"drop"`` removes those rows instead.
    """
    # Reading the bound decoders of the (small) binding table costs one small
    # job and keeps the plan to the decoders that can occur: no Python UDF
    # for an unbound Python decoder, and a short CASE whose generated method
    # stays small enough for the JIT to compile.
    require_envelope(envelopes)
    routed, bound = _route(envelopes, bindings, topics, max_broadcast_rows, read_bound=True)
    return decode_routed(routed, registry, skip_policy, bound, max_error_bytes)


def to_drain(
    events: DataFrame,
    label_bindings: DataFrame | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """P3 + J3: events -> ``(tbl, topic, kind, data, err)``.

    ``tbl`` is the symbol of the binding current *at drain* for the topic,
    else the topic itself. By default that is the binding the event was
    decoded with; pass ``label_bindings`` (the table as it stands at drain)
    to reproduce a rebind/unbind between decode and drain. Columns of
    ``events`` named in ``keep`` follow.
    """
    if label_bindings is None:
        tbl = F.coalesce(F.col("decoder"), F.col("topic"), F.lit(""))
        return events.select(tbl.alias("tbl"), "topic", "kind", "data", "err", *keep)
    labels = unique_bindings(label_bindings).select("topic", F.col("symbol").alias("_label"))
    joined, _ = _join_on_topic(events, labels, max_broadcast_rows)
    return joined.select(
        F.coalesce(F.col("_label"), F.col("topic"), F.lit("")).alias("tbl"), "topic", "kind", "data", "err", *keep
    )


def is_data(kind: Column | None = None) -> Column:
    return (kind if kind is not None else F.col("kind")) == S.EVENT_DATA


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(data rows, error rows)``. Both are lazy filters over the same
    plan; a sink that consumes both should persist the input once."""
    return events.filter(is_data()), events.filter(~is_data())
