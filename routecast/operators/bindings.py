"""Binding control: current table, as-of routing, checks, binding file
(A4, J2, J4, D5).

A *binding log* records control operations in order ``(effective_at,
seq)``: ``bind``/``rebind`` (upsert; rebind needs no earlier bind),
``unbind`` (idempotent), ``subscribe`` (installs the default decoder only if
nothing is bound at that moment). Rejected binds (``valid = false``) change
nothing. The state after any prefix of the log is therefore:

    L = last valid bind/rebind/unbind so far, S = last subscribe so far
    L is bind/rebind          -> L's (library, symbol)
    S exists and S after L    -> default decoder (also when there is no L)
    otherwise                 -> unbound

which is an aggregation (A4) or a running window over the log (J2), never a
sequential loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routecast import schema as S
from routecast.operators.broadcast import MAX_BROADCAST_ROWS, bounded_broadcast, within_bound
from routecast.operators.stats import floor_div


def _order() -> Column:
    return F.struct(F.col("effective_at").cast("long").alias("t"), F.col("seq").cast("long").alias("s"))


def _is_change() -> Column:
    """A valid bind/rebind/unbind (subscribe and rejected binds excluded)."""
    return F.col("op").isin(S.OP_BIND, S.OP_REBIND, S.OP_UNBIND) & F.coalesce(F.col("valid"), F.lit(True))


def _state(last_change: Column, last_subscribe: Column) -> tuple[Column, Column]:
    """(library, symbol) from the last change and the last subscribe."""
    bound = last_change["op"].isin(S.OP_BIND, S.OP_REBIND)
    by_subscribe = last_subscribe.isNotNull() & (last_change.isNull() | (last_subscribe > last_change["ord"]))
    library = F.when(bound, last_change["library"]).when(by_subscribe, F.lit(S.BUILTIN_LIBRARY))
    symbol = F.when(bound, last_change["symbol"]).when(by_subscribe, F.lit(S.DEFAULT_SYMBOL))
    return library, symbol


# ---------------------------------------------------------------------------
# A4: current bindings
# ---------------------------------------------------------------------------


_SEQ_RANGE = "10000000000000000000"  # above every seq


def order_key(at: Column, seq: Column) -> Column:
    """``(at, seq)`` as one number of fixed width, so that its maximum is a
    hash aggregation. ``seq`` must not be negative."""
    return at.cast("decimal(19,0)") * F.lit(_SEQ_RANGE).cast("decimal(20,0)") + seq.cast("decimal(19,0)")


def split_order_key(key: Column) -> tuple[Column, Column]:
    """``at`` and ``seq`` of an :func:`order_key` with ``at`` >= 0."""
    size = F.lit(_SEQ_RANGE).cast("decimal(20,0)")
    seq = key % size
    return ((key - seq) / size).cast("long"), seq.cast("long")


def current_bindings(log: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A4: the binding table after the whole log, ``(topic, library, symbol)``.

    One hash aggregation finds the last change and the last subscribe of each
    topic (combined map-side, so a topic holding a third of the log costs no
    more than any other); the changes found are then picked from the log.
    """
    key = order_key(F.col("effective_at"), F.col("seq"))
    last = log.groupBy("topic").agg(
        F.max(F.when(_is_change(), key)).alias("_c"), F.max(F.when(F.col("op") == S.OP_SUBSCRIBE, key)).alias("_s")
    )
    side, _ = bounded_broadcast(last.select(F.col("topic").alias("_t"), F.col("_c").alias("_k")), max_broadcast_rows)
    changes = log.where(_is_change()).withColumn("_key", key)
    found = changes.join(side, F.col("topic").eqNullSafe(F.col("_t")) & (F.col("_key") == F.col("_k")))
    # operations with the same time and seq: the largest decides
    found = found.groupBy(F.col("topic").alias("_t")).agg(F.max(F.struct("op", "library", "symbol")).alias("_l"))
    return bindings_of(last.join(found, F.col("topic").eqNullSafe(F.col("_t")), "left"))


def bindings_of(state: DataFrame) -> DataFrame:
    """The binding table of a state: per topic the last change's key ``_c`` and
    operation ``_l``, and the last subscribe's key ``_s``."""
    bound = F.col("_l.op").isin(S.OP_BIND, S.OP_REBIND)
    by_subscribe = F.col("_s").isNotNull() & (F.col("_c").isNull() | (F.col("_s") > F.col("_c")))
    library = F.when(bound, F.col("_l.library")).when(by_subscribe, F.lit(S.BUILTIN_LIBRARY))
    symbol = F.when(bound, F.col("_l.symbol")).when(by_subscribe, F.lit(S.DEFAULT_SYMBOL))
    return state.select("topic", library.alias("library"), symbol.alias("symbol")).filter(F.col("symbol").isNotNull())


def _last_of(rows: DataFrame, change: Column, subscribe: Column) -> DataFrame:
    last = rows.groupBy("topic").agg(F.max(change).alias("_m"), F.max(subscribe).alias("_s"))
    operation = F.when(F.col("_m").isNotNull(), F.struct("_m.op", "_m.library", "_m.symbol"))
    return last.select("topic", F.col("_m._c").alias("_c"), operation.alias("_l"), "_s")


def binding_state(log: DataFrame) -> DataFrame:
    """A4 that can be continued: what :func:`bindings_of` needs of a part of
    the log, one row per topic, in one aggregation (combined map-side)."""
    key = order_key(F.col("effective_at"), F.col("seq"))
    change = F.when(_is_change(), F.struct(key.alias("_c"), "op", "library", "symbol"))
    return _last_of(log, change, F.when(F.col("op") == S.OP_SUBSCRIBE, key))


def merge_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """The state of two parts of a log together."""
    change = F.when(F.col("_c").isNotNull(), F.struct("_c", "_l.op", "_l.library", "_l.symbol"))
    return _last_of(a.unionByName(b), change, F.col("_s"))


# ---------------------------------------------------------------------------
# Route as of the binding log
# ---------------------------------------------------------------------------


# Width (in effective_at units, ms by default) of the time blocks the log is
# cut into when building intervals: the windows run per (topic, block), so a
# topic with a long log is spread over many tasks.
LOG_BLOCK = 3_600_000


def binding_intervals(
    log: DataFrame,
    block_width: int = LOG_BLOCK,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """The log as non-overlapping ``[valid_from, valid_to)`` intervals per
    topic, ``(topic, valid_from, valid_to, library, symbol)``; ``valid_to``
    NULL = open; ``symbol`` NULL = unbound during the interval.

    Several operations at the same ``effective_at`` collapse: the last
    ``seq`` decides. Two levels, never a window over messages nor one over a
    whole topic's log: a summary per ``(topic, block)`` (last change, last
    subscribe, first time) is carried across blocks by a window over that
    small table, then windows inside each ``(topic, block)`` finish the rows.
    ``two_level=None`` picks that plan only when the log's size estimate is
    not small; a small log takes one window per topic (fewer stages).
    """
    change = F.when(_is_change(), F.struct(_order().alias("ord"), "op", "library", "symbol"))
    subscribe = F.when(F.col("op") == S.OP_SUBSCRIBE, _order())
    keyed = floor_div(log, F.col("effective_at"), block_width, "_blk")

    summary = keyed.groupBy("topic", "_blk").agg(
        F.max_by(change, F.when(_is_change(), _order())).alias("_blk_c"),
        F.max(subscribe).alias("_blk_s"),
        F.min(F.col("effective_at").cast("long")).alias("_blk_first"),
    )
    by_block = Window.partitionBy("topic").orderBy("_blk")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        F.col("topic").alias("_carry_topic"),
        F.col("_blk").alias("_carry_blk"),
        F.last("_blk_c", ignorenulls=True).over(earlier).alias("_in_c"),
        F.last("_blk_s", ignorenulls=True).over(earlier).alias("_in_s"),
        F.lead("_blk_first").over(by_block).alias("_next_first"),
    )
    side, _ = bounded_broadcast(carry, max_broadcast_rows)
    joined = keyed.join(
        side, (F.col("topic") == F.col("_carry_topic")) & (F.col("_blk") == F.col("_carry_blk")), "left"
    )
    in_block = Window.partitionBy("topic", "_blk").orderBy(F.col("effective_at"), F.col("seq"))
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = joined.select(
        "topic",
        F.col("effective_at").cast("long").alias("valid_from"),
        F.coalesce(F.lead(F.col("effective_at").cast("long")).over(in_block), F.col("_next_first")).alias(
            "valid_to"
        ),
        F.coalesce(F.last(change, ignorenulls=True).over(upto), F.col("_in_c")).alias("_c"),
        F.coalesce(F.last(subscribe, ignorenulls=True).over(upto), F.col("_in_s")).alias("_s"),
    )
    return _intervals(staged)


def _intervals(staged: DataFrame) -> DataFrame:
    library, symbol = _state(F.col("_c"), F.col("_s"))
    return staged.select(
        "topic", "valid_from", "valid_to", library.alias("library"), symbol.alias("symbol")
    ).filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))


DEFAULT_BUCKET = 86_400_000  # width of the time buckets of the large-log path
FAN = 64  # intervals, or nodes, below one node of the search tree


def route_as_of(
    envelopes: DataFrame,
    log: DataFrame,
    at: Column | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    bucket_width: int = DEFAULT_BUCKET,
    log_block: int = LOG_BLOCK,
) -> DataFrame:
    """Add ``decoder_library`` and ``decoder``; see :func:`_route_as_of`."""
    return _route_as_of(envelopes, log, at, max_broadcast_rows, bucket_width, log_block)[0]


def decode_as_of(
    envelopes: DataFrame,
    log: DataFrame,
    registry,
    at: Column | None = None,
    skip_policy: str = "error",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    bucket_width: int = DEFAULT_BUCKET,
    log_block: int = LOG_BLOCK,
) -> DataFrame:
    """J2 + D3: decode every message with the decoder bound to its topic at
    its time. When the interval table is small enough to broadcast, its
    decoders are read back so only those are planned (as ``decode`` does for
    a fixed binding table)."""
    from routecast.operators.routing import bound_decoders, decode_routed

    routed, intervals = _route_as_of(envelopes, log, at, max_broadcast_rows, bucket_width, log_block)
    bound = bound_decoders(intervals) if intervals is not None else None
    return decode_routed(routed, registry, skip_policy, bound)


def _search_tree(iv: DataFrame) -> list[DataFrame]:
    """Tables ``(_topic, _node, _below)`` from the root to the leaves: a leaf
    holds up to ``FAN`` consecutive intervals of a topic, a node above the
    first times of up to ``FAN`` nodes."""
    rank = F.row_number().over(Window.partitionBy("topic").orderBy("valid_from")) - 1
    ranked = iv.withColumn("_rank", rank).select(
        F.col("topic").alias("_topic"),
        F.expr(f"_rank div {FAN}").alias("_node"),
        F.struct("valid_from", "valid_to", "library", "symbol").alias("_entry"),
    )
    leaves = ranked.groupBy("_topic", "_node").agg(F.sort_array(F.collect_list("_entry")).alias("_below"))
    levels, starts = [leaves], leaves.select("_topic", "_node", F.col("_below")[0]["valid_from"].alias("_start"))
    last = leaves.agg(F.max("_node")).first()[0] or 0
    while last > 0:
        above = starts.select("_topic", F.expr(f"_node div {FAN}").alias("_node"), "_start")
        level = above.groupBy("_topic", "_node").agg(F.sort_array(F.collect_list("_start")).alias("_below"))
        levels.insert(0, level)
        starts = level.select("_topic", "_node", F.col("_below")[0].alias("_start"))
        last //= FAN
    return levels


def _search(staged: DataFrame, iv: DataFrame) -> DataFrame:
    """The interval of each message by descending the tree: one exact lookup
    and at most ``FAN`` comparisons a level, a number of levels that grows
    with the logarithm of the intervals of the largest topic."""
    levels = _search_tree(iv)
    found = staged.withColumn("_at_node", F.lit(0).cast("long"))
    for i, level in enumerate(levels):
        on = F.col("topic").eqNullSafe(F.col("_topic")) & (F.col("_at_node") == F.col("_node"))
        found = found.join(F.broadcast(level), on, "left")
        leaf = i == len(levels) - 1
        begin = (lambda x: x["valid_from"]) if leaf else (lambda x: x)
        last = F.size(F.filter("_below", lambda x: begin(x) <= F.col("_at"))) - 1
        if leaf:
            found = found.withColumn("_entry", F.when(last >= 0, F.get("_below", F.greatest(last, F.lit(0)))))
        else:
            found = found.withColumn("_at_node", F.when(last >= 0, F.col("_at_node") * FAN + last))
        found = found.drop("_topic", "_node", "_below")
    open_ = F.col("_entry.valid_to").isNull() | (F.col("_at") < F.col("_entry.valid_to"))
    return found.withColumns(
        {
            "decoder_library": F.when(open_, F.col("_entry.library")),
            "decoder": F.when(open_, F.col("_entry.symbol")),
        }
    ).drop("_at", "_at_node", "_entry")


def _route_as_of(
    envelopes: DataFrame,
    log: DataFrame,
    at: Column | None,
    max_broadcast_rows: int,
    bucket_width: int,
    log_block: int,
) -> tuple[DataFrame, DataFrame | None]:
    """Add the library and symbol bound to the message's topic at time
    ``at`` (default ``timestamp_ms``; ``offset`` also works), by the log.

    A change at ``t`` applies to messages with ``at >= t``. Messages before
    the topic's first log entry are unbound; a message without a time
    (``timestamp_ms`` -1) gets the latest binding. Exactly one output row per
    message.

    Plan: intervals (few) are broadcast as a search tree. When the interval
    table is over the broadcast bound, closed intervals are cut into
    ``bucket_width`` time buckets and joined on ``(topic, bucket)`` plus the
    range, a shuffle join whose hot keys AQE can split; messages without a
    time take no part in that and look up the open interval only.
    """
    timeless = F.lit(9223372036854775807)
    if at is None:
        # A message without a time (-1) is decoded with the latest binding,
        # as a live decoder would do it now.
        ts = F.col("timestamp_ms").cast("long")
        at = F.when(ts >= 0, ts).otherwise(timeless)
    iv, small = within_bound(binding_intervals(log, log_block, max_broadcast_rows), max_broadcast_rows)
    staged = envelopes.withColumn("_at", at.cast("long"))
    if small:
        return _search(staged, iv), iv
    iv = iv.select(
        F.col("topic").alias("_iv_topic"),
        "valid_from",
        "valid_to",
        F.col("library").alias("_iv_library"),
        F.col("symbol").alias("_iv_symbol"),
    )
    # Closed intervals: cut into time buckets, equi-join on (topic, bucket) +
    # range. Open intervals (at most one per topic): joined on topic alone.
    # No pass over the messages is needed to find their time range.
    closed = iv.filter(F.col("valid_to").isNotNull())
    bucketed = floor_div(closed, F.col("valid_from"), bucket_width, "_b_lo")
    bucketed = floor_div(bucketed, F.col("valid_to") - 1, bucket_width, "_b_hi")
    exploded = bucketed.withColumn("_iv_b", F.explode(F.sequence("_b_lo", "_b_hi"))).drop("_b_lo", "_b_hi")
    keyed = floor_div(staged.filter(F.col("_at") < timeless), F.col("_at"), bucket_width, "_b")
    in_range = (F.col("_at") >= F.col("valid_from")) & (F.col("_at") < F.col("valid_to"))
    first = keyed.join(
        exploded.withColumn("_hit", F.lit(True)),
        (F.col("topic") == F.col("_iv_topic")) & (F.col("_b") == F.col("_iv_b")) & in_range,
        "left",
    ).drop("_b", "_iv_b", "_iv_topic", "valid_from", "valid_to")
    first = first.unionByName(staged.filter(F.coalesce(F.col("_at") >= timeless, F.lit(True))), allowMissingColumns=True)
    open_iv = iv.filter(F.col("valid_to").isNull()).select(
        F.col("_iv_topic").alias("_op_topic"),
        F.col("valid_from").alias("_op_from"),
        F.col("_iv_library").alias("_op_library"),
        F.col("_iv_symbol").alias("_op_symbol"),
    )
    open_side, _ = bounded_broadcast(open_iv, max_broadcast_rows)
    joined = first.join(open_side, (F.col("topic") == F.col("_op_topic")) & (F.col("_at") >= F.col("_op_from")), "left")
    routed = joined.withColumns(
        {
            "decoder_library": F.when(F.col("_hit"), F.col("_iv_library")).otherwise(F.col("_op_library")),
            "decoder": F.when(F.col("_hit"), F.col("_iv_symbol")).otherwise(F.col("_op_symbol")),
        }
    )
    gone = ["_at", "_hit", "_iv_library", "_iv_symbol", "_op_topic", "_op_from", "_op_library", "_op_symbol"]
    return routed.drop(*gone), None


# ---------------------------------------------------------------------------
# Check bind requests against a catalog
# ---------------------------------------------------------------------------


def check_bindings(
    requests: DataFrame,
    catalog: DataFrame,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``ok`` and ``err`` to ``(topic, library, symbol)`` requests.

    Checks in order: library present; its contract version declared;
    version equal to the one accepted; symbol exported. A rejected request
    must not replace an earlier binding: feed ``ok`` as ``valid`` into the log.
    """
    libs = catalog.groupBy("library").agg(F.max("contract_version").alias("_ver")).withColumn(
        "_lib_ok", F.lit(True)
    )
    syms = (
        catalog.filter(F.col("symbol").isNotNull())
        .select("library", "symbol")
        .distinct()
        .withColumn("_sym_ok", F.lit(True))
    )
    libs_side, _ = bounded_broadcast(libs, max_broadcast_rows)
    syms_side, _ = bounded_broadcast(syms, max_broadcast_rows)
    joined = requests.join(libs_side, "library", "left").join(syms_side, ["library", "symbol"], "left")
    err = (
        F.when(
            F.col("_lib_ok").isNull(),
            F.concat(F.coalesce(F.col("library"), F.lit("")), F.lit(S.MSG_LIBRARY_MISSING_SUFFIX)),
        )
        .when(F.col("_ver").isNull(), F.lit(S.MSG_VERSION_SYMBOL_MISSING))
        .when(F.col("_ver") != S.CONTRACT_VERSION, F.lit(S.MSG_VERSION_MISMATCH))
        .when(
            F.col("_sym_ok").isNull(),
            F.concat(F.lit(S.MSG_SYMBOL_NOT_FOUND), F.coalesce(F.col("symbol"), F.lit(""))),
        )
        .otherwise(F.lit(""))
    )
    cols = [c for c in requests.columns]
    return joined.select(*cols, (err == "").alias("ok"), err.alias("err"))


# ---------------------------------------------------------------------------
# Binding file
# ---------------------------------------------------------------------------


def bindings_from_text(
    lines: DataFrame,
    library: str,
    catalog: DataFrame,
    text_column: str = "value",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Lines ``<topic> <symbol_or_alias>`` -> ``(topic, library, symbol,
    ok, err)``, one row per binding line.

    Resolution against the library's exported symbols: the name itself if
    exported; else the alias tried as ``decode_<alias>``; ``-`` means the
    library's anchor symbol. Blank lines and ``#`` comments are skipped.
    """
    text = F.trim(F.col(text_column))
    parts = F.split(F.col("_line"), r"\s+")
    parsed = (
        lines.select(text.alias("_line"))
        .filter((F.col("_line") != "") & ~F.col("_line").startswith("#"))
        .select(
            parts.getItem(0).alias("topic"),
            F.when(F.size(parts) == 2, parts.getItem(1)).alias("_target"),
            (F.size(parts) == 2).alias("_well_formed"),
        )
    )
    exported = (
        catalog.filter((F.col("library") == library) & F.col("symbol").isNotNull())
        .select("symbol")
        .distinct()
    )
    direct_side, _ = bounded_broadcast(exported.select(F.col("symbol").alias("_direct")), max_broadcast_rows)
    alias_side, _ = bounded_broadcast(exported.select(F.col("symbol").alias("_aliased")), max_broadcast_rows)
    wanted_direct = F.when(F.col("_target") == "-", F.lit(S.ANCHOR_SYMBOL)).otherwise(F.col("_target"))
    staged = parsed.withColumn("_want", wanted_direct).withColumn(
        "_want_alias", F.concat(F.lit(S.ALIAS_PREFIX), F.col("_target"))
    )
    joined = staged.join(direct_side, F.col("_want") == F.col("_direct"), "left").join(
        alias_side,
        (F.col("_target") != "-") & (F.col("_want_alias") == F.col("_aliased")),
        "left",
    )
    symbol = F.coalesce(F.col("_direct"), F.col("_aliased"))
    err = (
        F.when(~F.col("_well_formed"), F.lit("bad binding line"))
        .when(symbol.isNull(), F.concat(F.lit(S.MSG_SYMBOL_NOT_FOUND), F.col("_want")))
        .otherwise(F.lit(""))
    )
    return joined.select(
        "topic",
        F.lit(library).alias("library"),
        symbol.alias("symbol"),
        (err == "").alias("ok"),
        err.alias("err"),
    )


# ---------------------------------------------------------------------------
# J4 -> A4: checked control log
# ---------------------------------------------------------------------------


def validate_log(
    log: DataFrame,
    catalog: DataFrame,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Check every bind/rebind of a control log against the catalog (J4) and
    set ``valid`` (and ``err``) from the result; other operations are valid.
    Feeding the result to :func:`current_bindings` or :func:`route_as_of`
    makes a rejected bind leave the earlier binding in place."""
    is_bind = F.col("op").isin(S.OP_BIND, S.OP_REBIND)
    checked = check_bindings(log.drop("valid"), catalog, max_broadcast_rows)
    return checked.select(
        *[c for c in log.columns if c != "valid"],
        F.when(is_bind, F.col("ok")).otherwise(F.lit(True)).alias("valid"),
        F.when(is_bind, F.col("err")).otherwise(F.lit("")).alias("err"),
    )


def binding_ops(spark, ops, first_seq: int = 0) -> DataFrame:
    """A control log from driver-side operations ``(effective_at, op, topic,
    library, symbol)``, in the order given (``seq`` = position). For the
    handful of operations an operator issues; data-sized logs are tables."""
    from routecast.sources.local import local_table

    rows = []
    for i, (at, op, topic, library, symbol) in enumerate(ops):
        if op not in (S.OP_BIND, S.OP_REBIND, S.OP_UNBIND, S.OP_SUBSCRIBE):
            raise ValueError(f"unknown binding operation {op!r}")
        rows.append((int(at), first_seq + i, op, topic, library, symbol, True))
    return local_table(spark, rows, S.BINDING_LOG_SCHEMA)


def read_binding_file(spark, path: str, library: str, catalog: DataFrame) -> DataFrame:
    """D5 from a text file (or folder of files): one binding per line."""
    return bindings_from_text(spark.read.text(path), library, catalog)


# ---------------------------------------------------------------------------
# Control operations as an append-only table (bind / rebind / unbind /
# subscribe while a stream runs)
# ---------------------------------------------------------------------------


def log_begun(spark, path: str) -> bool:
    """Only a folder that is not there is a log not begun; other errors rise."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def append_binding_ops(spark, path: str, ops, catalog: DataFrame | None = None) -> None:
    """Append control operations ``(effective_at, op, topic, library,
    symbol)`` to the binding log at ``path`` (parquet, shared storage).
    ``seq`` continues after the operations already there, so the log keeps
    one total order; with a ``catalog`` the binds are checked (J4) first and
    a rejected one is recorded as invalid, leaving the old binding. One
    writer at a time (the control plane), as with the reference's lock."""
    last = spark.read.parquet(path).agg(F.max("seq")).first()[0] if log_begun(spark, path) else None
    first_seq = 0 if last is None else int(last) + 1
    new = binding_ops(spark, ops, first_seq=first_seq)
    if catalog is not None:
        new = validate_log(new, catalog).drop("err")
    # one file, so that a reader sees the append whole or not at all
    new.select([f.name for f in S.BINDING_LOG_SCHEMA.fields]).coalesce(1).write.mode("append").parquet(path)


def log_bindings_loader(path: str, catalog: DataFrame | None = None):
    """A ``bindings_loader`` for the streaming sink: the binding table after
    the whole log at ``path``, read again for every micro-batch. With a
    ``catalog``, binds that it rejects leave the earlier binding in place."""

    def load(spark, batch_id: int) -> DataFrame:
        log = spark.read.parquet(path)
        return current_bindings(log if catalog is None else validate_log(log, catalog))

    return load
