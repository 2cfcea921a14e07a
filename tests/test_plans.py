"""Plan shape: the decode path never shuffles payloads, prunes the scan, and
keeps Python out of the plan unless a Python decoder is registered (then
exactly one Arrow UDF node)."""

from routecast.operators.routing import decode, to_drain
from routecast.plans import queries, samples
from routecast.sources.envelopes import read_documents

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_decode_path_is_map_only(spark):
    drained = to_drain(queries.event_events(spark, SF))
    plan = plan_text(drained)
    assert "BroadcastHashJoin" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # the only exchanges are the broadcast of the binding table and the
    # small aggregation building it; the message side is never shuffled
    scan_lines = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scan_lines) == 1
    # drain drops key, time and partition: the scan reads two columns
    assert "ReadSchema: struct<event_type:string,props:string>" in scan_lines[0]
    full = plan_text(queries.event_events(spark, SF))
    scan = [line for line in full.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in scan


def test_counts_prune_scan_to_two_columns(spark):
    plan = plan_text(queries.route_counts(spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<event_type:string,props:string>" in scan


def test_python_decoders_use_one_arrow_udf(spark):
    env = read_documents(spark, SF)
    b = samples.bindings_df(spark, samples.DOCUMENT_BINDINGS)
    plan = plan_text(decode(env, b, samples.sample_registry(with_python=True)))
    assert plan.count("ArrowEvalPython") == 1
    assert "BatchEvalPython" not in plan


def test_unbound_python_decoders_stay_out_of_the_plan(spark):
    env = read_documents(spark, SF)
    b = samples.bindings_df(spark, [("en", "builtin", "default_decoder")])
    plan = plan_text(decode(env, b, samples.sample_registry(with_python=True)))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "py_checksum" not in plan and "json_k" not in plan


def test_routed_sink_rebalances_before_the_write(spark):
    from routecast.streaming.stream import scratch_folder, write_routed

    drained = to_drain(queries.event_events(spark, SF))
    base = scratch_folder(spark, "test_rebalance")
    write_routed(drained, base, 0)
    import glob

    files = glob.glob(base + "/batch_id=0/attempt=*/kind=*/tbl=*/*.parquet")
    dirs = {f.rsplit("/", 1)[0] for f in files}
    assert len(dirs) == 6 and len(files) == len(dirs)  # one file per (kind, tbl) at this size


def _max_method_size(spark, df):
    import contextlib
    import io
    import re

    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    return max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", buf.getvalue()))


def test_decode_code_stays_jit_compilable(spark):
    """Only bound decoders are planned, so the fused decode method stays
    under the 8,000-byte size HotSpot compiles."""
    assert _max_method_size(spark, queries.route_decode_drain(spark, SF)) < 8000
    assert _max_method_size(spark, queries.passthrough_documents(spark, SF)) < 8000
