"""Rows handed to a function per target."""

import json
from collections import Counter

import pyarrow as pa
import pytest

from routecast.plans import samples
from routecast.streaming.dispatch import Dispatcher, dispatched, runs_by_target

DRAINED = "tbl string, topic string, kind string, data binary, err string"


def drained(spark, n=300, hot=0.5):
    """Half of the rows go to one target."""
    rows = []
    for i in range(n):
        if i % 5 == 0:
            rows.append(("default_decoder", f"topic{i % 2}", "error", None, f"bad {i}"))
        else:
            rows.append(("hot" if i < n * hot else f"t{i % 3}" if i % 7 else None, "a", "data", None if i % 11 == 0 else f"{i}".encode(), None))
    return spark.createDataFrame(rows, DRAINED).repartition(5), rows


def stored(spark, path):
    return spark.read.schema("token string, tbl string, topic string, data binary, err string").parquet(path)


def held(df):
    return Counter((r["tbl"], r["topic"], None if r["data"] is None else bytes(r["data"]), r["err"]) for r in df.collect())


def wanted(rows):
    return Counter((t, None, d, None) if kind == "data" else (None, topic, None, err) for t, topic, kind, d, err in rows)


def test_each_row_once_and_a_batch_once(spark, tmp_path):
    df, rows = drained(spark)
    send = Dispatcher(str(tmp_path / "sent"), *samples.storing_receiver(str(tmp_path / "got")))
    assert send(df, 0)
    assert held(stored(spark, str(tmp_path / "got"))) == wanted(rows)
    assert not send(df, 0)  # a replay makes no call
    assert held(stored(spark, str(tmp_path / "got"))) == wanted(rows)
    record = dispatched(spark, str(tmp_path / "sent"))
    by = {(r["kind"], r["tbl"]): r["n"] for r in record.groupBy("kind", "tbl").agg({"n_rows": "sum"}).withColumnRenamed("sum(n_rows)", "n").collect()}
    assert by == Counter((kind, t if kind == "data" else None) for t, _, kind, _, _ in rows)
    assert send(df, 1)
    assert sum(held(stored(spark, str(tmp_path / "got"))).values()) == 2 * len(rows)


def test_a_failed_batch_counts_for_nothing_and_is_undone(spark, tmp_path):
    df, rows = drained(spark)
    upd, on_error, undo = samples.storing_receiver(str(tmp_path / "got"))
    undone = str(tmp_path / "undone")

    def breaks(tbl, data, token):
        upd(tbl, data, token)
        if b"299" in data.to_pylist():
            raise RuntimeError("receiver is down")

    def note(token):
        undo(token)
        with open(undone, "a") as f:
            f.write(json.dumps(token) + "\n")

    with pytest.raises(Exception, match="receiver is down"):
        Dispatcher(str(tmp_path / "sent"), breaks, on_error, note)(df, 0)
    assert open(undone).read().count("\n") >= 1
    assert dispatched(spark, str(tmp_path / "sent")).collect() == []
    assert Dispatcher(str(tmp_path / "sent"), upd, on_error, note)(df, 0)
    tokens = dispatched(spark, str(tmp_path / "sent")).select("token").distinct()
    assert held(stored(spark, str(tmp_path / "got")).join(tokens, "token", "left_semi")) == wanted(rows)


def test_empty_batch_no_side_channel_and_bad_kind(spark, tmp_path):
    got = samples.storing_receiver(str(tmp_path / "got"))
    assert Dispatcher(str(tmp_path / "sent"), got[0])(spark.createDataFrame([], DRAINED), 0)
    assert dispatched(spark, str(tmp_path / "sent")).collect() == []
    df, rows = drained(spark)
    assert Dispatcher(str(tmp_path / "sent"), got[0])(df, 1)
    assert held(stored(spark, str(tmp_path / "got"))) == wanted(r for r in rows if r[2] == "data")
    odd = spark.createDataFrame([("t", "a", None, b"x", None)], DRAINED)
    with pytest.raises(Exception, match="of kind data or error"):
        Dispatcher(str(tmp_path / "sent"), got[0])(odd, 2)


def test_runs_keep_the_order_of_rows():
    batch = pa.RecordBatch.from_pydict({"tbl": ["b", None, "a", "b", "a", None], "data": [b"1", b"2", None, b"4", b"5", b"6"]})
    assert [(t, d.to_pylist()) for t, d in runs_by_target(batch)] == [("a", [None, b"5"]), ("b", [b"1", b"4"]), (None, [b"2", b"6"])]
    assert list(runs_by_target(batch.slice(0, 0))) == []
