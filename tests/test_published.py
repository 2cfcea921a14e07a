"""The routed sink's batches appear whole."""

import pytest
from pyspark.sql import functions as F

from routecast.streaming import published
from routecast.streaming.published import BatchRecords
from routecast.streaming.stream import read_routed, vacuum_routed, write_routed

DRAINED = "tbl string, topic string, kind string, data binary, err string"


def drained(spark, mark, n=60):
    rows = [
        (f"t{i % 3}" if i % 4 else None, "a", "data" if i % 4 else "error", f"{mark}{i}".encode(), None if i % 4 else "bad")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, DRAINED).repartition(4)


def marks(df):
    return {(r["batch_id"], bytes(r["data"])[:1].decode()) for r in df.collect()}


def test_a_failed_attempt_is_never_read(spark, tmp_path):
    path = str(tmp_path)
    write_routed(drained(spark, "o"), path, 0)

    @F.udf("binary")
    def breaks(x):
        if x == b"n59":
            raise RuntimeError("half-way")
        return x

    failing = drained(spark, "n").withColumn("data", breaks("data"))
    with pytest.raises(Exception, match="half-way"):
        write_routed(failing, path, 0, rebalance=False, max_records_per_file=2)
    with pytest.raises(Exception, match="half-way"):
        write_routed(failing, path, 1)
    out = read_routed(spark, path)
    assert out.count() == 60 and marks(out) == {(0, "o")}


def test_a_reader_during_a_replay_sees_the_old_rows_whole(spark, tmp_path):
    path = str(tmp_path)
    write_routed(drained(spark, "o"), path, 3)
    before = read_routed(spark, path)
    write_routed(drained(spark, "n", 44), path, 3)
    assert before.count() == 60 and marks(before) == {(3, "o")}
    after = read_routed(spark, path)
    assert after.count() == 44 and marks(after) == {(3, "n")}
    assert vacuum_routed(path, 3600) == []
    assert len(vacuum_routed(path, -60)) == 1
    assert read_routed(spark, path).count() == 44


def test_records_are_folded(tmp_path, monkeypatch):
    monkeypatch.setattr(published, "FOLD_EVERY", 4)
    records, want = BatchRecords(str(tmp_path)), {}
    for i, n in enumerate([0, 1, 2, 2, 3, 1, 4, 5, 6, 0, 7]):
        records.publish(n, {"attempt": f"x{i}", "fields": []})
        want[n] = {"attempt": f"x{i}", "fields": []}
        assert records.read() == want
    assert sum(name.endswith(".all.json") for name in records._listed()) == 2


def test_empty_sinks_batches_and_new_columns(spark, tmp_path):
    assert read_routed(spark, str(tmp_path / "none")).collect() == []
    path = str(tmp_path / "out")
    write_routed(drained(spark, "a", 0), path, 0)
    assert read_routed(spark, path).collect() == []
    write_routed(drained(spark, "b", 8), path, 1)
    write_routed(drained(spark, "c", 8).withColumn("page", F.lit(7)), path, 2)
    out = read_routed(spark, path)
    assert {(r["batch_id"], r["page"]) for r in out.collect()} == {(1, None), (2, 7)}
    # a target named like a number stays text
    write_routed(drained(spark, "d", 8).withColumn("tbl", F.lit("007")), path, 3)
    assert {r["tbl"] for r in read_routed(spark, path).where("batch_id = 3").collect()} == {"007"}
