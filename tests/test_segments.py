import json

import pytest
from pyspark.sql import functions as F

from routecast.schema import ENVELOPE_COLUMNS, ENVELOPE_SCHEMA
from routecast.sources import segments as M
from routecast.streaming.stream import start_table_sink


def rows(first, last, topics=("a", "b"), partitions=2):
    return [
        (t, p, o, o * 10, None if o % 5 == 0 else f"k{o}".encode(), None if o % 7 == 0 else f"{t}{p}:{o}".encode())
        for t in topics
        for p in range(partitions)
        for o in range(first, last)
    ]


def put(spark, path, data, width=16):
    M.append_segments(spark.createDataFrame(data, ENVELOPE_SCHEMA).repartition(3), path, width)


def got(df):
    return sorted((tuple(None if x is None else bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect()), key=str)


def run(spark, path, tmp_path, topics=("a", "b"), name="s", **how):
    """Read all there is as a stream, stop, and return the sink's rows and the
    rows of each batch."""
    df = M.read_segments(spark, path, list(topics), **how)
    q = start_table_sink(df, str(tmp_path / name / "out"), str(tmp_path / name / "ck"), "append", processing_time="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = spark.read.option("basePath", str(tmp_path / name / "out")).parquet(str(tmp_path / name / "out"))
    sizes = {r.batch_id: r["count"] for r in out.groupBy("batch_id").count().collect()}
    return got(out.select(*ENVELOPE_COLUMNS)), sizes


def test_batch_read(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 50))
    put(spark, path, rows(50, 70))
    whole = M.read_segments(spark, path, ["a", "b"], stream=False)
    assert whole.schema == ENVELOPE_SCHEMA
    assert got(whole) == sorted(rows(0, 70), key=str)
    assert got(M.read_segments(spark, path, "b", stream=False)) == sorted(rows(0, 70, ["b"]), key=str)
    part = M.read_segments(
        spark, path, ["a", "b"], stream=False, starting_offsets={"a": {"0": 33, "1": M.LATEST}}, ending_offsets={"a": {"0": 52}, "b": {"0": 3, "1": 0}}
    )
    want = [r for r in rows(0, 70) if (r[0], r[1]) == ("a", 0) and 33 <= r[2] < 52 or (r[0], r[1]) == ("b", 0) and r[2] < 3]
    assert got(part) == sorted(want, key=str)
    assert M.read_segments(spark, path, "none", stream=False).count() == 0
    assert M.read_segments(spark, str(tmp_path / "nothing"), "a", stream=False).collect() == []
    with pytest.raises(Exception, match="cannot start at 'latest'"):
        M.read_segments(spark, path, "a", {"auto.offset.reset": "latest"}, stream=False).count()
    with pytest.raises(Exception, match="not read"):
        M.read_segments(spark, path, "a", stream=False, starting_offsets={"b": {"0": 1}}).count()


def test_segments_are_cut_by_offset(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 50), width=16)
    own = M.Log(path).segments(["a"])
    assert [(s.first, s.last, s.rows) for s in own if s.partition == 0] == [(0, 15, 16), (16, 31, 16), (32, 47, 16), (48, 49, 2)]


def test_stream_from_earliest_and_restart(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 20))
    assert run(spark, path, tmp_path)[0] == sorted(rows(0, 20), key=str)
    put(spark, path, rows(20, 30))
    put(spark, path, rows(0, 9, ["a"], 3)[18:])  # a partition that is new
    found, sizes = run(spark, path, tmp_path)
    assert found == sorted(rows(0, 30) + rows(0, 9, ["a"], 3)[18:], key=str)
    assert len(sizes) == 2
    # the starting option plays no part once there is a checkpoint
    put(spark, path, rows(30, 31, ["b"]))
    found, _ = run(spark, path, tmp_path, cfg={"auto.offset.reset": "latest"})
    assert len(found) == 4 * 30 + 9 + 2


def test_stream_from_latest(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 20))
    df = M.read_segments(spark, path, ["a"], {"auto.offset.reset": "latest"})
    q = start_table_sink(df, str(tmp_path / "out"), str(tmp_path / "ck"), "append", processing_time="0 seconds")
    try:
        q.processAllAvailable()
        put(spark, path, rows(20, 25))
        q.processAllAvailable()
    finally:
        q.stop()
    assert got(spark.read.parquet(str(tmp_path / "out")).select(*ENVELOPE_COLUMNS)) == sorted(rows(20, 25, ["a"]), key=str)


def test_stream_from_given_offsets(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 20))
    found, _ = run(spark, path, tmp_path, starting_offsets={"a": {"0": 12, "1": M.LATEST}, "b": {"1": M.EARLIEST}})
    want = [r for r in rows(0, 20) if r[0] == "b" or r[1] == 0 and r[2] >= 12]
    assert found == sorted(want, key=str)


def test_bounded_intake_and_restart(spark, tmp_path):
    path, how = str(tmp_path / "log"), {"cfg": {"maxOffsetsPerTrigger": 30}, "progress": str(tmp_path / "progress")}
    put(spark, path, rows(0, 50))
    found, sizes = run(spark, path, tmp_path, **how)
    assert found == sorted(rows(0, 50), key=str)
    assert len(sizes) >= 7 and max(sizes.values()) <= 30
    put(spark, path, rows(50, 70))
    found, sizes = run(spark, path, tmp_path, **how)
    assert found == sorted(rows(0, 70), key=str)
    assert max(sizes.values()) <= 30
    with pytest.raises(Exception, match="progressLocation"):
        run(spark, path, tmp_path, name="other", cfg={"maxOffsetsPerTrigger": 30})


def test_limit_below_the_number_of_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 4, ["a"], 5))
    found, sizes = run(spark, path, tmp_path, ["a"], cfg={"maxOffsetsPerTrigger": 2}, progress=str(tmp_path / "p"))
    assert found == sorted(rows(0, 4, ["a"], 5), key=str) and max(sizes.values()) <= 2


def test_appends_are_whole_or_absent(spark, tmp_path):
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 20))
    files = set((tmp_path / "log" / "data").iterdir())
    with pytest.raises(Exception, match="below the end of the log"):
        put(spark, path, rows(15, 40))
    assert set((tmp_path / "log" / "data").iterdir()) == files
    broken = spark.createDataFrame(rows(20, 30), ENVELOPE_SCHEMA).withColumn("offset", F.when(F.col("offset") < 29, F.col("offset")))
    with pytest.raises(Exception, match="needs a topic"):
        M.append_segments(broken, path)
    assert got(M.read_segments(spark, path, ["a", "b"], stream=False)) == sorted(rows(0, 20), key=str)
    put(spark, path, rows(20, 30))
    assert len(M.Log(path).manifests()) == 2


def test_offsets_round_trip():
    offsets = {("b", 11): 4, ("a", 2): 0}
    assert M.from_json(json.loads(json.dumps(M.to_json(offsets)))) == offsets


def test_short_segments_share_tasks(spark, tmp_path):
    own = [M.Segment("a", p, i * 10, i * 10 + 9, 10, f"{p}-{i}") for p in range(2) for i in range(10_000)]
    tasks = M.slices(own, {("a", 0): 15}, {("a", 0): 100_000, ("a", 1): 99_995})
    assert len(tasks) == 7 and all(sum(e - b for _, b, e in t.value) <= M.TASK_ROWS for t in tasks)
    dealt = [s for t in tasks for s in t.value]
    assert len(dealt) == 19_999 and sum(e - b for _, b, e in dealt) == 200_000 - 15 - 5
    assert dealt[0] == (tuple(own[1]), 15, 20) and dealt[-1] == (tuple(own[-1]), 99_990, 99_995)
    assert len(M.slices([M.Segment("a", 0, 0, 999_999, 10**6, "x")] * 2, {}, {("a", 0): 10**6})) == 2
    path = str(tmp_path / "log")
    put(spark, path, rows(0, 50), width=1)
    whole = M.read_segments(spark, path, ["a", "b"], stream=False)
    assert whole.rdd.getNumPartitions() == 1 and got(whole) == sorted(rows(0, 50), key=str)
    assert run(spark, path, tmp_path)[0] == sorted(rows(0, 50), key=str)
