"""Kafka source options (S1, S3, S4). No connector jar here: only the option
mapping and the error path are testable."""

import pytest

from routecast.sources.kafka import read_topics, source_options, subscription


def test_option_mapping():
    cfg = {
        "bootstrap.servers": "h1:9092",
        "metadata.broker.list": "ignored:9092",
        "group.id": "g",
        "auto.offset.reset": "latest",
        "enable.auto.commit": 0,
        "decode_threads": 0,
        "raw_queue_size": 32768,
        "evt_queue_size": 32768,
        "session.timeout.ms": 6000,
        "check.crcs": True,
        "maxOffsetsPerTrigger": 10,
    }
    o = source_options(cfg)
    assert o.reader["kafka.bootstrap.servers"] == "h1:9092"
    assert o.reader["kafka.group.id"] == "g"
    assert o.reader["startingOffsets"] == "latest"
    assert o.auto_commit is False
    assert o.reader["minPartitions"] == "1"
    assert o.reader["maxOffsetsPerTrigger"] == "10"  # explicit Spark option wins
    assert o.reader["kafka.session.timeout.ms"] == "6000"
    assert o.reader["kafka.check.crcs"] == "true"
    assert "kafka.enable.auto.commit" not in o.reader
    assert "kafka.auto.offset.reset" not in o.reader


def test_defaults_and_fallbacks():
    o = source_options({"metadata.broker.list": "h2:9092", "group.id": ""})
    assert o.reader["kafka.bootstrap.servers"] == "h2:9092"
    assert "kafka.group.id" not in o.reader
    assert o.reader["startingOffsets"] == "earliest"
    assert o.auto_commit is True and o.decode_threads == 4 and o.raw_queue_size == 8192
    assert source_options({}, default_start="latest").reader["startingOffsets"] == "latest"
    assert source_options({"enable.auto.commit": "yes"}).auto_commit is False
    assert source_options({"enable.auto.commit": "true"}).auto_commit is True


def test_rejections():
    with pytest.raises(TypeError):
        source_options({"x": 1.5})
    with pytest.raises(ValueError):
        source_options({"auto.offset.reset": "sometimes"})
    with pytest.raises(ValueError):
        source_options({"key.deserializer": "x"})
    with pytest.raises(ValueError):
        subscription([])
    with pytest.raises(ValueError):
        subscription(["bad topic"])
    assert subscription(["a", "b", "a"]) == "a,b"
    assert subscription("a") == "a"


def test_read_topics_needs_servers_and_connector(spark):
    with pytest.raises(ValueError):
        read_topics(spark, ["t"], {})
    with pytest.raises(ValueError):
        read_topics(spark, ["t"], {"bootstrap.servers": "h:1", "auto.offset.reset": "latest"}, stream=False)
    with pytest.raises(Exception) as err:
        read_topics(spark, ["t"], {"bootstrap.servers": "h:1"}).schema
    assert "kafka" in str(err.value).lower()
