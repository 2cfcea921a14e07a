"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants. Partition counts are left to the caller / AQE.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python decoders see whole payloads; bound an Arrow batch by records so
    # large messages (documents reach ~130 KB) keep batches in the 100s of MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # 64-bit offsets for strings and binaries in Arrow batches: 2,048 large
    # messages (1 MB each is common on Kafka) would overflow 32-bit ones.
    "spark.sql.execution.arrow.useLargeVarTypes": "true",
    # A generated method over 8,000 bytes of bytecode is never JIT-compiled by
    # HotSpot; past that size Spark should drop whole-stage fusion for the
    # plan (its per-operator code stays compilable) rather than interpret it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(
    master: str | None = None,
    app_name: str = "routecast",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_BASE_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Reads ``spark.sql.streaming.checkpointLocation`` then
    ``spark.checkpoint.dir`` from the session, i.e. the folder the cluster
    names. A local session (tests) with neither gets a scratch folder, written
    back into ``spark.checkpoint.dir`` so later calls agree; on a cluster that
    is an error, as a folder of the driver's machine is not shared.
    """
    for key in ("spark.sql.streaming.checkpointLocation", "spark.checkpoint.dir"):
        value = spark.conf.get(key, None)
        if value:
            return value.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="routecast-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run (checkpoint and output of a query that starts
    from nothing), removed when the driver ends."""
    path = os.path.join(checkpoint_root(spark), "routecast-scratch", f"{name}-{uuid.uuid4().hex}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: for a driver
    that runs from a source folder the workers do not have on their path (an
    installed package needs no shipping)."""
    import zipfile

    if getattr(spark.sparkContext, "_routecast_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="routecast-code-"), "routecast.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    spark.sparkContext.addPyFile(target)
    spark.sparkContext._routecast_shipped = True
