"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed end to end with the ``noop`` sink (the whole plan
runs, nothing is collected to the driver); the best of ``BENCH_REPEAT``
runs is kept. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

import pyspark  # noqa: E402

from routecast.plans import queries as Q  # noqa: E402
from routecast.session import get_session  # noqa: E402

HEADLINE = [
    "route_counts",
    "route_decode_drain",
    "split_data",
    "passthrough_documents",
    "decode_contract",
    "python_decoder",
    "route_as_of",
    "drain_pages",
    "current_bindings",
    "validated_bindings",
    "check_bindings",
    "binding_file",
    "event_rate_dense",
    "event_text",
    "stream_decode",
    "routed_sink",
    "stream_totals",
    "stream_rate",
    "stream_rebind_per_batch",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(
        master=f"local[{cpus}]",
        app_name="routecast-bench",
        shuffle_partitions=cpus * 2,
        conf={"spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    n_events = events.count()
    n_docs = docs.count()
    doc_bytes = docs.selectExpr("sum(octet_length(text)) AS b").first()["b"] or 0

    # warm-up: JIT, Python workers, file listing
    run_noop(Q.QUERIES["route_counts"](spark, sf_dir))

    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run_noop(Q.QUERIES[name](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)

    total = round(sum(timings.values()), 3)
    flagship = timings["route_decode_drain"]
    out = {
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
        "spark": pyspark.__version__,
        "events_rows": n_events,
        "decode_rows_per_sec": round(n_events / flagship, 1) if flagship else None,
        "documents_bytes_per_sec": round(doc_bytes / timings["passthrough_documents"], 1),
        "documents_rows": n_docs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
