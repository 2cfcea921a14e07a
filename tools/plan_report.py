"""Write PLANS.md: for every registered batch query, the physical-plan facts
that matter at scale (exchanges, broadcasts, Python nodes, windows, largest
generated method).

    python tools/plan_report.py [sf_dir]

Plans are taken with adaptive execution off, so the static plan and its
whole-stage code are visible; at run time AQE may still coalesce partitions
or turn a sort-merge join into a broadcast.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from routecast.plans.queries import QUERIES  # noqa: E402
from routecast.session import get_session  # noqa: E402

STREAMING = {n for n in QUERIES if n.startswith("stream_") or n == "routed_sink"}  # their results are read back from sinks


def facts(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", buf.getvalue())]
    return {
        "hash exchanges": plan.count("Exchange hashpartitioning"),
        "single-partition exchanges": plan.count("Exchange SinglePartition"),
        "round-robin / range exchanges": plan.count("Exchange RoundRobinPartitioning")
        + plan.count("Exchange rangepartitioning"),
        "broadcasts": plan.count("BroadcastExchange"),
        "python nodes": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
        "windows": len(re.findall(r"(?m)^\W*Window ", plan)),
        "largest method (bytes)": max(sizes) if sizes else 0,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[4]", shuffle_partitions=8, conf={"spark.sql.adaptive.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    rows = []
    for name, fn in QUERIES.items():
        if name in STREAMING:
            continue
        rows.append((name, facts(fn(spark, sf_dir))))
    cols = list(rows[0][1])
    lines = [
        "# Physical plans of the registered batch queries",
        "",
        f"Generated by `tools/plan_report.py` on {os.path.basename(sf_dir)}, adaptive execution off "
        "(static plans; at run time AQE may coalesce partitions or switch joins to broadcast). "
        "Exchanges count every shuffle in the plan, including those of small control tables "
        "(binding table, bucket or piece tables); which ones carry messages is described per "
        "query in README.md.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "|---|" + "---|" * len(cols),
    ]
    for name, f in rows:
        lines.append(f"| `{name}` | " + " | ".join(str(f[c]) for c in cols) + " |")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
