"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` sink (the whole plan
runs, nothing is collected to the driver). Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Set BENCH_ALL=1 to time every registered query instead of the headline set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voyra.plans.registry import HEADLINE, QUERIES, load_all  # noqa: E402
from voyra.session import build_session  # noqa: E402

# Headline set: one or more queries from every part of the engine.
BENCH_QUERIES = [
    "page_link_stats",   # scan + regex fields + per-host aggregate (flagship)
    "clean_text",        # whole-page cleaning expressions
    "html_reviews",      # render + mapInPandas extraction + typing
    "html_attraction",
    "review_id",         # bucketed exact numbering
    "dedup_reviews",     # dedup with map-side combine
    "page_assemble",     # bounded collect per page
    "thread_assemble",
    "dedup_requests",
    "link_fanout",       # explode + equi-join + explode
    "task_complete",     # task state written and read back
    "classifier_nb",     # naive Bayes as joins and aggregates
    "text_features",
    "stream_ingest",     # availableNow file stream
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    load_all()
    keys = list(QUERIES) if os.environ.get("BENCH_ALL") else \
        [k for k in BENCH_QUERIES + HEADLINE if k in QUERIES]
    if os.environ.get("BENCH_ONLY"):
        keys = os.environ["BENCH_ONLY"].split(",")
    keys = list(dict.fromkeys(keys))
    ckpt = tempfile.mkdtemp(prefix="voyra-bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app="voyra-bench",
                          extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "16g"})
    # warm the JVM and the Python workers (class loading, JIT, codegen) by
    # running the same queries once on the smallest tables; not timed
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for k in keys:
            QUERIES[k](spark, warm).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for k in keys:
        t0 = time.perf_counter()
        try:
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[k] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001  (report, keep timing the rest)
            failed[k] = f"{type(e).__name__}: {str(e)[:200]}"
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
