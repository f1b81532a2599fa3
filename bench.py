"""Times the registered queries of the library and prints one JSON line.

Every query runs once to warm up, then ``BENCH_RUNS`` times (default 3); the median counts. ``scaling`` has the
time over that on the next smaller scale, of which each query runs once after a warm-up. Results go to the
``noop`` sink, so every row and column is computed. Streaming queries include landing their input; the
``streaming`` block times the micro-batches alone.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog.plans import QUERIES, changes, writing  # noqa: E402
from tidelog.session import local_session, scratch  # noqa: E402
from tidelog.sources.readers import message_stream  # noqa: E402
from tidelog.streaming import runner  # noqa: E402
from tidelog.streaming.mirror_table import MirrorTable  # noqa: E402

SMALLER = {"sf0.1": "sf0.01", "sf0.01": "sf0.001"}


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def streaming(spark, folder: str) -> dict:
    """The change log as 20 message files through the mirror, one file per micro-batch."""
    root = scratch(spark, "bench-stream")
    changes.envelopes(spark, folder).repartition(20).write.text(f"{root}/in")
    log = writing.streamed_log(message_stream(spark, f"{root}/in", 1))
    mirror = MirrorTable(spark, f"{root}/mirror", log.schema, writing.KEY, writing.ORDER)
    start = time.perf_counter()
    query = runner.run(log, mirror.each_batch(fold_every=10), f"{root}/checkpoint")
    spent = time.perf_counter() - start
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    rows = sum(p["numInputRows"] for p in batches)
    return {
        "rows": rows,
        "batches": len(batches),
        "rows_per_sec": round(rows / spent),
        "sec_per_batch": round(spent / len(batches), 3),
        "state_rows": mirror.newest().count(),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_ONLY", "").split() or sorted(QUERIES)
    spark = local_session("tidelog-bench", cores, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    smaller = SMALLER.get(os.path.basename(folder.rstrip("/")))
    below = smaller and os.path.join(os.path.dirname(folder.rstrip("/")), smaller)
    scaling = {}
    times = {}
    for name in chosen:
        timed(spark, name, folder)
        times[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
        if below and os.path.isdir(below):
            timed(spark, name, below)
            scaling[name] = round(times[name] / timed(spark, name, below), 2)
        print(f"{name:28s} {times[name]:8.3f} {scaling.get(name, '')}", file=sys.stderr, flush=True)
    stream = None if os.environ.get("BENCH_ONLY") else streaming(spark, folder)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median time of the registered queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
                "scaling": {"against": smaller, "times": scaling} if scaling else None,
                "streaming": stream,
            }
        )
    )


if __name__ == "__main__":
    main()
