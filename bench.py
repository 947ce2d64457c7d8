"""Benchmark: wall time of the registered queries, one JSON line on stdout.

    BENCH_SF_DIR   folder of tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores        (default 8)
    BENCH_QUERIES  comma list         (default: all)
    BENCH_RUNS     runs per query, of which the fastest counts (default 2)
    BENCH_STREAMS  1 to also replay the tables through the streaming jobs, once each

Each run builds the query anew and computes every row and column.  Streaming
replays are reported apart, under ``streams``: their time includes making and
publishing the messages and starting the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sparkmart.plans.stream_queries  # noqa: E402, F401  (registers its queries)
from sparkmart.plans.queries import QUERIES  # noqa: E402
from sparkmart.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    streams = [n for n in QUERIES if n.startswith("stream_")]
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    names = names or [n for n in QUERIES if n not in streams]
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores, 8)

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once(names[0])  # start-up of the session is not a query's time
    seconds = {name: round(min(once(name) for _ in range(runs)), 3) for name in names}
    result = {
        "metric": "total wall time of all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cores": cores,
    }
    if os.environ.get("BENCH_STREAMS") == "1":
        result["streams"] = {name: round(once(name), 3) for name in streams}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
