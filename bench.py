"""Time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Times are warm: each query first runs on the next smaller tables beside the given folder
(or on the folder itself where there are none), then once for the clock. Results are read
in full and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mediacat.session import build
from registry import QUERIES, load


def smaller(sf_dir: str) -> str:
    beside = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    return beside if os.path.isdir(beside) else sf_dir


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    load()
    names = sys.argv[1:] or list(QUERIES)
    spark = build(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "bench",
                  **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    seconds = {}
    for name in names:
        consume(QUERIES[name](spark, smaller(sf_dir)))
        started = time.perf_counter()
        consume(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name:30} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
