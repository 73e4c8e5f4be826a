"""Time all queries of the article jobs; prints one JSON line.

`BENCH_SF_DIR` names the tables and `BENCH_CPUS` the cores. Every query runs once to warm
up and is then timed to its last row, written to a sink that discards them.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from articlelake.plans.queries import QUERIES
from articlelake.session import local_session

def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    times = {}
    for name in sys.argv[1:] or QUERIES:
        seconds(spark, name, sf_dir)
        times[name] = round(seconds(spark, name, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
