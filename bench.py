"""Times the registered queries at one scale and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and run once into a sink that keeps nothing, after a warm-up of the
session. The corpus operators are left to the check tool, which runs them at two sizes.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)

from tallywick.plans.registry import callable_for, load_all  # noqa: E402
from tallywick.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    took, failed = {}, {}
    for name in load_all():
        started = time.time()
        try:
            callable_for(name)(spark, folder).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - started, 3)
        except Exception as error:  # the other queries are still timed
            failed[name] = str(error)[:200]
    report = {"metric": "total_query_time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": folder.rsplit("sf", 1)[-1]}
    print(json.dumps(report | ({"failed": failed} if failed else {})))


if __name__ == "__main__":
    main()
