"""Time every registered query and the chain-graph PageRank at the published sizes.

Prints one JSON line, also when it is told to stop before the end. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the
cores, ``BENCH_BUDGET`` the seconds after which nothing new begins, ``BENCH_ONLY`` a comma-separated choice. Every query
runs once, which loads what it needs; the queries then run again in the same order as long as the budget lasts,
``BENCH_RUNS`` times in all, and the fastest run counts. ``runs`` tells how often each one ran.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

from catalog import QUERIES
from linkloom.plans import pagerank
from linkloom.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
BUDGET = float(os.environ.get("BENCH_BUDGET", "1200"))
#: Runs longest, over a minute at sf0.1, so it comes after the others.
LAST = ["hits_converged"]
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def chain(spark, k: int):
    layout = pagerank.lay_out_chain(pagerank.chain_nodes(spark, k), k)
    return pagerank.fixed_rounds(layout, 10).orderBy("id").limit(20)


def report(times: dict[str, list[float]]) -> None:
    seconds = {name: round(min(runs), 3) for name, runs in times.items() if runs}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "runs": {name: len(runs) for name, runs in times.items()}}), flush=True)


def main() -> None:
    begin = time.perf_counter()
    spark = build_session(
        "bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {name: (lambda query=query: query(spark, FOLDER)) for name, query in QUERIES.items()}
    jobs["chain_k100"] = lambda: chain(spark, 100)
    jobs["chain_k1000"] = lambda: chain(spark, 1000)
    jobs = {name: job for name, job in jobs.items() if not ONLY or name in ONLY}
    for name in LAST:
        if name in jobs:
            jobs[name] = jobs.pop(name)
    times: dict[str, list[float]] = {name: [] for name in jobs}

    def stopped(*_) -> None:
        report(times)
        os._exit(0)

    signal.signal(signal.SIGTERM, stopped)
    signal.signal(signal.SIGALRM, stopped)
    signal.alarm(int(BUDGET) + 60)  # also a query that does not end leaves the others' figures
    for _ in range(RUNS):
        for name, job in jobs.items():
            if time.perf_counter() - begin > BUDGET:
                break
            start = time.perf_counter()
            consume(job())
            times[name].append(time.perf_counter() - start)
            print(f"{name} {times[name][-1]:.3f}", file=sys.stderr, flush=True)
    report(times)


if __name__ == "__main__":
    main()
