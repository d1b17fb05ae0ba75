"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` names the input tables, ``BENCH_CPUS`` the local cores. Each
query is built and run to the ``noop`` sink, so every row is computed and none
is collected. The landing files and tables that several queries read are made
first and timed as ``setup``. Rates of the scorers are a series of their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tweetflow.plans.registry import SETUP, queries  # noqa: E402
from tweetflow.session import build_session  # noqa: E402

SCORERS = {"lexicon": "gold_direct", "model_udf": "gold_pandas_udf"}


def run(spark, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tweetflow-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else None,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    only = sys.argv[1:]
    names = only or list(registered)
    # Starts the JVM's and Python's workers, so that the first query is not
    # charged for them.
    spark.range(1000).repartition(2).mapInPandas(lambda it: it, "id long").count()

    setup = {}
    for name, make in SETUP.items():
        started = time.perf_counter()
        make(spark, sf_dir)
        setup[name] = round(time.perf_counter() - started, 3)
    seconds = {name: round(run(spark, registered[name], sf_dir), 3) for name in names}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "setup": setup,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    if not only:
        n_rows = registered["mention_total"](spark, sf_dir).first()["total_mentions"]
        line["scored_rows_per_sec"] = {
            scorer: round(n_rows / seconds[name]) for scorer, name in SCORERS.items()
        }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
