"""Time the headline queries and print one JSON line.

Each time is told on standard error as soon as it is known; a run that is ended early prints the line with the
times it has.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores, ``BENCH_QUERIES`` (comma
separated, or ``all``) another choice of queries.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from loamlens.queries import QUERIES  # noqa: E402
from loamlens.session import local_session  # noqa: E402

HEADLINE = (
    "clean_records", "lookup_join", "point_in_polygon", "match_union", "state_yield_profile",
    "impute_all", "derive_features", "grouped_quantile_narrowed", "group_shuffle_split",
    "group_kfold", "fold_sizes", "gower_nn", "cv_similarity", "local_variance",
    "stability_correlation", "matched_training_table", "train_forest",
)
#: a query runs up to so often, while its runs took less than so many seconds in all
RUNS, REPEAT_BELOW = 3, 15.0


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def typical(spark, name: str, sf_dir: str) -> float:
    """The median of the runs; one run of a long query."""
    runs = [seconds(spark, name, sf_dir)]
    while len(runs) < RUNS and sum(runs) < REPEAT_BELOW:
        runs.append(seconds(spark, name, sf_dir))
    return round(median(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's and the Python workers' machinery outside of the measurement
    seconds(spark, "full_scan", sf_dir)
    times, failed = {}, {}

    def stop(*_) -> None:
        raise SystemExit("ended early")

    signal.signal(signal.SIGTERM, stop)
    try:
        for name in names:
            try:
                times[name] = typical(spark, name, sf_dir)
            except Exception as error:  # the other queries' times are still of use
                failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
            print(name, times.get(name, failed.get(name)), file=sys.stderr, flush=True)
    finally:
        print(json.dumps({
            "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
            "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus,
            **({"failed": failed} if failed else {}),
        }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
