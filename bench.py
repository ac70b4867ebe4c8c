"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores.  Each query
runs once to warm up and then three times; the median is reported.
"""

import json
import os
import statistics
import sys
import time

from almanack.registry import QUERIES
from almanack.session import local_session

HEADLINE = [
    "peak_days", "hourly_to_daily", "circular_mean", "station_median", "nearest_station",
    "ring_coverage_choice", "ewm_fill", "impute_markers", "run_length", "season_dates",
    "other_series_sum", "feature_panel", "ts_features_sql", "pca_outliers",
]


def timed(run):
    began = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main(repeats=3):
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=cores)
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        def run(name=name):
            return QUERIES[name](spark, folder)

        timed(run)
        seconds[name] = round(statistics.median(timed(run) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "total of median wall-clock per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
                "spark": spark.version,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )


if __name__ == "__main__":
    main()
