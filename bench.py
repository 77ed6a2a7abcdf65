"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from roadpulse import fixtures as fx  # noqa: E402
from roadpulse.columns import DET, UTC  # noqa: E402
from roadpulse.operators.axes import Axis  # noqa: E402
from roadpulse.plans.pipelines import feature_cells, normalized_cells  # noqa: E402
from roadpulse.registry import all_queries  # noqa: E402
from roadpulse.session import local_session, materialize  # noqa: E402

HEADLINE = [
    "build_bundle",
    "coverage_report",
    "site_aggregate",
    "dedupe_first",
    "describe_numeric",
    "sibling_correlation",
    "baseline_report",
    "window_samples",
    "feature_drift",
    "radius_graph_binary",
    "radius_graph_gaussian",
    "knn_graph",
    "graph_density",
    "distance_extremes",
    "sigma_all_pairs",
    "neighbour_aggregate",
    "nearest_sensor",
    "relevant_events",
    "embedding_topk",
    "read_detector_csv",
    "write_bundle",
]
# About the published job: 454 detectors x 8760 hours.
YEAR_MONTHS, YEAR_COPIES = 12, 3


def year_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month of readings laid out twelve times in a row for three sets of detectors."""
    month = F.explode(F.sequence(F.lit(0), F.lit(YEAR_MONTHS - 1)))
    copy = F.explode(F.sequence(F.lit(0), F.lit(YEAR_COPIES - 1)))
    df = fx.readings(spark, sf_dir).withColumn("m", month).withColumn("c", copy)
    return df.withColumns(
        {
            UTC: F.timestamp_add("DAY", F.col("m") * 30, F.col(UTC)),
            DET: F.regexp_replace(DET, F.lit("TEU0"), F.concat(F.lit("TEU"), F.col("c").cast("string"))),
        }
    ).drop("m", "c")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    todo = sys.argv[1:] or HEADLINE
    queries = all_queries()
    for name in todo[:2]:  # start the JVM's compiler and the Python workers
        run(queries[name](spark, sf_dir))

    times: dict[str, float] = {}
    for name in todo:
        start = time.perf_counter()
        run(queries[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {times[name]:8.3f}", file=sys.stderr, flush=True)

    report = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if not sys.argv[1:]:
        readings = materialize(year_readings(spark, sf_dir), "year")
        ids = readings.select(DET).distinct()
        axis = Axis(fx.AXIS.start, fx.AXIS.start + YEAR_MONTHS * (fx.AXIS.end - fx.AXIS.start))
        start = time.perf_counter()
        cells = materialize(feature_cells(readings, ids, axis), "cells")
        run(normalized_cells(cells, axis)[0])
        seconds = time.perf_counter() - start
        hours = ids.count() * axis.hours
        report["year_chain"] = {
            "detector_hours": hours,
            "seconds": round(seconds, 3),
            "detector_hours_per_second": round(hours / seconds),
            "published_detector_hours_per_second": 33000,
        }
    print(json.dumps(report), flush=True)


if __name__ == "__main__":
    main()
