"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (comma-separated) narrows the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sparkzone.queries import QUERIES
from sparkzone.session import build_session

HEADLINE = (
    "vehicle_emission_summary",
    "temperature_trends",
    "climate_country_year",
    "text_features",
    "text_type_profile",
    "hashtag_bridge",
    "quarantine_split_valid",
    "dedup_keyed",
    "rolling_average",
    "rank_in_group",
    "row_fingerprint_diff",
    "weather_summary",
    "dim_station",
    "image_canonical",
    "pending_work",
    "vector_topk",
    "stratified_split",
    "stream_weather",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The virtual machine starts, loads classes and opens its first file before anything is timed.
    QUERIES["dim_year_union"](spark, folder).write.format("noop").mode("overwrite").save()
    took = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {took[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(scale)}))


if __name__ == "__main__":
    main()
