"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from snapweave import workload

HEADLINE = [
    "collapse_changes",
    "recollapse_intervals",
    "backfill_first",
    "latest_correction",
    "filter_entities",
    "code_filter",
    "expand_abbr",
    "waterfall_match",
    "fuzzy_match",
    "explode_years",
    "panelize",
    "xml_flatten",
    "archive_scan",
    "incremental_ingest",
    "links",
    "yearly_facts",
    "aggregate_registry",
    "geocode_chain",
    "registry_panel",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    workload.QUERIES["explode_years"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        workload.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
