"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. The layers are written before the clock starts. The steps
of the whole run (find, merge, classify, report) follow each other, and each one starts from the table the step before wrote.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from checks import catalog
from checks.map_views import all_layers
from linecross.session import configure

STEPS = {
    "overlay": catalog._all_pieces,
    "cluster_by_stream": catalog.QUERIES["cluster_by_stream"],
    "find_crossings": catalog.numbered_crossings,
    "merge_by_priority": catalog.merged_crossings,
    "classify": catalog.final_crossings,
    **{name: catalog.QUERIES[name] for name in ("report_region", "report_obs_sources", "nearest_within", "match_archive",
                                                "rail_crossings_per_region")},
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config(
        "spark.ui.enabled", "false").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="linecross-")).config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC").config(
        "spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    all_layers(spark, sf_dir)
    seconds = {}
    for name, step in STEPS.items():
        start = time.perf_counter()
        step(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "line crossing queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
