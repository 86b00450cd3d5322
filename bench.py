"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import contextlib
import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = ("weighted_vote", "price_alias_vote", "best_frame", "vote_diagnostics", "frame_quality", "coord_lookup", "catalog_blocking", "catalog_match", "catalog_price_bands", "gap_islands", "focus_norm", "token_overlap", "track_review", "task_projection", "split_segments", "task_output")


def main() -> None:
    d, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tagloom.plans import registry

    took = {}
    with contextlib.redirect_stdout(sys.stderr):
        spark.read.parquet(f"{d}/lineitem.parquet").count()
        for name in HEADLINE:
            began = time.perf_counter()
            registry.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(d.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
