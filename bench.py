"""Seconds of the headline queries: one JSON line. BENCH_SF_DIR: the tables; BENCH_CPUS: threads."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = ("rolling_state", "state_as_of", "tag_overlay", "pixel_deltas", "palette_encode", "rgb_transparency", "tile_encoding", "sparse_records", "shard_manifest", "tag_thinning", "neighbor_mosaic", "components_d0")
RUNS = 3


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tilewright.plans import catalogue
    from tilewright.session import session

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session(
        "bench",
        **{"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):  # the first one warms up
            began = time.perf_counter()
            catalogue.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(statistics.median(times[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, median of 3", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
