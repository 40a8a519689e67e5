"""Time the headline queries and print one JSON line.

Each query runs to completion into a no-op sink. BENCH_SF_DIR names the tables, BENCH_CPUS the
local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from floegrid.queries import load_all
from floegrid.session import get_session

HEADLINE = ["overlap_flagship", "overlap_exact_clip", "mosaic", "overview_average", "overview_mode",
            "sync_cube", "retain_newest_cells", "lod_tiers", "chunk_no", "warp_sea_ice_grid",
            "warp_bilinear", "lut_join", "mosaic_tiles", "build_cube", "cube_window", "manifest_diff",
            "footprint_area", "grid_swath"]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = get_session("floegrid-bench", master=f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": "16",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")})
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    names = sys.argv[1:] or HEADLINE
    # One small query pays for class loading before the clock starts.
    registry["mosaic"][0](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
