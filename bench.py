"""Wall seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import time

from placeloom.plans.catalog import QUERIES
from placeloom.session import build_session

HEADLINE = [
    "list_buildings", "classify_roads", "impute_style", "owner_chunk", "line_spans", "point_in_polygon_join", "nearest_join", "segment_intersection_join",
    "raster_sample", "raster_blur", "ground_overlay", "junctions", "connected_components", "presence_sessions", "chunk_index", "collision_cells",
    "crossings", "shortest_paths", "completeness_areas", "delivery_lateness",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
                                                        "spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    only = os.environ.get("BENCH_QUERIES")
    for name in (only.split(",") if only else HEADLINE):
        if name not in QUERIES:
            continue
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_queries_wall", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
