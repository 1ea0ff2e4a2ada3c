"""Times the headline queries and prints one JSON line; BENCH_SF_DIR and BENCH_CPUS choose input and cores."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = ("robust_fence_stats", "robust_fence_rejects", "stride_sample", "frames_left_detections", "whitelist_markers", "anti_reject_set", "semi_exists", "selection_manifest", "map_last_wins", "box_prompt", "marker_centers_sides", "point_in_box_top1", "coverage_and_area", "laplacian_sharpness", "tracking_fold", "json_required_keys")


def main() -> None:
    from pyspark.sql import SparkSession

    from framelake.plans import workloads

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    own = workloads.queries()
    took = {}
    for name in HEADLINES:
        times = []
        for _ in range(3):  # the first run also compiles; the median is reported
            t = time.perf_counter()
            own[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        took[name] = round(sorted(times)[1], 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
