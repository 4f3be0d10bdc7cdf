"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
A query's time covers planning, any size checks, and writing its rows nowhere.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "nino34_index", "nino34_of_anomaly", "hovmoller", "monthly_max", "climatology", "quadratic_detrend",
    "anomaly_full", "monmax_anomaly", "surface_level_sorted", "heat_content", "heat_content_masked",
    "mixed_layer_teos10", "merge_inner", "merge_window", "regrid_bilinear", "anomaly_regridded", "lon_unwrap",
    "field_quantiles", "symmetric_limits", "frame_rows", "zscore", "exact_align_check", "union_incremental",
    "file_preference", "scenario_pairs", "config_overview",
)


def main() -> None:
    from halocline.queries.registry import QUERIES
    from halocline.session import get_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    for t in ("lineitem", "orders"):  # start the JVM and the file cache
        spark.read.parquet(f"{sf}/{t}.parquet").write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
