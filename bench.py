"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from catalogue.queries import REGISTRY
from salesloom.session import build_session

HEADLINE = (
    "cards_join",
    "monthly_shipments",
    "own_brand_shipments",
    "segment_classes",
    "gap_filled_panel",
    "rolling_features",
    "ratio_features",
    "cohort_decile_clusters",
    "sma_forecasts",
    "model_selection",
    "wallet_share",
    "stretch_bands",
    "quantile_uplift",
    "branch_allocation",
    "own_brand_allocation",
    "own_brand_plan_sma",
    "boosting_frame",
    "gbt_cluster_forecast",
    "entire_plan_result",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's file and shuffle paths before anything is timed
    spark.read.parquet(f"{root}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "sales_plan_headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
