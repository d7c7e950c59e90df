"""Times the headline queries, each from the given files to its last row; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from shelfcast.plans.registry import queries
from shelfcast.plans.tables import Tables
from shelfcast.session import session

HEADLINE = [
    "demand_classes", "master", "price_join", "feature_table", "rolling_features", "demand_features",
    "model_routing", "prediction_merge", "ensemble_weights", "ensemble_point", "wrmsse", "model_comparison",
    "per_class_metrics", "overview_kpis", "weekly_trend", "prediction_coverage", "decompose_forecast",
    "seasonal_arima", "order_search", "sequence_windows", "quantile_levels", "boosted_point",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(f"local[{cpus}]", int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfcast-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    fns, took = queries(), {}

    def run(frame) -> float:
        began = time.time()
        frame().write.format("noop").mode("overwrite").save()
        return round(time.time() - began, 3)

    run(lambda: fns["demand_classes"](spark, sf_dir))  # compiles and warms up, not counted
    # Every query stages the daily panel from the given files first; that part, by itself.
    staging = run(lambda: Tables(spark, sf_dir).raw.sales)
    for name in wanted:
        took[name] = run(lambda name=name: fns[name](spark, sf_dir))
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "staging_in_each": staging, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
