"""Time the headline queries on the driver's tables and print one JSON line.

Every query runs to completion through a no-op sink. ``lake_build`` is the whole medallion: five silver
tables, the rollup and three marts written to the shared folder; the metric, quality and report entries
then ask those tables.
"""

from __future__ import annotations

import json
import os
import time

import registered_queries as rq
from railyard.session import build_session

HEADLINE = (
    "silver_ach", "silver_atm", "bronze_latest_state", "gold_daily_volume", "gold_scheme_performance",
    "gold_settlement_summary", "mrg1_upsert", "mrg1_partition_move", "serving_daily_volume", "serving_settlement",
    "metrics_by_scheme_month", "metrics_across_marts", "dq1_not_null", "dq2_unique", "frs1_gate",
    "aud9_alignment", "qry6", "qry8", "qry9", "pro1_profile", "lin1_edges", "src4_topic", "src2_fitting",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        app="railyard-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = rq.queries()
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor before timing
    timed("lake_build", rq.Lake(spark, sf_dir).build)
    for name in HEADLINE:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
