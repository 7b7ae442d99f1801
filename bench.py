"""Wall time of the headline queries, as one JSON line."""

from __future__ import annotations

import json
import os
import time

from cadastra.queries import QUERIES
from cadastra.session import build_session

HEADLINES = [
    "latest_per_key", "previous_state", "flag_derivation", "distinct_buckets", "conditional_max_pivot",
    "weighted_rate", "exact_median_by_group", "group_benchmark", "key_spine_panel", "prior_year",
    "order_lines_with_priority", "interval_join", "points_in_polygons", "neighbouring_polygons",
    "zonal_statistics", "surrogate_id", "scd2_two_loads", "append_new_rows", "quality_report",
    "manifest_changes", "page_links", "positioned_words", "exploded_lists", "dim_communes",
    "dim_geography", "fact_population", "fact_criminality", "dim_monument",
    "fact_classification_history", "department_report", "visit_departments",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "cadastra-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small job so that the first query does not pay for the start of the session.
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times: dict[str, float] = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
