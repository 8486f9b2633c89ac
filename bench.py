"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from freshet.catalogue import QUERIES
from freshet.runtime import session

HEADLINE = [
    "station_daily_metrics", "rolling_mean_max", "latest_per_key", "numbered_alerts", "price_change_123",
    "trailing_30d_mean", "noon_window", "surrogate_ids", "position_in_group", "type_pivot_totals",
    "share_of_group_total", "deviation_from_group_mean", "dedupe_keep_last", "role_totals_unknown",
    "dimension_join_chain", "outer_measures", "new_rows_anti", "newest_available_before", "events_in_areas",
    "missing_days", "missing_days_per_station", "keep_newest_rows", "keep_newest_by_day_counts",
    "keep_dates_per_collection", "first_priority", "reject_counts", "stitched_records", "rows_of_five_fields",
    "composite_keys", "iso_weeks", "hour_pivot", "hour_unpivot", "grid_cells", "grid_mean_max", "grid_mosaic",
    "grid_overviews", "insert_new_ids", "newest_until_known", "backfill_in_slices", "affected_recompute",
    "dataset_freshness", "target_upsert", "partitions_upserted", "stream_unseen", "stream_noon_windows", "page_links",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["stats_per_group"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
