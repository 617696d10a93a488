"""Benchmark: headline reconciliation queries on $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the sum over headline queries of the median of 3 warm runs
(each run fully evaluates the query into a no-op sink). The one-time load
of the raw tables (binding + derivations written as Parquet, the
reference's data generation and bulk load) and a full model build
(``dbt run`` equivalent, writing every intermediate, mart and dimension)
are reported separately.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q00_pos_sap_tier_histogram", "m12_int_sap_sales_by_store_date", "m13_int_pos_sap_matched",
    "m14_int_pay_bank_matched", "m15_mart_recon_summary", "m16_mart_pos_sap_detail", "m17_mart_pay_bank_detail",
    "m18_mart_exception_log", "m19_mart_root_cause_trend", "m20_dim_store_enriched", "m21_dim_country_enriched",
    "m22_dim_root_cause_enriched", "k12_check_report", "j16_eod_without_ledger", "o01_exception_log_order",
    "m12_sales_by_store_date_lineitem_ledger", "d14_recon_match_result", "w07_document_sequence",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="ledgerloom-bench-", dir="/tmp")
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("ledgerloom-bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
             .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from ledgerloom.plans import build, registry
    from ledgerloom.sources.raw import stored_raw

    t = time.time()
    stored_raw(spark, sf_dir, registry.CFG).load_all()
    load_sec = time.time() - t

    per_query = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            t = time.time()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t)
        per_query[name] = round(statistics.median(runs), 3)

    t = time.time()
    build.run_models(spark, sf_dir, f"{scratch}/models", registry.CFG)
    build_sec = time.time() - t

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_median_sum", "value": round(sum(per_query.values()), 3), "unit": "sec",
        "queries": per_query, "sf": sf, "load_sec": round(load_sec, 3), "model_build_sec": round(build_sec, 3),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
