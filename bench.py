"""Benchmark: the medallion flow on the test tables, timed per step.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
and prints ONE JSON line.  Steps, in the order the reference pipeline runs them:

* ``bronze_land``  - derive the three vendor feeds from the test tables and land them
                     as Bronze snapshot tables (raw text columns + lineage)
* ``silver_build`` - normalise, union, mark duplicates; publish ``silver_marked``
* ``mark_duplicates_uniform_keys`` / ``mark_duplicates_one_hot_key`` - duplicate
                     marking over the stored lines, and again with ~60% of all rows
                     re-keyed to a single order line (the skew-safety check)
* ``silver_optimize`` - Z-order compaction on (source_vendor, order_timestamp), the
                     clustering the original pipeline applies before its dashboards
* ``daily_revenue_by_vendor_90d`` - the headline dashboard query: the last 90 days,
                     read through the pushed-down date filter
* gold queries over the stored Silver (the reference's published query timings
  are of this kind): daily revenue by vendor / product / country, customer
  purchase frequency, top 10 products, promo analysis, duplicate report
* ``gold_refresh`` - rebuild and upsert all seven Gold tables as new snapshots
* ``incremental_batch_delta_log`` - the last ~10% of arrivals appended as one batch to
                     Silver and to the delta log of daily revenue by vendor
* ``e2e_daily_revenue_by_vendor`` - raw test tables -> Gold in a single job
"""

from __future__ import annotations

import datetime
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerline.operators import dedup, gold, maintenance  # noqa: E402
from ledgerline.plans import gold_jobs, registry, tables  # noqa: E402
from ledgerline.plans import silver as S  # noqa: E402
from ledgerline.session import build_session, scratch_path  # noqa: E402
from ledgerline.sources import testdata  # noqa: E402
from ledgerline.streaming import delta  # noqa: E402


def _driver_memory() -> str:
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(2, min(24, int(total * 0.6 / 2**30)))
    except (ValueError, OSError):
        gb = 4
    return f"{gb}g"


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="ledgerline-bench",
                          shuffle_partitions=max(8, 2 * cpus), driver_memory=_driver_memory())
    root = scratch_path(spark, "bench")
    q: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        q[name] = round(time.perf_counter() - t0, 3)
        return out

    # JIT / codegen warm-up on the smallest data set (not timed)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        _run(registry.QUERIES["daily_revenue_by_vendor"](spark, warm))

    def land():
        a, b, c = testdata.vendor_feeds(spark, sf_dir)
        # balanced Bronze files (a file is one Parquet row group at this size, i.e. one task)
        S.land_bronze({"vendor_a": a, "vendor_b": b, "vendor_c": c}, f"{root}/bronze", files=2 * cpus)
    timed("bronze_land", land)

    def build_silver():
        a, b, c = (tables.read(spark, f"{root}/bronze/{v}") for v in ("vendor_a", "vendor_b", "vendor_c"))
        return S.publish_silver(a, b, c, f"{root}/silver_marked")
    census = timed("silver_build", build_silver)

    # skew check: every vendor B line re-keyed to ONE order id (~60% of all rows)
    lines = tables.read(spark, f"{root}/silver_marked").drop(*dedup.FLAG_COLUMNS)
    hot = lines.withColumn("order_id", F.when(F.col("source_vendor") == "vendor_b", F.lit("HOT"))
                           .otherwise(F.col("order_id")))
    timed("mark_duplicates_uniform_keys", lambda: _run(dedup.mark_duplicates(lines)))
    timed("mark_duplicates_one_hot_key", lambda: _run(dedup.mark_duplicates(hot)))

    def optimize():
        # files of ~1/(2*cpus) of the table here; 128 MB+ on a cluster
        v = tables.latest_version(spark, f"{root}/silver_marked")
        nbytes = maintenance.table_health(spark, tables.version_path(f"{root}/silver_marked", v)).first()
        target = max(1 << 20, nbytes["size_bytes"] // (2 * cpus))
        maintenance.compact(spark, f"{root}/silver_marked", target_bytes=target,
                            zorder_by=["source_vendor", "order_timestamp"])
    timed("silver_optimize", optimize)

    marked = tables.read(spark, f"{root}/silver_marked")
    silver = dedup.keep_best(marked)
    last = silver.agg(F.max("order_timestamp").alias("m")).first()["m"]
    start_90d = (last - datetime.timedelta(days=89)).strftime("%Y-%m-%d")
    gold_queries = {
        "daily_revenue_by_vendor_90d": lambda: gold.daily_revenue_by_vendor(gold.in_period(silver, start_90d)),
        "daily_revenue_by_vendor": lambda: gold.daily_revenue_by_vendor(silver),
        "top10_products": lambda: gold.top_products(silver),
        "customer_purchase_frequency": lambda: gold.customer_purchase_frequency(silver),
        "daily_product_revenue": lambda: gold.daily_product_revenue(silver),
        "daily_revenue_by_country": lambda: gold.daily_revenue_by_country(silver),
        "promo_analysis": lambda: gold.promo_analysis(silver),
        "duplicate_analysis_report": lambda: gold.duplicate_report(marked),
    }
    for name, build in gold_queries.items():
        timed(name, lambda b=build: _run(b()))

    timed("gold_refresh", lambda: gold_jobs.refresh_all(marked, f"{root}/gold"))

    # incremental: Silver and the delta logs as of a cut-off (untimed), then one late batch applied
    arrivals = lines.select(F.percentile_approx(F.unix_micros("_ingestion_timestamp"), 0.9).alias("p")).first()["p"]
    late = F.coalesce(F.col("_ingestion_timestamp") > F.timestamp_micros(F.lit(arrivals)), F.lit(False))
    logs = {"vendor_day": delta.LOGS["vendor_day"]}
    delta.append_batch(f"{root}/incremental", lines.filter(~late), "bench-000001", logs)
    timed("incremental_batch_delta_log",
          lambda: delta.append_batch(f"{root}/incremental", lines.filter(late), "bench-000002", logs))
    timed("e2e_daily_revenue_by_vendor",
          lambda: _run(registry.QUERIES["daily_revenue_by_vendor"](spark, sf_dir)))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "medallion_total", "value": round(sum(q.values()), 3), "unit": "sec",
                      "queries": q, "sf": sf, "cpus": cpus,
                      "silver_rows": census["rows"], "silver_duplicates": census["duplicates"]}))
    spark.stop()


if __name__ == "__main__":
    main()
