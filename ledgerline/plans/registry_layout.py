"""Registered queries about how tables are laid out: group sizes, observed writes, file verdicts, written order,
Z-order inside partitions, bucketed catalog tables, inferred types."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.operators import dedup
from ledgerline.plans import oracle as O
from ledgerline.plans import silver as S
from ledgerline.plans.registry import _LINE_SQL, LINE_COLUMNS, _landing, _published_silver, _sql, register


@register("duplicate_group_size", _sql(
    f"SELECT {_LINE_SQL}, _is_duplicate, CASE WHEN order_id IS NULL OR line_number IS NULL THEN 1 "
    "ELSE COUNT(*) OVER (PARTITION BY order_id, line_number) END AS _copies FROM marked"))
def q_group_size(spark, sf):
    """Silver with the number of copies of each line's order, hot orders split over tasks."""
    _, silver = _published_silver(spark, sf, "copies")
    return dedup.with_copies(silver).select(*LINE_COLUMNS, "_is_duplicate", "_copies")


@register("observed_silver_write", _sql(
    "SELECT COUNT(*) AS rows, COUNT(CASE WHEN _is_duplicate THEN 1 END) AS duplicates, COUNT(*) AS stored FROM marked"))
def q_observed(spark, sf):
    """Rows and duplicates counted by the write of Silver itself, next to what the stored table holds."""
    from ledgerline.plans import tables
    from ledgerline.session import scratch_path
    from ledgerline.sources import testdata
    root = scratch_path(spark, "observed")
    seen = S.publish_silver(*testdata.vendor_feeds(spark, sf), root)
    return tables.read(spark, root).agg(F.count(F.lit(1)).alias("stored")).withColumns(
        {c: F.lit(seen[c]).cast("long") for c in ("rows", "duplicates")})


@register("table_health_verdicts", _sql(
    "SELECT num_files, file_count_verdict, file_size_verdict, (SELECT COUNT(*) FROM marked) AS rows FROM (VALUES "
    "(CAST(4 AS BIGINT), 'ok', 'warn'), (24, 'warn', 'ok'), (64, 'bad', 'bad')) AS v(num_files, file_count_verdict, file_size_verdict)"))
def q_verdicts(spark, sf):
    """All verdicts of file count and file size: Silver as 4, 24 and 64 files under limits of 16 and 48 files, and of
    a 40th and a 10th of the table a file."""
    from ledgerline.operators import maintenance
    from ledgerline.plans import tables
    root, _ = _published_silver(spark, sf, "verdicts", files=64)
    out = None
    for files in (64, 24, 4):
        if files < 64:
            tables.gather(spark, root, files)
        version = tables.latest_version(spark, root)
        path = tables.version_path(root, version)
        total = maintenance.table_health(spark, path).first()["size_bytes"]
        health = maintenance.table_health(spark, path, files_warn=16, files_bad=48, size_min=total // 40, size_max=total // 10)
        rows = tables.read(spark, root, version).agg(F.count(F.lit(1)).alias("rows"))
        one = health.select("num_files", "file_count_verdict", "file_size_verdict").crossJoin(rows)      # one row each
        out = one if out is None else out.unionByName(one)
    return out


@register("gold_written_order", _sql(
    "SELECT 'daily_revenue_by_country' AS table_name, COUNT(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM "
    f"({O.revenue_sql(['country_code', 'order_date'])}) UNION ALL "
    "SELECT 'daily_revenue_by_vendor', COUNT(*), CAST(0 AS BIGINT) FROM "
    f"({O.revenue_sql(['source_vendor', 'order_date'])})"))
def q_written_order(spark, sf):
    """Gold tables as a refresh stores them: their rows, and how many stand out of the order they were sorted in."""
    from ledgerline.operators import maintenance
    from ledgerline.plans import gold_jobs, tables
    root, marked = _published_silver(spark, sf, "order_silver")
    out = None
    for spec in gold_jobs.GOLD_TABLES:
        if spec.name not in ("daily_revenue_by_vendor", "daily_revenue_by_country"):
            continue
        version = gold_jobs.refresh(spec, marked, f"{root}-gold")
        path = tables.version_path(f"{root}-gold/{spec.name}", version)
        by = ["order_date"] + [k for k in spec.keys if k != "order_date"]
        one = maintenance.written_order(spark, path, by).agg(F.sum("rows").alias("rows"), F.sum("out_of_order").alias("out_of_order")) \
            .select(F.lit(spec.name).alias("table_name"), "rows", "out_of_order")
        out = one if out is None else out.unionByName(one)
    return out


@register("zorder_partitioned", _sql(
    "SELECT source_vendor, country_code, TRUE AS fewer_after, COUNT(*) AS lines FROM marked "
    "WHERE country_code IN ('NATION_3', 'NATION_12') GROUP BY source_vendor, country_code"))
def q_zorder_partitioned(spark, sf):
    """Z-order inside the partitions of a table by vendor: the files a filter on a country opens fall, no row is lost."""
    from ledgerline.operators import maintenance
    from ledgerline.plans import tables
    from ledgerline.session import scratch_path
    root = scratch_path(spark, "zorder_parts")
    tables.publish(S.test_marked(spark, sf).repartition(12, *dedup.IDENTITY), root, partition_by=["source_vendor"], rebalance=False)
    size = maintenance.table_health(spark, tables.version_path(root, 1)).first()["size_bytes"]
    maintenance.compact(spark, root, target_bytes=max(1, size // 36), zorder_by=["order_timestamp", "country_code"])
    countries = ("NATION_3", "NATION_12")
    before, after = (maintenance.files_holding(spark, root, "country_code", countries, v) for v in (1, 2))
    rows = [(c, a < b) for c, b, a in zip(countries, before, after)]
    touched = spark.createDataFrame(rows, "country_code string, fewer_after boolean")
    return (tables.read(spark, root).groupBy("source_vendor", "country_code").agg(F.count(F.lit(1)).alias("lines"))
            .join(touched, "country_code"))


def _catalog_lines(spark, sf, name: str):
    """(database, table) of the unified lines in a database of this query's own."""
    from ledgerline.plans import catalog
    from ledgerline.session import scratch_path
    database = f"orders_{uuid.uuid4().hex[:12]}"
    return database, catalog.save_lines(S.staged_lines(spark, sf), database, "lines", scratch_path(spark, "catalog", name))


@register("bucketed_dedup", _sql(f"SELECT {_LINE_SQL} FROM silver"))
def q_bucketed(spark, sf):
    """One line per order from a catalog table bucketed by order: ranked without an exchange."""
    from ledgerline.plans import catalog
    database, table = _catalog_lines(spark, sf, "dedup")
    best = catalog.best_lines(spark, table).select(*LINE_COLUMNS)
    catalog.drop_database(spark, database)      # the plan keeps files and buckets
    return best


@register("bucketed_batch_lines", _sql(
    f"SELECT {_LINE_SQL} FROM lines WHERE order_id IN (SELECT order_id FROM lines WHERE _ingestion_timestamp >= TIMESTAMP '1998-06-01')"))
def q_bucketed_batch(spark, sf):
    """All stored copies of the orders of a late batch: only the batch's keys are shuffled."""
    from ledgerline.plans import catalog
    database, table = _catalog_lines(spark, sf, "batch")
    batch = S.staged_lines(spark, sf).filter(F.col("_ingestion_timestamp") >= F.lit("1998-06-01").cast("timestamp"))
    lines = catalog.lines_of_batch(spark, table, batch).select(*LINE_COLUMNS)
    catalog.drop_database(spark, database)
    return lines


def _count_sql(name: str, v1: str, v2: str, merged: str, value: str) -> str:
    return (f"SELECT '{name}' AS column_name, '{v1}' AS old_layout, '{v2}' AS new_layout, '{merged}' AS merged, COUNT({value}) AS n_values "
            "FROM f2 WHERE vendor = 'vendor_a'")


@register("inferred_types", _sql(" UNION ALL ".join([
    _count_sql("order_id", "string", "string", "string", "order_id"),
    _count_sql("quantity", "int", "decimal(3,1)", "decimal(3,1)", "qty"),
    _count_sql("order_date", "timestamp", "string", "string", "CASE WHEN promo OR order_ts IS NOT NULL THEN 1 END"),
    _count_sql("discount_pct", "void", "int", "int", "CASE WHEN promo THEN 1 END"),
    _count_sql("customer_email", "string", "void", "string", "CASE WHEN NOT promo THEN customer END"),
    _count_sql("payment_status", "string", "string", "string", "CASE WHEN partkey % 17 <> 0 THEN 1 END")])))
def q_inferred(spark, sf):
    """Types of the two layouts of vendor A's files and of both together, where they disagree: quantities with and
    without fractions, dates with and without unreadable ones, columns that one layout lacks."""
    from ledgerline.schemas import DATE_FORMAT_A, VENDOR_A_V1, VENDOR_A_V2
    from ledgerline.sources import files, infer, testdata
    feed, root = testdata.vendor_a_feed(testdata.order_facts(spark, sf)), _landing(spark, "inferred")
    old = feed.filter(~F.col("_layout_v2")).withColumn("order_date", F.when(F.col("order_date") != "not-a-date", F.col("order_date")))
    new = feed.filter("_layout_v2").withColumn("quantity", F.format_string("%.1f", F.col("quantity").cast("double") / 2))
    files.write_vendor_files(old, f"{root}/v1", VENDOR_A_V1 + ["payment_status"])
    files.write_vendor_files(new, f"{root}/v2", VENDOR_A_V2 + ["payment_status"])
    formats = (DATE_FORMAT_A, *infer.TIMESTAMP_FORMATS)
    columns = ["order_id", "quantity", "order_date", "discount_pct", "customer_email", "payment_status"]
    both = []
    for layout in ("v1", "v2"):
        bronze = files.read_vendor_a(spark, f"{root}/{layout}/*.csv")
        missing = {c: F.lit(None).cast("string") for c in columns if c not in bronze.columns}
        both.append(infer.profile(bronze.withColumns(missing) if missing else bronze, columns, formats))
    types = infer.with_types(infer.merge(*both)).select("column", F.col("type").alias("merged"), "n_values")
    for name, p in zip(("old_layout", "new_layout"), both):
        types = types.join(infer.with_types(p).select("column", F.col("type").alias(name)), "column")
    return types.withColumnRenamed("column", "column_name")
