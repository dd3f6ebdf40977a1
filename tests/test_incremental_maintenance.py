"""Incremental Silver/Gold, snapshot tables, maintenance jobs."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import dedup, gold, maintenance
from ledgerline.plans import tables
from ledgerline.streaming import delta
from tests_support import rows

SCHEMA = ("order_id string, line_number int, order_timestamp timestamp, country_code string, "
          "source_vendor string, total_amount_usd decimal(18,2), discount_amt_usd decimal(18,2), "
          "payment_status string, _ingestion_timestamp timestamp, _source_file string, _source_row long")


def _batch(spark, data, f):
    return spark.createDataFrame([(*d, f, i) for i, d in enumerate(data)], SCHEMA)


D = lambda day: datetime(2024, 1, day)
B1 = [("X", 1, D(2), "JP", "vendor_c", Decimal("10.00"), None, "completed", D(10)),
      ("Y", 1, D(3), "KR", "vendor_c", Decimal("5.00"), Decimal("1.00"), "pending", D(10)),
      (None, 1, D(4), "KR", "vendor_c", Decimal("1.00"), None, "pending", D(10))]
# late settled copies: X moves to another day (day 2 vanishes), Y loses its discount; a line without an id
# falls on a key that no other line of the batch touches
B2 = [("X", 1, D(1), "JP", "vendor_c", Decimal("12.00"), None, "settled", D(11)),
      ("Y", 1, D(3), "KR", "vendor_c", Decimal("5.00"), None, "settled", D(11)),
      (None, 1, D(4), "KR", "vendor_c", Decimal("2.00"), None, "pending", None)]
B3 = [("X", 1, D(1), "JP", "vendor_c", Decimal("11.00"), None, "pending", D(12)),
      ("Z", 1, D(3), "KR", "vendor_c", Decimal("7.00"), Decimal("0.50"), "completed", D(12))]
LOGS = {"country_day": delta.LOGS["country_day"]}


def _country(spark, root):
    return delta.present(delta.state(spark, root, "country_day"), LOGS["country_day"].dims, duplicate_count=False)


def _rebuilt(*batches):
    lines = batches[0]
    for b in batches[1:]:
        lines = lines.unionByName(b)
    return gold.daily_revenue_by_country(dedup.keep_best(lines), audit=False)


def test_delta_log_equals_full_rebuild_under_replays(spark, tmp_dir):
    root = f"{tmp_dir}/lake"
    b1, b2, b3 = (_batch(spark, b, f"f{i}") for i, b in enumerate((B1, B2, B3)))
    assert delta.append_batch(root, b1, "s-000001", LOGS)
    assert delta.append_batch(root, b2, "s-000002", LOGS)
    got = _country(spark, root)
    assert rows(got) == rows(_rebuilt(b1, b2))
    assert got.filter(F.col("order_date") == F.lit("2024-01-02").cast("date")).count() == 0
    assert got.filter("order_date = date'2024-01-04'").first()["total_amount_usd"] == Decimal("3.00")
    assert delta.append_batch(root, b3, "s-000003", LOGS)
    for again in ("s-000001", "s-000002", "s-000003"):               # any replay, also of an earlier batch
        assert not delta.append_batch(root, b1, again, LOGS)
    assert rows(_country(spark, root)) == rows(_rebuilt(b1, b2, b3))
    delta.fold(spark, root, "country_day", LOGS)
    assert rows(_country(spark, root)) == rows(_rebuilt(b1, b2, b3))
    delta.append_batch(root, b2.withColumn("_source_file", F.lit("f9")), "s-000004", LOGS)
    assert rows(_country(spark, root)) == rows(_rebuilt(b1, b2, b3, b2.withColumn("_source_file", F.lit("f9"))))


def test_batch_reads_only_its_buckets(spark, tmp_dir):
    root = f"{tmp_dir}/b"
    tables.append(_batch(spark, B1, "f").withColumn(delta.BUCKET_COL, delta.bucket()), root, 1, [delta.BUCKET_COL])
    plan = tables.read_appended(spark, root).filter(F.col(delta.BUCKET_COL).isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters")[1][:80]


def test_append_only_table(spark, tmp_dir):
    root = f"{tmp_dir}/ao"
    assert tables.read_appended(spark, root) is None
    assert tables.append(spark.range(3).withColumn("p", F.lit(1)), root, "b1", ["p"]) == 3
    assert tables.append(spark.range(5).withColumn("p", F.lit(1)), root, "b1", ["p"]) is None      # committed already
    assert tables.append(spark.range(0).withColumn("p", F.lit(1)), root, "b2", ["p"]) == 0         # an empty batch
    # a batch that died before its commit is not read; its replay replaces it
    spark.range(100).withColumn("p", F.lit(2)).write.partitionBy("p").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(f"{root}/data/_batch=b3")
    tables.append(spark.range(7, 9).withColumns({"p": F.lit(2), "extra": F.lit("x")}), root, "b4", ["p"])
    assert sorted(r["id"] for r in tables.read_appended(spark, root).collect()) == [0, 1, 2, 7, 8]
    tables.append(spark.range(9, 10).withColumn("p", F.lit(3)), root, "b3", ["p"])
    df = tables.read_appended(spark, root)
    assert df.filter("extra IS NULL").count() == 4 and tables.committed(spark, root) == ["b1", "b2", "b3", "b4"]
    before = rows(df, "id", "p", "extra", "_batch")
    assert tables.compact_appended(spark, root) == 1
    assert rows(tables.read_appended(spark, root), "id", "p", "extra", "_batch") == before
    assert tables.partition_columns(spark, f"{root}/base/v=000001") == ["p"]
    tables.append(spark.range(20, 21).withColumn("p", F.lit(1)), root, "b5", ["p"])
    assert tables.read_appended(spark, root).count() == len(before) + 1
    assert tables.read_appended(spark, root, without=["b1"]).count() == len(before) - 2
    assert tables.append(spark.range(5).withColumn("p", F.lit(1)), root, "b1", ["p"]) is None


def test_snapshot_versions(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    assert tables.latest_version(spark, root) is None
    assert tables.publish(spark.range(5), root) == 1
    assert tables.publish(spark.range(7), root) == 2
    assert tables.read(spark, root).count() == 7
    assert tables.read(spark, root, 1).count() == 5
    # a version whose job died is invisible
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(tables.version_path(root, 3))
    assert tables.latest_version(spark, root) == 2


def test_compaction_preserves_rows_and_cuts_files(spark, tmp_dir):
    root = f"{tmp_dir}/c"
    df = spark.range(20000).select(F.col("id"), (F.col("id") % 97).alias("g"),
                                   F.concat(F.lit("k"), (F.col("id") % 5).cast("string")).alias("s"))
    tables.publish(df, root, files=40)
    health = maintenance.table_health(spark, tables.version_path(root, 1)).first()
    assert health["num_files"] == 40 and health["file_size_verdict"] == "bad"
    report = maintenance.compact(spark, root, zorder_by=["g", "s"]).first()
    assert report["files_before"] == 40 and report["files_after"] == 1
    assert rows(tables.read(spark, root)) == rows(df)
    assert maintenance.vacuum(spark, root, retention_hours=0, dry_run=True) == [1]


def test_zorder_key_orders_by_interleaved_buckets(spark):
    df = spark.range(1000).select((F.col("id") % 32).alias("a"), (F.col("id") / 32).cast("long").alias("b"))
    z = maintenance.with_zorder(df, ["a", "b"], bits=5).select("a", "b", "_z")
    got = {(r["a"], r["b"]): r["_z"] for r in z.collect()}
    assert got[(0, 0)] < got[(1, 1)] < got[(31, 30)]
    # monotone in each column with the other fixed (bucket bits interleave)
    for b in range(31):
        zs = [got[(a, b)] for a in range(32) if (a, b) in got]
        assert zs == sorted(zs)
    for a in range(32):
        zs = [got[(a, b)] for b in range(32) if (a, b) in got]
        assert zs == sorted(zs)


def test_health_partition_columns(spark, tmp_dir):
    root = f"{tmp_dir}/p"
    df = spark.range(100).select("id", (F.col("id") % 3).alias("day"))
    tables.publish(df, root, partition_by=["day"])
    h = maintenance.table_health(spark, tables.version_path(root, 1)).first()
    assert h["partition_columns"] == ["day"] and h["num_files"] >= 3


def test_partition_pruning_reaches_scan(spark, tmp_dir):
    root = f"{tmp_dir}/pp"
    tables.publish(spark.range(100).select("id", (F.col("id") % 4).alias("day")), root, partition_by=["day"])
    plan = tables.read(spark, root).filter("day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "= 2)" in plan


def test_promo_filter_pushed_to_parquet(spark, tmp_dir):
    path = f"{tmp_dir}/promo"
    spark.createDataFrame([("SAVE1", Decimal("1.00"), Decimal("1.00"), 1, "o")],
                          "promo_code string, discount_amt_usd decimal(18,2), total_amount_usd decimal(18,2), "
                          "loyalty_points int, order_id string").write.parquet(path)
    plan = gold.promo_analysis(spark.read.parquet(path), audit=False)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(promo_code)]" in plan


def test_control_table(spark, tmp_dir):
    from ledgerline.streaming import watermark
    source, control = f"{tmp_dir}/src", f"{tmp_dir}/control"
    assert watermark.pending(spark, source, control, "p") == []
    for i in (1, 2, 3):
        # arrival times play no part: a batch without any, or committed late, is found by its id
        tables.append(spark.createDataFrame([(i, None)], "id int, _ingestion_timestamp timestamp"), source, f"s-{i:06d}")
    assert watermark.pending(spark, source, control, "p", upto="s-000002") == ["s-000001", "s-000002"]
    watermark.advance(spark, control, "p", ["s-000002"])
    watermark.advance(spark, control, "other", ["s-000001", "s-000003"])
    assert watermark.pending(spark, source, control, "p") == ["s-000001", "s-000003"]
    watermark.advance(spark, control, "p", ["s-000002"])                 # recorded once
    assert watermark.processed(spark, control, "p") == {"s-000002"}


def test_zorder_of_text_lets_filters_skip_files(spark, tmp_dir):
    root = f"{tmp_dir}/zs"
    df = spark.range(20000).select("id", F.concat(F.lit("c"), F.lpad((F.col("id") * 7919 % 50).cast("string"), 2, "0")).alias("country"))
    tables.publish(df, root, files=16)
    size = maintenance.table_health(spark, tables.version_path(root, 1)).first()["size_bytes"]
    maintenance.compact(spark, root, target_bytes=size // 16, zorder_by=["country", "id"])
    before, after = (maintenance.files_to_read(spark, root, "country", "c07", v) for v in (1, 2))
    assert before == 16 and after <= 8


def test_partitioned_compaction_keeps_rows_and_partitions(spark, tmp_dir):
    root = f"{tmp_dir}/pc"
    # one "day" holds most rows (a hot partition value)
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, F.lit(0)).otherwise(F.col("id") % 7).alias("day"),
                                  (F.col("id") % 13).alias("g"))
    tables.publish(df, root, partition_by=["day"])
    report = maintenance.compact(spark, root, zorder_by=["day", "g"]).first()
    assert report["clustered_by"] == "g"                      # the partition column is dropped from Z-order
    assert rows(tables.read(spark, root).select("id", "day", "g")) == rows(df)
    h = maintenance.table_health(spark, tables.version_path(root, report["version_after"])).first()
    assert h["partition_columns"] == ["day"]


def test_gathered_versions_shuffle_nothing(spark, tmp_dir):
    root = f"{tmp_dir}/g"
    df = spark.range(3000).select("id", F.concat(F.lit("x"), "id").alias("t"))
    tables.publish(df, root, files=12, deal_by=["id"])
    for files in (5, 2, 4):             # the last one has more files than the version before: dealt anew
        version = tables.gather(spark, root, files)
        assert maintenance.table_health(spark, tables.version_path(root, version)).first()["num_files"] == files
        assert rows(tables.read(spark, root, version)) == rows(df)


def test_columns_of_the_gold_jobs_are_enough():
    from ledgerline.operators import dedup
    from ledgerline.plans import gold_jobs
    assert {*dedup.IDENTITY, "order_id", "loyalty_points", "customer_email"} <= gold_jobs.NEEDED
    assert "payment_method" not in gold_jobs.NEEDED and "vat_amount_usd" not in gold_jobs.NEEDED


def test_a_batch_that_changes_no_winner_adds_no_delta(spark, tmp_dir):
    root = f"{tmp_dir}/lake"
    delta.append_batch(root, _batch(spark, B2[:2], "f1"), "s-000001", LOGS)
    delta.append_batch(root, _batch(spark, B1[:2], "f0"), "s-000002", LOGS)        # earlier copies, all lose
    assert tables.read_appended(spark, f"{root}/log/country_day", only=["s-000002"]).count() == 0
    assert rows(_country(spark, root)) == rows(_rebuilt(_batch(spark, B1[:2], "f0"), _batch(spark, B2[:2], "f1")))
