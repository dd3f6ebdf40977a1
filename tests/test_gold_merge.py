"""Merging batches into stored, partitioned tables."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup, gold
from ledgerline.plans import gold_merge, stored
from tests_support import rows, srt

SCHEMA = ("order_id string, line_number int, order_timestamp timestamp, customer_email string, product_sku string, quantity int, "
          "country_code string, promo_code string, loyalty_points int, source_vendor string, total_amount_usd decimal(18,2), "
          "discount_amt_usd decimal(18,2), payment_status string, _ingestion_timestamp timestamp, _source_file string, _source_row long")


def line(order, day, status="completed", amount="10.00", sku="S1", promo=None, arrived=10, row=0, n=1, email="a@x", f="f"):
    t = datetime(2024, 1, day) if day else None
    return (order, n, t, email, sku, 1, "US", promo, 5 if promo else None, "vendor_a", Decimal(amount), None, status,
            datetime(2024, 2, arrived), f, row)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def silver_rebuilt(*frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return dedup.keep_best(out)


def check_all(spark, root, *frames):
    silver = silver_rebuilt(*frames)
    for m in gold_merge.MERGED:
        want = m.table.build(silver).drop("_updated_at")
        assert rows(gold_merge.table(spark, root, m.table.name).select(*want.columns)) == rows(want), m.table.name
    want = gold.top_products(silver, audit=False)
    assert rows(gold_merge.table(spark, root, gold_merge.TOP).select(*want.columns)) == rows(want)


FIRST = [line("A", 2, row=1), line("B", 3, "pending", row=2, promo="P1"), line("C", 9, row=3, sku="S2", email=None), line(None, 3, row=4),
         line(None, 3, row=4, n=2), line("D", None, row=5)]
# A moves to another day with another product (day 2, S1 of that day vanish), B loses its promotion
SECOND = [line("A", 1, "settled", "12.00", "S3", arrived=11, row=1, f="g"), line("B", 3, "settled", "11.00", arrived=11, row=2, f="g"),
          line("E", 3, row=3, f="g"), line(None, 1, row=4, f="g")]


def test_batches_equal_a_rebuild(spark, tmp_dir):
    a, b = frame(spark, FIRST), frame(spark, SECOND)
    gold_merge.merge_batch(spark, tmp_dir, a, "1", hashed=4, grain="day")
    check_all(spark, tmp_dir, a)
    day9 = files_of(f"{tmp_dir}/daily_revenue_by_vendor/_part=2024-01-09")
    touched = gold_merge.merge_batch(spark, tmp_dir, b, "2", hashed=4, grain="day")
    check_all(spark, tmp_dir, a, b)
    assert touched["daily_revenue_by_vendor"] == [f"_part=2024-01-0{d}" for d in (1, 2, 3)]
    assert day9 and files_of(f"{tmp_dir}/daily_revenue_by_vendor/_part=2024-01-09") == day9     # not written again
    assert not os.path.exists(f"{tmp_dir}/daily_revenue_by_vendor/_part=2024-01-02")            # vanished
    before = {n: files_of(f"{tmp_dir}/{n}") for n in gold_merge.names()}
    assert gold_merge.merge_batch(spark, tmp_dir, b, "2", hashed=4, grain="day") is None                           # a finished batch
    assert gold_merge.merge_batch(spark, tmp_dir, a, "1", hashed=4, grain="day") is None
    assert {n: files_of(f"{tmp_dir}/{n}") for n in gold_merge.names()} == before
    gold_merge.merge_batch(spark, tmp_dir, b, "again", hashed=4, grain="day")                                      # the same lines under another id
    check_all(spark, tmp_dir, a, b)
    gold_merge.merge_batch(spark, tmp_dir, b.limit(0), "nothing", hashed=4, grain="day")
    check_all(spark, tmp_dir, a, b)


def test_a_batch_that_died_is_finished(spark, tmp_dir, monkeypatch):
    a, b = frame(spark, FIRST), frame(spark, SECOND)
    gold_merge.merge_batch(spark, tmp_dir, a, "1", hashed=4, grain="day")
    real, calls = stored._carry, []

    def dies(spark, path, keys, after):
        calls.append(path)
        if len(calls) == after:
            raise RuntimeError("killed")
        real(spark, path, keys)
    for after in (1, 6):
        calls.clear()
        monkeypatch.setattr(stored, "_carry", lambda s, p, k, after=after: dies(s, p, k, after))
        with pytest.raises(RuntimeError):
            gold_merge.merge_batch(spark, tmp_dir, b, "2", hashed=4, grain="day")
    monkeypatch.setattr(stored, "_carry", real)
    gold_merge.merge_batch(spark, tmp_dir, b, "2", hashed=4, grain="day")
    check_all(spark, tmp_dir, a, b)


def test_merge_some_columns_and_new_ones(spark, tmp_dir):
    d = date(2024, 1, 1)
    first = spark.createDataFrame([("a", d, 1, 1), (None, None, 2, 2)], "k string, d date, x int, y int")
    stored.create_or_merge(first, f"{tmp_dir}/t", ["k", "d"], F.col("d"))
    second = spark.createDataFrame([("a", d, 10, 10, "n"), (None, None, 20, 20, "n"), ("c", d, 30, 30, "n")], "k string, d date, x int, y int, z string")
    assert len(stored.create_or_merge(second, f"{tmp_dir}/t", ["k", "d"], F.col("d"), update_cols=["x"])) == 2
    got = stored.read(spark, f"{tmp_dir}/t")
    assert rows(got, "k", "x", "y", "z") == srt([("a", 10, 1, None), (None, 20, 2, None), ("c", 30, 30, "n")])
    with pytest.raises(ValueError, match="date or an integer"):
        stored.create_or_merge(first, f"{tmp_dir}/u", ["k"], F.col("k"))


def test_only_touched_folders_are_read(spark, tmp_dir):
    days = spark.range(20).select(F.concat(F.lit("k"), "id").alias("k"), F.expr("date_add(date'2024-01-01', CAST(id AS INT))").alias("d"), F.col("id").alias("x"))
    stored.create_or_merge(days, f"{tmp_dir}/t", ["k", "d"], F.col("d"))
    plan = stored.read(spark, f"{tmp_dir}/t", [date(2024, 1, 3), None])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan and "_part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    before = files_of(f"{tmp_dir}/t")
    one = days.filter("id = 2").withColumn("x", F.lit(99))
    assert stored.create_or_merge(one, f"{tmp_dir}/t", ["k", "d"], F.col("d")) == ["_part=2024-01-03"]
    after = files_of(f"{tmp_dir}/t")
    assert {p.split("/")[-2] for p in set(before) ^ set(after)} == {"_part=2024-01-03"}


def test_merged_folders_are_moved_and_a_half_moved_merge_is_finished(spark, tmp_dir, monkeypatch):
    days = spark.range(6).select(F.col("id").alias("k"), F.expr("date_add(date'2024-01-01', CAST(id AS INT))").alias("d"), F.col("id").alias("x"))
    stored.create_or_merge(days, f"{tmp_dir}/t", ["k", "d"], F.col("d"))
    source, touched = days.filter("k IN (1, 2)").withColumn("x", F.lit(99).cast("long")), days.filter("k < 4").select("k", "d")
    real, moved = stored._move, []

    def dies(spark, a, b):
        if moved:
            raise RuntimeError("killed")
        real(spark, a, b)
        moved.append(b)
    monkeypatch.setattr(stored, "_move", dies)
    with pytest.raises(RuntimeError):
        stored.create_or_merge(source, f"{tmp_dir}/t", ["k", "d"], F.col("d"), touched=touched)
    monkeypatch.setattr(stored, "_move", real)
    stored.create_or_merge(days.limit(0), f"{tmp_dir}/t", ["k", "d"], F.col("d"))
    assert rows(stored.read(spark, f"{tmp_dir}/t"), "k", "x") == [(1, 99), (2, 99), (4, 4), (5, 5)]
    assert not os.path.exists(f"{tmp_dir}/t__merge")


def test_changes_of_a_finished_batch_are_removed(spark, tmp_dir):
    gold_merge.merge_batch(spark, tmp_dir, frame(spark, FIRST), "1", hashed=4)
    assert not os.path.exists(f"{tmp_dir}/changes/1")
