"""What steps leave on disk, and steps that go through large tables in portions."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup, gold, joins, maintenance
from ledgerline.plans import gold_merge, stored, tables
from ledgerline.streaming import delta
from test_gold_merge import FIRST, SECOND, check_all, frame
from test_layout import lines
from tests_support import rows


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in dirs for _, _, fs in os.walk(top.getPath()) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    df = spark.range(20_000).withColumn("k", F.col("id") % 7)
    before, conf = shuffle_files(spark), spark.conf.get(joins.FREE_CONF, None)
    tables.publish(df.repartition(4, "k").groupBy("k").agg(F.sum("id").alias("s")), f"{tmp_dir}/t", files=3)
    tables.append(df, f"{tmp_dir}/a", "1", ["k"])
    stored.create_or_merge(df.withColumn("v", F.lit(1)).repartition(5), f"{tmp_dir}/m", ["id"], hashed=3)
    stored.create_or_merge(df.withColumn("v", F.lit(2)).repartition(5), f"{tmp_dir}/m", ["id"], hashed=3)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(joins.FREE_CONF, None) == conf
    assert rows(tables.read(spark, f"{tmp_dir}/t")) == rows(df.groupBy("k").agg(F.sum("id").alias("s")))


def test_staged_for_a_block(spark):
    with joins.staged_while([spark.range(5), spark.range(5, 9)], "block") as df:
        assert sorted(r.id for r in df.collect()) == list(range(9))
        path = df.inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(path)


@pytest.mark.parametrize("files, portion", [(22, 1 << 40), (22, 4_000), (3, 4_000), (None, 4_000)])
def test_marked_in_portions(spark, tmp_dir, monkeypatch, files, portion):
    monkeypatch.setattr(dedup, "PORTION_BYTES", portion)
    df = dedup.staged(lines(spark).withColumn("_source_file", F.when(F.col("_source_row") % 3 > 0, F.col("_source_file"))), "portions")
    broadcast = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        with dedup.marked_while(df, parts=files) as marked:
            assert (len(marked) > 1) == (portion < 1 << 40)
            tables.publish(marked, tmp_dir)
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast)
    got = tables.read(spark, tmp_dir)
    assert rows(got) == rows(dedup.mark_duplicates(df, stage=False))
    assert files is None or len(got.inputFiles()) == files


def test_batches_merged_in_portions(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(stored, "GROUP_BYTES", 2_000)
    written, real = [], joins.write_parts

    def seen(parts, path, partition_by=()):
        written.append((path, len(parts) if isinstance(parts, list) else 1))
        real(parts, path, partition_by)
    monkeypatch.setattr(gold_merge, "write_parts", seen)
    monkeypatch.setattr(stored, "write_parts", seen)
    a, b = frame(spark, FIRST), frame(spark, SECOND)
    for name, batch in (("1", a), ("2", b)):
        gold_merge.merge_batch(spark, tmp_dir, batch, name, hashed=4, grain="day")
    check_all(spark, tmp_dir, a, b)
    assert dict(written)[f"{tmp_dir}/changes/2"] > 1 and dict(written)[f"{tmp_dir}/silver__merge/rows"] > 1


def test_a_merge_that_died_between_portions_changes_nothing(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(stored, "GROUP_BYTES", 1)
    old = spark.range(100).withColumn("v", F.lit("old"))
    stored.create_or_merge(old, f"{tmp_dir}/m", ["id"], hashed=4)
    dies = F.udf(lambda i: 1 // 0 if i == 7 else "new")
    with pytest.raises(Exception):
        real = joins.write_parts
        monkeypatch.setattr(stored, "write_parts", lambda parts, *a: real(parts if len(parts) == 1 else [*parts[:-1], parts[-1].withColumn("v", dies(F.lit(7)))], *a))
        stored.create_or_merge(spark.range(100).withColumn("v", F.lit("new")), f"{tmp_dir}/m", ["id"], hashed=4)
    monkeypatch.setattr(stored, "write_parts", real)
    assert os.listdir(f"{tmp_dir}/m__merge/rows") and not stored.exists(spark, f"{tmp_dir}/m__merge/rows")
    stored._carry(spark, f"{tmp_dir}/m", ["id"])
    assert rows(stored.read(spark, f"{tmp_dir}/m")) == rows(old)
    stored.create_or_merge(spark.range(50).withColumn("v", F.lit("new")), f"{tmp_dir}/m", ["id"], hashed=4)
    assert rows(stored.read(spark, f"{tmp_dir}/m")) == rows(old.withColumn("v", F.when(F.col("id") < 50, "new").otherwise("old")))


def test_deltas_in_groups_of_buckets(spark, tmp_dir, monkeypatch):
    written, real = [], joins.write_parts
    monkeypatch.setattr(stored, "GROUP_BYTES", 2_000)
    monkeypatch.setattr(delta, "write_parts", lambda parts, *a: (written.append(len(parts)), real(parts, *a)))
    a, b = frame(spark, FIRST), frame(spark, SECOND)
    for name, batch in (("s-1", a), ("s-2", b), ("s-3", a.limit(0)), ("s-1", a)):
        delta.append_batch(tmp_dir, batch, name)
    assert written[1] > 1
    silver = dedup.keep_best(a.unionByName(b))
    got = delta.gold_tables(spark, tmp_dir)
    for name, want in (("daily_product_revenue", gold.daily_product_revenue(silver, audit=False)),
                       ("customer_purchase_frequency", gold.customer_purchase_frequency(silver, audit=False))):
        assert rows(got[name].select(*want.columns)) == rows(want), name


def test_z_order_in_portions(spark, tmp_dir, monkeypatch):
    df = spark.range(4_000).select((F.col("id") % 2).cast("int").alias("p"), "id", (F.col("id") * 7919 % 4001).alias("x"))
    tables.publish(df, tmp_dir, partition_by=["p"])
    size = maintenance.table_health(spark, tables.version_path(tmp_dir, 1)).first()["size_bytes"]
    monkeypatch.setattr(maintenance, "PORTION_BYTES", size // 3)
    maintenance.compact(spark, tmp_dir, target_bytes=size // 9, zorder_by=["x"])
    got = tables.read(spark, tmp_dir)
    assert rows(got.select("p", "id", "x")) == rows(df)
    ranges = got.groupBy("p", F.col("_metadata.file_path").alias("f")).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    assert len(ranges) > 6
    for p in (0, 1):      # the files of a partition do not overlap by more than the buckets of the order
        own = sorted(((r.lo, r.hi) for r in ranges if r.p == p), key=lambda r: r[::-1])
        assert len(own) > 3 and all(b[0] >= a[1] - 2 * 4001 // 256 for a, b in zip(own, own[1:]))
