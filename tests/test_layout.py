"""Group sizes, file verdicts, written order, Z-order inside partitions, bucketed catalog tables, inferred types."""

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup, maintenance
from ledgerline.plans import catalog, tables
from ledgerline.sources import infer
from tests_support import rows


def lines(spark, n=2000, hot=1200):
    """``hot`` copies of one order, some lines without an order id, the rest single or double."""
    return spark.range(n).select(
        F.when(F.col("id") < hot, F.lit("HOT")).when(F.col("id") % 50 == 0, None)
         .otherwise(F.concat(F.lit("o"), (F.col("id") / 2).cast("long").cast("string"))).alias("order_id"),
        F.lit(1).alias("line_number"), F.lit("f").alias("_source_file"), F.col("id").alias("_source_row"),
        F.lit("completed").alias("payment_status"), F.timestamp_seconds(F.col("id")).alias("order_timestamp"))


def test_copies_of_hot_and_missing_keys(spark):
    df = dedup.staged(lines(spark), "copies_test")
    out = dedup.with_copies(df)
    assert out.columns == [*df.columns, "_copies"]
    got = {r._source_row: (r.order_id, r._copies) for r in out.collect()}
    assert len(got) == 2000
    ids = {i: o for i, (o, _) in got.items()}
    for i, (order, n) in got.items():
        assert n == (1 if order is None else sum(o == order for o in ids.values()) if order != "HOT" else 1200)
    # the rows of the hot key meet its count under several salts, not in one task
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text and "Window" not in text
    assert dedup.with_copies(df.limit(0)).count() == 0


def test_copies_without_sorting_sets(spark):
    """The salts of a key are bits of a hash aggregate's number, up to the highest."""
    df = dedup.staged(lines(spark), "copies_bits")
    out = dedup.with_copies(df)
    assert "ObjectHashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    for salts in (1, 64):
        n = {r._copies: r["count"] for r in dedup.with_copies(df, salts=salts).groupBy("_copies").count().collect()}
        assert n[1200] == 1200 and sum(n.values()) == 2000
    with pytest.raises(ValueError):
        dedup.with_copies(df, salts=65)


def test_staged_writes_long_projections_compiled(spark):
    from ledgerline.operators import joins
    before = spark.conf.get(joins.METHOD_CONF)
    spark.conf.set(joins.METHOD_CONF, "60000")
    try:
        assert dedup.staged(spark.range(3), "limit_test").count() == 3
        assert spark.conf.get(joins.METHOD_CONF) == "60000"
    finally:
        spark.conf.set(joins.METHOD_CONF, before)


def test_written_order_and_verdict_limits(spark, tmp_dir):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v"))
    tables.publish(df, f"{tmp_dir}/t", sort_within=["k"], files=3)
    good = maintenance.written_order(spark, tables.version_path(f"{tmp_dir}/t", 1), ["k"]).collect()
    assert len(good) == 3 and sum(r.rows for r in good) == 1000 and all(r.out_of_order == 0 for r in good)
    bad = maintenance.written_order(spark, tables.version_path(f"{tmp_dir}/t", 1), ["v"]).collect()
    assert any(r.out_of_order > 0 for r in bad)
    path = tables.version_path(f"{tmp_dir}/t", 1)
    for limits, verdicts in ((dict(files_warn=3, files_bad=5), "ok"), (dict(files_warn=2, files_bad=3), "warn"), (dict(files_warn=1, files_bad=2), "bad")):
        assert maintenance.table_health(spark, path, **limits).first()["file_count_verdict"] == verdicts
    size = maintenance.table_health(spark, path).first()["size_bytes"]
    assert maintenance.table_health(spark, path, size_min=1, size_max=2).first()["file_size_verdict"] == "warn"
    assert maintenance.table_health(spark, path, size_min=1, size_max=size).first()["file_size_verdict"] == "ok"


def test_zorder_inside_partitions(spark, tmp_dir):
    """Files of one partition value do not overlap in the leading clustering value, and a hot partition has many files."""
    df = spark.range(40000).select(F.when(F.col("id") % 10 == 0, "small").otherwise("big").alias("p"),
                                   (F.col("id") * 7919 % 1000).alias("x"), F.xxhash64("id").alias("pad"))
    root = f"{tmp_dir}/z"
    tables.publish(df.repartition(6), root, partition_by=["p"], rebalance=False)
    size = maintenance.table_health(spark, tables.version_path(root, 1)).first()["size_bytes"]
    maintenance.compact(spark, root, target_bytes=size // 12, zorder_by=["x"])
    files = (tables.read(spark, root).groupBy("p", F.col("_metadata.file_path").alias("f"))
             .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n")).collect())
    assert sum(r.n for r in files) == 40000
    big = sorted((r.lo, r.hi) for r in files if r.p == "big")
    assert len(big) >= 8 and all(a[1] - b[0] <= 8 for a, b in zip(big, big[1:]))      # one quantile bucket at most
    assert tables.partition_columns(spark, tables.version_path(root, 2)) == ["p"]
    assert maintenance.files_to_read(spark, root, "x", 500, 2) < maintenance.files_to_read(spark, root, "x", 500, 1)


def test_zorder_of_texts_with_a_common_start(spark):
    df = spark.range(4000).select(F.format_string("COUNTRY_%02d", F.col("id") * 7919 % 40).alias("c"), "id")
    z = maintenance.with_zorder(df.union(spark.createDataFrame([(None, 1)], "c string, id long")), ["c"])
    order = {r.c: (r.lo, r.hi) for r in z.groupBy("c").agg(F.min("_z").alias("lo"), F.max("_z").alias("hi")).collect()}
    ranked = [order[c] for c in sorted(k for k in order if k)]
    assert len(ranked) == 40 and all(lo == hi for lo, hi in ranked)
    assert [lo for lo, _ in ranked] == sorted({lo for lo, _ in ranked}) and order[None][0] == 0


@pytest.fixture()
def database(spark):
    name = f"orders_{uuid.uuid4().hex[:8]}"
    yield name
    catalog.drop_database(spark, name)


def test_bucketed_table_needs_no_exchange(spark, tmp_dir, database):
    df = dedup.staged(lines(spark), "bucket_test")
    table = catalog.save_lines(df, database, "lines", f"{tmp_dir}/lines", buckets=8)
    best = catalog.best_lines(spark, table)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    cols = ["order_id", "_source_row"]
    assert rows(best.select(*cols)) == rows(dedup.keep_best(df).select(*cols))
    batch = df.filter("_source_row % 100 = 7")
    found = catalog.lines_of_batch(spark, table, batch)
    text = found._jdf.queryExecution().executedPlan().toString()
    stored = [line for line in text.splitlines() if "Bucketed: true" in line]
    assert len(stored) == 1
    orders = {r.order_id for r in batch.collect()} - {None}
    assert rows(found.select(*cols)) == rows(df.filter(F.col("order_id").isin(list(orders))).select(*cols))
    assert spark.catalog.tableExists(table)
    catalog.drop_database(spark, database)
    assert not spark.catalog.databaseExists(database)
    assert spark.read.parquet(f"{tmp_dir}/lines").count() == 2000      # the files are the folder's


def types(p):
    return {r.column: r.type for r in infer.with_types(p).collect()}


def test_type_lattice(spark):
    old = spark.createDataFrame([("1", "2024-01-05", "7", "", "00123", "9" * 12, "x"), (" 20 ", "2024-02-30", "-3", None, "5", "1", "1"),
                                 (None, "2024-03-01", "", "  ", "6", "2", "")],
                                "a string, b string, c string, d string, e string, f string, _g string")
    assert types(infer.profile(old)) == {"a": "int", "b": "string", "c": "int", "d": "void", "e": "string", "f": "bigint"}
    new = spark.createDataFrame([("1.25", "2024-01-05", "2024-01-05", "4")], "a string, b string, c string, d string")
    assert types(infer.profile(new)) == {"a": "decimal(3,2)", "b": "timestamp", "c": "timestamp", "d": "int"}
    merged = infer.merge(infer.profile(old), infer.profile(new))
    # whole numbers and decimals meet in a decimal wide enough for both, numbers and timestamps in text
    want = {"a": "decimal(4,2)", "b": "string", "c": "string", "d": "int", "e": "string", "f": "bigint"}
    assert types(merged) == want
    assert types(infer.merge(infer.profile(new), infer.profile(old))) == want
    cast = infer.typed(old, want)
    assert dict(cast.dtypes)["a"] == "decimal(4,2)" and dict(cast.dtypes)["d"] == "int" and dict(cast.dtypes)["b"] == "string"
    assert [str(r.a) for r in cast.collect()] == ["1.00", "20.00", "None"]
    empty = infer.profile(old.limit(0))
    assert set(types(empty).values()) == {"void"}
    assert types(infer.merge(empty, infer.profile(new)))["a"] == "decimal(3,2)"
    assert infer.profile(old, []).count() == 0


def test_z_order_looks_numbers_up_without_a_tree_and_as_the_tree_did(spark):
    """Buckets by binary search equal those of the CASE tree, NULL, NaN and infinite values included; the plan has no tree."""
    from pyspark.sql import functions as F
    from ledgerline.operators import maintenance as M
    bounds = [float(k) for k in range(0, 510, 2)]
    values = [None, float("nan"), float("inf"), float("-inf"), -0.5, 0.0, 1.0, 2.0, 507.9, 508.0, 9e9] + [k / 3 for k in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    tree = F.when(F.col("x").isNull(), 0).otherwise(M._bucket(F.col("x"), bounds, 0, len(bounds)))
    got = M._with_buckets(df, {"x": "b"}, {"x": bounds}).withColumn("want", tree).collect()
    assert len(got) == len(values) and all(r.b == r.want for r in got)
    wide = M.with_zorder(spark.range(5000).select(F.col("id"), (F.col("id") % 977).cast("double").alias("v")), ["id", "v"])
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") < 20
    assert wide.agg(F.count_distinct("_z")).first()[0] > 1000
