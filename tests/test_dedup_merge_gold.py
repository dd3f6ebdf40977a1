"""Dedup rules, MERGE semantics and Gold aggregates on small fixtures (FIXTURES.md §5-6)."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup, gold, merge
from tests_support import rows, srt

DEDUP_SCHEMA = ("order_id string, line_number int, payment_status string, order_timestamp timestamp, "
                "total_amount_usd decimal(18,2), _source_file string, _source_row long")


def dedup_fixture(spark):
    t = lambda d: datetime(2024, 1, d) if d else None
    data = [
        ("D1", 1, "pending", t(3), Decimal("1"), "f", 1),
        ("D1", 1, "settled", t(1), Decimal("2"), "f", 2),
        ("D1", 1, "completed", t(2), Decimal("3"), "f", 3),
        ("D2", 1, "completed", t(1), Decimal("4"), "f", 4),
        ("D2", 1, "completed", t(2), Decimal("5"), "f", 5),
        ("D3", 1, "refunded", t(1), Decimal("6"), "f", 6),
        ("D3", 1, "completed", t(2), Decimal("7"), "f", 7),
        ("D4", 1, None, None, Decimal("8"), "f", 8),
        (None, 1, "completed", t(1), Decimal("9"), "f", 9),
        (None, 1, "completed", t(1), Decimal("9"), "f", 10),
    ]
    return spark.createDataFrame(data, DEDUP_SCHEMA)


def test_mark_duplicates_fixture(spark):
    m = dedup.mark_duplicates(dedup_fixture(spark))
    kept = rows(m.filter(~F.col("_is_duplicate")), "order_id", "_source_row")
    assert kept == srt([("D1", 2), ("D2", 5), ("D3", 7), ("D4", 8), (None, 9), (None, 10)])
    assert m.filter("_is_duplicate AND _duplicate_reason IS NULL").count() == 0
    assert m.count() == 10


def test_keep_best_matches_mark(spark):
    df = dedup_fixture(spark)
    a = rows(dedup.keep_best(df), "order_id", "_source_row")
    b = rows(dedup.mark_duplicates(df).filter("NOT _is_duplicate"), "order_id", "_source_row")
    assert a == b


def test_lines_of_one_source_row_are_told_apart(spark):
    """Two items of one JSON order share file and row: without an order id both stay, with one a single line wins."""
    t = datetime(2024, 1, 1)
    data = [(None, 1, "completed", t, Decimal("1"), "f", 1), (None, 2, "completed", t, Decimal("2"), "f", 1),
            ("D1", 1, "settled", t, Decimal("3"), "f", 2), ("D1", 2, "settled", t, Decimal("4"), "f", 2), ("D1", 1, "pending", t, Decimal("5"), "f", 3)]
    df = spark.createDataFrame(data, DEDUP_SCHEMA)
    kept = rows(dedup.keep_best(df, keys=["order_id"]), "order_id", "line_number", "_source_row")
    marked = rows(dedup.mark_duplicates(df, keys=["order_id"]).filter("NOT _is_duplicate"), "order_id", "line_number", "_source_row")
    assert kept == marked == srt([(None, 1, 1), (None, 2, 1), ("D1", 1, 2)])


def test_winner_independent_of_input_order(spark):
    df = dedup_fixture(spark)
    shuffled = df.repartition(7).orderBy(F.rand(3))
    assert rows(dedup.keep_best(df)) == rows(dedup.keep_best(shuffled))


def test_hot_key_exactly_one_winner(spark):
    # one order line arriving 20,000 times (a hot key) next to 5,000 single lines
    hot = spark.range(20000).select(F.lit("HOT").alias("order_id"), F.lit(1).alias("line_number"),
                                    F.lit("completed").alias("payment_status"),
                                    (F.lit(datetime(2024, 1, 1)).cast("timestamp")).alias("order_timestamp"),
                                    F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("total_amount_usd"),
                                    F.lit("f").alias("_source_file"), F.col("id").alias("_source_row"))
    other = spark.range(5000).select(F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"),
                                     F.lit(1).alias("line_number"), F.lit("completed").alias("payment_status"),
                                     F.lit(datetime(2024, 1, 1)).cast("timestamp").alias("order_timestamp"),
                                     F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("total_amount_usd"),
                                     F.lit("g").alias("_source_file"), F.col("id").alias("_source_row"))
    m = dedup.mark_duplicates(hot.unionByName(other).repartition(8))
    assert m.filter("order_id = 'HOT' AND NOT _is_duplicate").collect()[0]["_source_row"] == 0
    assert m.filter("NOT _is_duplicate").count() == 5001
    assert m.count() == 25000


def test_plans_have_no_python_and_limit_before_shuffle(spark):
    df = dedup_fixture(spark)
    plan = dedup.keep_best(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    full = dedup.keep_best(df)._jdf.queryExecution().toString()
    assert "Partial" in full and "EvalPython" not in full


def test_upsert_fixture_null_safe(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 99)], "k string, v int")
    out = merge.upsert(target, source, ["k"])
    assert rows(out) == srt([("a", 1), ("b", 20), ("c", 30), (None, 99)])
    assert rows(merge.upsert(out, source, ["k"])) == rows(out)       # idempotent


def test_upsert_subset_keeps_other_columns(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, note string")
    source = spark.createDataFrame([("b", 20, "new"), ("c", 30, "new")], "k string, v int, note string")
    out = merge.upsert(target, source, ["k"], update_cols=["v"])
    assert rows(out) == [("a", 1, "old"), ("b", 20, "old"), ("c", 30, "new")]


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int")
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(target, source, ["k"], check_unique=True)


def test_replace_keys_drops_vanished_keys(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    touched = spark.createDataFrame([("b",), (None,)], "k string")
    recomputed = spark.createDataFrame([(None, 4)], "k string, v int")
    assert rows(merge.replace_keys(target, recomputed, touched, ["k"]), "k", "v") == srt([("a", 1), (None, 4)])


def _lines(spark, data):
    return spark.createDataFrame(data, "order_id string, order_timestamp timestamp, source_vendor string, "
                                       "total_amount_usd decimal(18,2), discount_amt_usd decimal(18,2), "
                                       "product_sku string, promo_code string, loyalty_points int, "
                                       "customer_email string, payment_status string")


def test_revenue_grains(spark):
    d = datetime(2024, 1, 15)
    # vendor C repeats the order total (43.34) on each of the order's two lines
    df = _lines(spark, [("C1", d, "vendor_c", Decimal("43.34"), None, "S1", None, None, "q", "settled"),
                        ("C1", d, "vendor_c", Decimal("43.34"), None, "S2", None, None, "q", "settled"),
                        ("C9", d, "vendor_c", Decimal("10.00"), None, "S1", None, None, "q", "pending")])
    row = gold.daily_revenue_by_vendor(df, audit=False).first()
    assert (row["total_amount_usd"], row["order_count"], row["avg_order_value_usd"]) == \
        (Decimal("96.68"), 3, Decimal("32.23"))
    order = gold.daily_revenue_by_vendor(df, grain="order", audit=False).first()
    assert (order["total_amount_usd"], order["order_count"]) == (Decimal("53.34"), 2)
    settled = gold.daily_revenue_by_vendor(df, statuses=["settled"], audit=False).first()
    assert settled["order_count"] == 2


def test_top_products_and_promo(spark):
    d = datetime(2024, 1, 15)
    df = _lines(spark, [(f"O{i}", d, "vendor_a", Decimal(i), Decimal("1.00") if i % 2 else None, f"S{i % 13}",
                         "SAVE10" if i % 3 == 0 else None, i, "e", "completed") for i in range(1, 60)])
    top = gold.top_products(df, n=10, audit=False)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    got = top.collect()
    assert len(got) == 10 and got[0]["total_amount_usd"] >= got[-1]["total_amount_usd"]
    p = gold.promo_analysis(df, audit=False).first()
    assert p["promo_code"] == "SAVE10" and p["usage_count"] == 19
    assert p["total_loyalty_points_awarded"] == sum(range(3, 60, 3))


def test_changed_winners_leave_out_what_stays(spark):
    from ledgerline.operators import dedup
    cols = "order_id string, line_number int, order_timestamp string, payment_status string, _source_file string, _source_row long"
    old = spark.createDataFrame([("a", 1, "2024-01-02", "settled", "f", 1), ("b", 1, "2024-01-02", "pending", "f", 2),
                                 ("c", 1, "2024-01-02", "pending", "f", 3), ("e", 1, "2024-01-02", "pending", "f", 5)], cols)
    new = spark.createDataFrame([("a", 1, "2024-01-02", "pending", "g", 1), ("b", 1, "2024-01-02", "settled", "g", 2),
                                 ("c", 1, "2024-01-02", "pending", "f", 3), ("d", 1, "2024-01-02", "pending", "g", 4)], cols)
    got = sorted((r["order_id"], r["_source_file"], r["_wins"]) for r in dedup.changed_winners(new, old).collect())
    assert got == [("b", "f", False), ("b", "g", True), ("d", "g", True)]
    # the result lies by the keys: no exchange is added to join on them
    best = dedup.keep_best(new, whole_keys=True)
    assert best.join(old.select("order_id", "line_number").distinct().hint("merge"), ["order_id", "line_number"], "left_semi").count() == 3
