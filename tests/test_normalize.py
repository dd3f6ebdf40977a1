"""Vendor normalisers on the hand-written fixture files (FIXTURES.md §1-3)."""

import csv
import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import dedup, normalize
from ledgerline.sources import files
from tests_support import rows

A_V1 = """order_id,order_date,customer_email,product_sku,quantity,unit_price,total_amount,payment_method
A1,01/15/2024,x@y.com,WIDGET-500,2,10.50,21.00,google_pay
A2,02/28/2024,,GADGET-X1,1,5.00,5.00,visa
A2,02/28/2024,,GADGET-X1,1,5.00,5.00,visa
A9,2024-13-01,x@y.com,GADGET-X1,1,5.00,5.00,visa
"""
A_V2 = """order_id,order_date,email,product_sku,quantity,unit_price,total_amount,payment_method,promo_code,discount_pct,loyalty_points
A3,01/30/2024,z@y.com,WIDGET-500,2,10.50,21.00,apple_pay,SAVE10,10,5
"""
B = """order_id|order_date|customer_email|product_code|quantity|unit_price|total_amount|vat_amount|payment_method|country_code
B1|15-01-2024|x@y.com|WID500|2|€24,99|€49,98|€8,33|carte_bancaire|FR
B2|03-02-2024|x@y.com|GADX1|1|€1.234,50|€1.234,50|€200,00|paypal|DE
B3|04-02-2024||ZZZ9|1|24.99|24.99||paypal|IT
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def write_vendor_c(path):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    cust_jp = json.dumps({"email": "q@r.jp", "country": "JP"})
    items = json.dumps([{"sku": "S1", "qty": 1, "price": 1500}, {"sku": "S2", "qty": 2, "price": 2500.5}])
    recs = [
        ["C1", "2024-01-15T10:30:00Z", cust_jp, items,
         json.dumps({"method": "konbini", "currency": "JPY", "amount": 6501, "status": "pending"})],
        ["C1", "2024-01-15T10:30:00Z", cust_jp, items,
         json.dumps({"method": "konbini", "currency": "JPY", "amount": 6501, "status": "settled"})],
        ["C2", "2024-01-16T10:30:00Z", json.dumps({"email": "q@r.kr", "country": "KR"}), "[]",
         json.dumps({"method": "card", "currency": "KRW", "amount": 13200, "status": "completed"})],
        ["C3", "2024-01-17T10:30:00Z", json.dumps({"country": "SG"}),
         json.dumps([{"sku": "S1", "qty": 1, "price": 20}]),
         json.dumps({"method": "card", "currency": "SGD", "amount": 20, "status": "Settled"})],
        ["C4", "2024-01-18T10:30:00Z", "not json", "",
         json.dumps({"method": "card", "currency": "JPY", "amount": 150, "status": "completed"})],
    ]
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, delimiter="\t", quotechar='"', doublequote=True, quoting=csv.QUOTE_MINIMAL)
        w.writerow(["order_number", "created_at", "customer_info", "line_items", "payment_details"])
        w.writerows(recs)


def vendor_a_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/a/orders_1.csv", A_V1)
    _write(f"{tmp_dir}/a/orders_2.csv", A_V2)
    return normalize.vendor_a(files.read_vendor_a(spark, f"{tmp_dir}/a/orders*.csv"))


def test_vendor_a_fixture(spark, tmp_dir):
    df = vendor_a_lines(spark, tmp_dir)
    got = {r["order_id"]: r for r in df.collect()}
    assert got["A3"]["discount_amt_usd"] == Decimal("2.10")
    assert got["A3"]["promo_code"] == "SAVE10" and got["A3"]["loyalty_points"] == 5
    assert got["A3"]["customer_email"] == "z@y.com"            # renamed column merged
    assert got["A1"]["discount_amt_usd"] is None
    assert got["A1"]["promo_code"] is None                      # R1: no positional shift
    assert got["A1"]["total_amount_usd"] == Decimal("21.00")
    assert got["A1"]["payment_method"] == "mobile_wallet"
    assert got["A3"]["payment_method"] == "mobile_wallet"
    assert got["A9"]["order_timestamp"] is None                 # bad date: NULL, no abort
    assert got["A1"]["country_code"] == "US" and got["A1"]["source_currency"] == "USD"
    assert got["A1"]["payment_status"] == "completed"
    assert df.count() == 5
    marked = dedup.mark_duplicates(df)
    assert marked.filter(F.col("_is_duplicate")).count() == 1   # the A2 copy


def test_vendor_b_fixture(spark, tmp_dir):
    _write(f"{tmp_dir}/b/orders_1.csv", B)
    df = normalize.vendor_b(files.read_vendor_b(spark, f"{tmp_dir}/b/*.csv"))
    got = {r["order_id"]: r for r in df.collect()}
    assert (got["B1"]["unit_price_usd"], got["B1"]["total_amount_usd"], got["B1"]["vat_amount_usd"]) == \
        (Decimal("27.16"), Decimal("54.33"), Decimal("9.05"))
    assert (got["B2"]["total_amount_usd"], got["B2"]["vat_amount_usd"]) == (Decimal("1341.85"), Decimal("217.39"))
    assert [got[k]["product_sku"] for k in ("B1", "B2", "B3")] == ["WIDGET-500", "GADGET-X1", "ZZZ9"]
    assert got["B1"]["payment_method"] == "bank_card"
    assert got["B3"]["vat_amount_usd"] is None and got["B3"]["total_amount_usd"] == Decimal("27.16")
    assert got["B1"]["exchange_rate"] == Decimal("0.920000")
    assert str(got["B1"]["order_timestamp"]).startswith("2024-01-15")


def test_vendor_c_fixture(spark, tmp_dir):
    write_vendor_c(f"{tmp_dir}/c/orders_1.tsv")
    bronze = files.read_vendor_c(spark, f"{tmp_dir}/c/*.tsv")
    df = normalize.vendor_c(bronze)
    c1 = rows(df.filter("order_id = 'C1'"), "line_number", "product_sku", "unit_price_usd",
              "total_amount_usd", "payment_status")
    assert c1 == [(1, "S1", Decimal("10.00"), Decimal("43.34"), "pending"),
                  (1, "S1", Decimal("10.00"), Decimal("43.34"), "settled"),
                  (2, "S2", Decimal("16.67"), Decimal("43.34"), "pending"),
                  (2, "S2", Decimal("16.67"), Decimal("43.34"), "settled")]
    c2 = df.filter("order_id = 'C2'").collect()
    assert len(c2) == 1 and c2[0]["product_sku"] is None and c2[0]["total_amount_usd"] == Decimal("10.00")
    c3 = df.filter("order_id = 'C3'").first()
    assert c3["exchange_rate"] == Decimal("1.000000") and c3["payment_status"] == "settled"
    c4 = df.filter("order_id = 'C4'").collect()
    assert len(c4) == 1 and c4[0]["customer_email"] is None and c4[0]["total_amount_usd"] == Decimal("1.00")
    marked = dedup.mark_duplicates(df)
    dups = rows(marked.filter("_is_duplicate"), "order_id", "line_number", "payment_status")
    assert dups == [("C1", 1, "pending"), ("C1", 2, "pending")]   # settled copy wins both lines
    assert marked.filter("_is_duplicate").select("_duplicate_reason").distinct().count() == 1


def test_money_parsing(spark):
    from ledgerline.functions.columns import with_money
    both = [("abc", None), (None, None), ("24.99", "24.99"), ("24.990", "24.99"), ("19.999", "20.00"), ("1.0E7", "10000000.00"),
            (" 7 ", "7.00"), ("-3.5", "-3.50"), ("24.99 EUR", "24.99"), ("0.005", "0.01"), ("$5", "5.00"), ("1234.5678", "1234.57")]
    cases = {"dot": both + [("1,234.50", "1234.50"), ("$1,234,567.5", "1234567.50")],
             "comma": both + [("€24,99", "24.99"), ("€1.234,50", "1234.50"), ("-3,5", "-3.50"), ("€ 0,05", "0.05"), ("EUR 24,99", "24.99"),
                              ("1.234", "1.23"), ("€1.234.567", "1234567.00"), ("1.234.567,8-", "-1234567.80"), ("12,50-", "-12.50"),
                              ("1-2", None)]}
    for notation, pairs in cases.items():
        df = spark.createDataFrame([(a,) for a, _ in pairs], "raw string")
        got = dict((r["raw"], r["m"]) for r in with_money(df, {"m": "raw"}, notation).collect())
        for raw, want in pairs:
            assert got[raw] == (Decimal(want) if want is not None else None), (notation, raw)
    numbers = spark.createDataFrame([(0.005, Decimal("24.995")), (24.990000000000002, None)], "d double, n decimal(18,3)")
    got = with_money(numbers, {"a": "d", "b": "n"}).collect()
    assert [(r["a"], r["b"]) for r in got] == [(Decimal("0.01"), Decimal("25.00")), (Decimal("24.99"), None)]


def test_money_text_is_searched_once(spark):
    """An amount's digits are computed once, not in each branch; names of the helper columns meet no others."""
    from ledgerline.functions.columns import with_money
    df = spark.createDataFrame([("1.234,5-", "5"), ("2,5E3", "7")], "raw string, ____raw0 string")
    out = with_money(df, {"m": "raw", "raw": "____raw0"}, "comma")
    assert out.columns == ["raw", "____raw0", "m"]
    assert [tuple(map(str, r)) for r in out.collect()] == [("5.00", "5", "-1234.50"), ("7.00", "7", "2.53")]
    plan = with_money(df, {"m": "raw"}, "comma")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^0-9.,") == 1


def test_unify_schema_is_canonical(spark, tmp_dir):
    from ledgerline.schemas import CANONICAL
    a = vendor_a_lines(spark, tmp_dir)
    _write(f"{tmp_dir}/b/orders_1.csv", B)
    write_vendor_c(f"{tmp_dir}/c/orders_1.tsv")
    u = normalize.unify(a, normalize.vendor_b(files.read_vendor_b(spark, f"{tmp_dir}/b/*.csv")),
                        normalize.vendor_c(files.read_vendor_c(spark, f"{tmp_dir}/c/*.tsv")))
    assert [(f.name, f.dataType) for f in u.schema.fields] == [(f.name, f.dataType) for f in CANONICAL.fields]
    assert u.count() == 5 + 3 + 7


def test_reader_odd_header_names_and_crlf(spark, tmp_dir):
    _write(f"{tmp_dir}/odd/orders_1.csv",
           "order_id,Order Date (US),unit price\r\nA1,01/15/2024,10.50\r\nA2,02/28/2024,\"1,234.50\"\r\n")
    df = files.read_vendor_a(spark, f"{tmp_dir}/odd/*.csv")
    got = rows(df, "order_id", "Order Date (US)", "unit price")
    assert got == [("A1", "01/15/2024", "10.50"), ("A2", "02/28/2024", "1,234.50")]
    assert df.select("_source_row").distinct().count() == 2


def test_reader_moved_columns_and_repeated_headers(spark, tmp_dir):
    """Layouts differ in order and case; a file may repeat its header; no row is lost or doubled."""
    _write(f"{tmp_dir}/m/orders_1.csv", "order_date,order_id,quantity\n01/15/2024,A1,1\n")
    _write(f"{tmp_dir}/m/orders_2.csv", "Order_ID, Quantity ,order_date\nA2,2,01/16/2024\nOrder_ID, Quantity ,order_date\nA3,3,01/17/2024\n")
    _write(f"{tmp_dir}/m/orders_3.csv", "order_id,order_date,quantity\nA4,01/18/2024,4\nA5,01/19/2024,5\n")
    df = files.read_vendor_a(spark, f"{tmp_dir}/m/*.csv")
    assert rows(df, "order_id", "quantity", "order_date") == [
        (f"A{i}", str(i), f"01/{14 + i}/2024") for i in range(1, 6)]


def test_unknown_layout_is_named(spark, tmp_dir):
    import pytest
    _write(f"{tmp_dir}/u/orders_1.csv", "order_id,quantity\nA1,1\n")
    _write(f"{tmp_dir}/u/orders_2.csv", "A2,2\nA3,3\n")
    with pytest.raises(files.UnknownLayoutError, match="orders_2.csv"):
        files.read_vendor_a(spark, f"{tmp_dir}/u/*.csv")


def test_ingest_appends_new_files_only(spark, tmp_dir):
    from ledgerline.plans import tables
    land, bronze = f"{tmp_dir}/in", f"{tmp_dir}/bronze"
    _write(f"{land}/orders_1.csv", A_V1)
    assert files.ingest(spark, land, "vendor_a", bronze) == 4
    assert files.ingest(spark, land, "vendor_a", bronze) == 0
    _write(f"{land}/orders_2.csv", A_V2)
    assert files.ingest(spark, land, "vendor_a", bronze) == 1
    df = tables.read_appended(spark, bronze)
    assert df.count() == 5 and {"email", "customer_email", "loyalty_points"} <= set(df.columns)
    assert df.filter("email IS NOT NULL").count() == 1 and df.filter("customer_email IS NOT NULL").count() == 2


def test_ingest_of_changed_files_and_after_a_crash(spark, tmp_dir, monkeypatch):
    from ledgerline.plans import tables
    land, bronze = f"{tmp_dir}/in", f"{tmp_dir}/bronze"
    _write(f"{land}/orders_1.csv", A_V1)
    first = files.ingest(spark, land, "vendor_a", bronze)
    assert (first, first.files, first.changed) == (4, 1, 0)
    _write(f"{land}/orders_1.csv", A_V1 + "A7,01/15/2024,x@y.com,WIDGET-500,2,10.50,21.00,visa\n")      # the same name, other content
    again = files.ingest(spark, land, "vendor_a", bronze)
    assert (again, again.files, again.changed) == (5, 1, 1)
    assert files.ingest(spark, land, "vendor_a", bronze) == 0
    _write(f"{land}/orders_2.csv", A_V2)
    real = files.read_files
    monkeypatch.setattr(files, "read_files", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    try:
        files.ingest(spark, land, "vendor_a", bronze)
        raise AssertionError("should have died")
    except RuntimeError:
        pass
    monkeypatch.setattr(files, "read_files", real)
    assert files.ingest(spark, land, "vendor_a", bronze) == 1 and files.ingest(spark, land, "vendor_a", bronze) == 0
    assert tables.read_appended(spark, bronze).count() == 10
    # the guard reads the manifest, never Bronze
    real_read = tables.read_appended
    monkeypatch.setattr(tables, "read_appended", lambda s, root, *a, **k: real_read(s, root, *a, **k) if root.endswith("/manifest") else (_ for _ in ()).throw(AssertionError(root)))
    assert files.ingest(spark, land, "vendor_a", bronze) == 0


def test_inferred_types(spark, tmp_dir):
    _write(f"{tmp_dir}/i/orders_1.csv", A_V1)
    df = files.read_vendor(spark, f"{tmp_dir}/i/*.csv", "vendor_a", infer=True)
    assert dict(df.dtypes)["quantity"] == "int" and df.count() == 4


def test_code_with_two_skus_takes_the_smallest(spark):
    lines = spark.createDataFrame([("a",), ("b",), (None,)], "product_sku string")
    m = spark.createDataFrame([("a", "S2"), ("a", "S1"), (None, "S9")], "code string, sku string")
    assert sorted(str(r[0]) for r in normalize.map_sku(lines, m).collect()) == ["None", "S1", "b"]
