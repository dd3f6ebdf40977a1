"""Vendor feeds derived from the star-schema test tables.

The test tables hold no vendor files, so Spark derives the three vendor shapes from
them: every ``lineitem`` row becomes one order line of the vendor that serves the
customer's region (AMERICA -> A, ASIA -> C, everything else -> B).  Each vendor frame
carries the raw *text* representation that vendor sends (dates in its format, EUR
amounts as ``€1.234,50``, JSON documents for C) plus the Bronze lineage columns, so
the real normalisers parse it back.

Mapping (stated again, independently, in ``ledgerline.plans.oracle``).  The test tables hold
several rows for one (l_orderkey, l_linenumber); these become copies of one order line that
differ in status, order time and amounts, so the dedup rules decide:

* order_id ``<l_orderkey>-<l_linenumber>``, NULL where l_partkey % 97 = 0
* order date ``o_orderdate`` + l_suppkey % 3 days (unreadable text where l_partkey % 89 = 0);
  arrival (``_ingestion_timestamp``) ``l_shipdate``
* status by l_returnflag R/A/N -> Settled/completed/pending; ``on-hold`` where l_partkey % 13
  = 0, missing where l_partkey % 17 = 0
* customer ``c_name``; country ``n_name`` (vendor A always reports US)
* sku ``SKU-<l_partkey>``, quantity ``l_quantity``, amount ``l_extendedprice`` in
  local currency; unit price = amount / quantity (cents, half-up)
* amounts as text in four notations per vendor, by l_partkey % 4
* currency: A USD, B EUR, C JPY for even nation keys, KRW for odd (some in lower case),
  SGD (no rate) where l_partkey % 7 = 0
* B VAT = amount * l_tax (cents, half-up)
* C items by l_partkey % 11: 0 malformed, 1 empty array, 2 NULL, 3-5 two items (the second one
  ``SKU-<l_partkey>-X``, quantity 1), else one
* A promotions: rows with ``l_returnflag = 'R'`` come from the day-30 file layout
  and carry ``SAVE<pct>`` with pct = ``l_discount * 100`` and loyalty = quantity
* payment method by the customer's market segment (table below)

Joins: ``orders`` is joined to ``customer`` first and that result to ``lineitem``,
so the biggest table is shuffled exactly once; nation and region are fixed
25- and 5-row dimensions and are broadcast.  The joined facts are staged once per session and
folder, and the three feeds read their columns from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.joins import staged, staged_while
from ledgerline.schemas import (
    DATE_FORMAT_A, DATE_FORMAT_B, MONEY, TS_FORMAT_C, VENDOR_A, VENDOR_B, VENDOR_C,
)

# Fixed values of the derivation (also spelled out in the SQL oracle).
REGION_VENDOR = {"AMERICA": VENDOR_A, "ASIA": VENDOR_C}
STATUS_BY_FLAG = {"R": "Settled", "A": "completed", "N": "pending"}
PAYMENT_BY_SEGMENT = {
    VENDOR_A: {"AUTOMOBILE": "visa", "BUILDING": "google_pay", "FURNITURE": "apple_pay",
               "HOUSEHOLD": "paypal", "MACHINERY": "mastercard"},
    VENDOR_B: {"AUTOMOBILE": "carte_bancaire", "BUILDING": "visa", "FURNITURE": "paypal",
               "HOUSEHOLD": "carte_bancaire", "MACHINERY": "sepa_debit"},
    VENDOR_C: {"AUTOMOBILE": "konbini", "BUILDING": "card", "FURNITURE": "card",
               "HOUSEHOLD": "konbini", "MACHINERY": "bank_transfer"},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default) if not isinstance(default, Column) else default)


_STAGED: dict[tuple[str, str], DataFrame] = {}


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``build_order_facts``, staged once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        _STAGED[key] = staged(build_order_facts(spark, sf_dir), "order_facts")
    return _STAGED[key]


@contextmanager
def facts_while(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The facts for the jobs of the block: those staged in this session, or else staged for it and removed after."""
    held = _STAGED.get((spark.sparkContext.applicationId, sf_dir))
    if held is not None:
        yield held
        return
    with staged_while(build_order_facts(spark, sf_dir), "order_facts") as facts:
        yield facts


def build_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem row with every attribute the vendor feeds need."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
        F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("_source_row"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    # Both sides of these two joins grow with the data: sort-merge join (spills, and
    # AQE splits skewed keys).  Only the fixed-size geography is broadcast.
    order_side = (orders.join(cust.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
                  .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    facts = li.join(order_side.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    vendor = _case(F.col("r_name"), REGION_VENDOR, VENDOR_B)
    amount = F.col("l_extendedprice").cast(MONEY)
    qty = F.col("l_quantity").cast("int")
    unit = F.try_divide(amount, qty.cast("decimal(10,0)")).cast(MONEY)
    pct = F.round(F.col("l_discount") * 100).cast("int")
    promo = (vendor == VENDOR_A) & (F.col("l_returnflag") == "R")
    payment = None
    for v, seg_map in PAYMENT_BY_SEGMENT.items():
        branch = _case(F.col("c_mktsegment"), seg_map, "other")
        payment = F.when(vendor == v, branch) if payment is None else payment.when(vendor == v, branch)
    return facts.select(
        vendor.alias("vendor"),
        F.when(F.col("l_partkey") % 97 != 0,
               F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))).alias("order_id"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("l_suppkey") % 3).cast("int")).cast("timestamp").alias("order_ts"),
        F.when(F.col("l_partkey") % 17 == 0, None).when(F.col("l_partkey") % 13 == 0, F.lit("on-hold"))
         .otherwise(_case(F.col("l_returnflag"), STATUS_BY_FLAG)).alias("status"),
        F.col("l_partkey").alias("partkey"),
        F.col("c_name").alias("customer"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").alias("nationkey"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        qty.alias("qty"),
        amount.alias("amount"),
        unit.alias("unit"),
        (amount * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY).alias("vat"),
        promo.alias("promo"),
        pct.alias("pct"),
        payment.alias("method"),
        F.col("l_shipdate").cast("timestamp").alias("arrived"),
        "_source_row",
    )


def _lineage(vendor: str, ext: str) -> list[Column]:
    day = F.date_format(F.col("arrived"), "yyyyMMdd")
    return [
        F.concat(F.lit(f"{vendor}/orders_"), day, F.lit(f".{ext}")).alias("_source_file"),
        F.col("arrived").alias("_ingestion_timestamp"),
        F.lit(vendor).alias("_source_vendor"),
        "_source_row",
    ]


def _by_notation(texts: list[Column]) -> Column:
    n = F.col("partkey") % 4
    out = texts[3]
    for k in (2, 1, 0):
        out = F.when(n == k, texts[k]).otherwise(out)
    return out


def _eur_text(c: Column) -> Column:
    """12345.5 -> '€12.345,50', 'EUR 12345,50', '12345.500' or '12345,50 EUR'."""
    plain = c.cast("string")
    comma = F.translate(plain, ".", ",")
    return _by_notation([F.concat(F.lit("€"), F.translate(F.format_number(c, 2), ",.", ".,")), F.concat(F.lit("EUR "), comma),
                         F.concat(plain, F.lit("0")), F.concat(comma, F.lit(" EUR"))])


def _usd_text(c: Column) -> Column:
    """12345.5 -> '12345.50', '12,345.50', '$12,345.50' or '12345.500'."""
    plain, grouped = c.cast("string"), F.format_number(c, 2)
    return _by_notation([plain, grouped, F.concat(F.lit("$"), grouped), F.concat(plain, F.lit("0"))])


def _date_text(fmt: str) -> Column:
    return F.when(F.col("partkey") % 89 == 0, F.lit("not-a-date")).otherwise(F.date_format("order_ts", fmt))


def vendor_a_feed(facts: DataFrame) -> DataFrame:
    f = facts.filter(F.col("vendor") == VENDOR_A)
    v2 = F.col("promo")
    return f.select(
        "order_id",
        _date_text(DATE_FORMAT_A).alias("order_date"),
        F.when(~v2, F.col("customer")).alias("customer_email"),
        F.when(v2, F.col("customer")).alias("email"),
        F.col("sku").alias("product_sku"),
        F.col("qty").cast("string").alias("quantity"),
        _usd_text(F.col("unit")).alias("unit_price"),
        _usd_text(F.col("amount")).alias("total_amount"),
        F.col("method").alias("payment_method"),
        F.when(v2, F.concat(F.lit("SAVE"), F.col("pct").cast("string"))).alias("promo_code"),
        F.when(v2, F.col("pct").cast("string")).alias("discount_pct"),
        F.when(v2, F.col("qty").cast("string")).alias("loyalty_points"),
        F.col("status").alias("payment_status"),
        v2.alias("_layout_v2"),
        *_lineage(VENDOR_A, "csv"),
    )


def vendor_b_feed(facts: DataFrame) -> DataFrame:
    f = facts.filter(F.col("vendor") == VENDOR_B)
    return f.select(
        "order_id",
        _date_text(DATE_FORMAT_B).alias("order_date"),
        F.col("customer").alias("customer_email"),
        F.col("sku").alias("product_code"),
        F.col("qty").cast("string").alias("quantity"),
        _eur_text(F.col("unit")).alias("unit_price"),
        _eur_text(F.col("amount")).alias("total_amount"),
        _eur_text(F.col("vat")).alias("vat_amount"),
        F.col("method").alias("payment_method"),
        F.col("country").alias("country_code"),
        F.col("status").alias("payment_status"),
        *_lineage(VENDOR_B, "csv"),
    )


def vendor_c_feed(facts: DataFrame) -> DataFrame:
    f = facts.filter(F.col("vendor") == VENDOR_C)
    part = F.col("partkey")
    own = F.when(F.col("nationkey") % 2 == 0, F.lit("JPY")).otherwise(F.lit("KRW"))
    currency = F.when(part % 7 == 0, F.lit("SGD")).when(part % 5 == 1, F.lower(own)).otherwise(own)
    one = F.struct(F.col("sku").alias("sku"), F.col("qty").alias("qty"), F.col("unit").alias("price"))
    two = F.struct(F.concat("sku", F.lit("-X")).alias("sku"), F.lit(1).alias("qty"), F.col("unit").alias("price"))
    items = (F.when(part % 11 == 0, F.lit("{not json")).when(part % 11 == 1, F.lit("[]")).when(part % 11 == 2, None)
             .when(part % 11 <= 5, F.to_json(F.array(one, two))).otherwise(F.to_json(F.array(one))))
    return f.select(
        F.col("order_id").alias("order_number"),
        _date_text(TS_FORMAT_C).alias("created_at"),
        F.to_json(F.struct(F.col("customer").alias("email"), F.col("country").alias("country"))).alias("customer_info"),
        items.alias("line_items"),
        F.to_json(F.struct(F.col("method").alias("method"), currency.alias("currency"),
                           F.col("amount").alias("amount"), F.col("status").alias("status"))).alias("payment_details"),
        *_lineage(VENDOR_C, "tsv"),
    )


def vendor_feeds(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    facts = order_facts(spark, sf_dir) if facts is None else facts
    return vendor_a_feed(facts), vendor_b_feed(facts), vendor_c_feed(facts)
