"""Vendor Bronze rows -> canonical Silver order lines.

Each normaliser is one projection (plus one ``posexplode_outer`` for vendor C), so
Catalyst collapses it into a single codegen stage and pushes filters through it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    lookup, map_values, normalized_status, parse_ts, to_usd, with_missing, with_money,
)
from ledgerline.schemas import (
    C_CUSTOMER, C_ITEM, C_PAYMENT, CANONICAL, CANONICAL_COLUMNS, DATE_FORMAT_A, DATE_FORMAT_B,
    FX_DEFAULT_RATE, FX_RATES, MONEY, PAYMENT_MAP_A, PAYMENT_MAP_B, PCT, RATE, SKU_MAP,
    TS_FORMAT_C, VENDOR_A_COUNTRY, VENDOR_A_CURRENCY, VENDOR_B_CURRENCY,
)
from pyspark.sql import types as T

_LINEAGE_DEFAULTS = {
    "_source_vendor": T.StringType(),
    "_ingestion_timestamp": T.TimestampType(),
    "_source_file": T.StringType(),
    "_source_row": T.LongType(),
}


def canonical(df: DataFrame) -> DataFrame:
    """Project to the canonical column order with canonical types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CANONICAL.fields])


def _int(c: str) -> Column:
    return F.trim(F.col(c).cast("string")).try_cast("int")


def _line_total(qty: Column, unit: Column) -> Column:
    return (qty.cast("decimal(10,0)") * unit).cast(MONEY)


def vendor_a(df: DataFrame, payment_map: Mapping[str, str] = PAYMENT_MAP_A) -> DataFrame:
    """US feed: MM/dd/yyyy dates, USD amounts, header drift (email rename + promo columns)."""
    df = with_missing(df, {
        "email": "string", "customer_email": "string", "promo_code": "string",
        "loyalty_points": "string", "discount_pct": "string", "unit_price": "string",
        "total_amount": "string", "payment_status": "string", **_LINEAGE_DEFAULTS,
    })
    df = with_money(df, {"_unit": "unit_price", "_total": "total_amount"}).withColumns({
        "_qty": _int("quantity"),
        "_pct": F.trim(F.col("discount_pct").cast("string")).try_cast(PCT),
    })
    unit, qty, pct = F.col("_unit"), F.col("_qty"), F.col("_pct")
    out = df.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.lit(1).alias("line_number"),
        parse_ts("order_date", DATE_FORMAT_A).alias("order_timestamp"),
        F.coalesce(F.col("email"), F.col("customer_email")).alias("customer_email"),
        F.col("product_sku").cast("string").alias("product_sku"),
        qty.alias("quantity"),
        unit.alias("unit_price_usd"),
        F.col("_total").alias("total_amount_usd"),
        F.when(pct.isNotNull(), (unit * qty.cast("decimal(10,0)") * pct / F.lit(100)).cast(MONEY))
         .alias("discount_amt_usd"),
        map_values("payment_method", payment_map).alias("payment_method"),
        F.lit(VENDOR_A_COUNTRY).alias("country_code"),
        F.col("promo_code").cast("string").alias("promo_code"),
        _int("loyalty_points").alias("loyalty_points"),
        F.col("_source_vendor").alias("source_vendor"),
        F.lit(VENDOR_A_CURRENCY).alias("source_currency"),
        F.lit(FX_RATES[VENDOR_A_CURRENCY]).cast(RATE).alias("exchange_rate"),
        F.lit(None).cast(MONEY).alias("vat_amount_usd"),
        "_ingestion_timestamp", "_source_file",
        normalized_status("payment_status").alias("payment_status"),
        _line_total(qty, unit).alias("line_total_usd"),
        "_source_row",
    )
    return canonical(out)


def vendor_b(df: DataFrame, sku_map: Mapping[str, str] = SKU_MAP,
             payment_map: Mapping[str, str] = PAYMENT_MAP_B) -> DataFrame:
    """EU feed: dd-MM-yyyy dates, EUR money text (``€1.234,50``), VAT, short SKUs."""
    df = with_missing(df, {
        "order_date": "string", "customer_email": "string", "product_code": "string",
        "quantity": "string", "unit_price": "string", "total_amount": "string",
        "payment_method": "string", "country_code": "string", "vat_amount": "string",
        "payment_status": "string", **_LINEAGE_DEFAULTS,
    })
    rate = F.lit(FX_RATES[VENDOR_B_CURRENCY]).cast(RATE)
    df = with_money(df, {"_unit": "unit_price", "_total": "total_amount", "_vat": "vat_amount"}, notation="comma")
    df = df.withColumns({"_qty": _int("quantity"), "_unit_usd": to_usd("_unit", rate)})
    qty, unit = F.col("_qty"), F.col("_unit_usd")
    out = df.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.lit(1).alias("line_number"),
        parse_ts("order_date", DATE_FORMAT_B).alias("order_timestamp"),
        F.col("customer_email").cast("string").alias("customer_email"),
        map_values("product_code", sku_map).alias("product_sku"),
        qty.alias("quantity"),
        unit.alias("unit_price_usd"),
        to_usd("_total", rate).alias("total_amount_usd"),
        F.lit(None).cast(MONEY).alias("discount_amt_usd"),
        map_values("payment_method", payment_map).alias("payment_method"),
        F.col("country_code").cast("string").alias("country_code"),
        F.lit(None).cast("string").alias("promo_code"),
        F.lit(None).cast("int").alias("loyalty_points"),
        F.col("_source_vendor").alias("source_vendor"),
        F.lit(VENDOR_B_CURRENCY).alias("source_currency"),
        rate.alias("exchange_rate"),
        to_usd("_vat", rate).alias("vat_amount_usd"),
        "_ingestion_timestamp", "_source_file",
        normalized_status("payment_status").alias("payment_status"),
        _line_total(qty, unit).alias("line_total_usd"),
        "_source_row",
    )
    return canonical(out)


def vendor_c(df: DataFrame, fx_rates: Mapping[str, str] = FX_RATES) -> DataFrame:
    """Asian feed: one row per order with JSON customer / line items / payment.

    Lines are numbered by their position inside the order's own array
    (``posexplode_outer``), so a re-sent order gets the same line numbers and its
    lines dedup against the first copy; an order with no items keeps one row.
    """
    df = with_missing(df, {"customer_info": "string", "line_items": "string",
                           "payment_details": "string", **_LINEAGE_DEFAULTS})
    parsed = df.select(
        "*",
        F.from_json(F.col("customer_info").cast("string"), C_CUSTOMER).alias("_customer"),
        F.from_json(F.col("line_items").cast("string"), T.ArrayType(C_ITEM)).alias("_items"),
        F.from_json(F.col("payment_details").cast("string"), C_PAYMENT).alias("_payment"),
    )
    lines = parsed.select("*", F.posexplode_outer("_items").alias("_pos", "_item"))
    currency = F.upper(F.trim(F.col("_payment.currency")))
    lines = lines.withColumn(
        "_rate", F.coalesce(lookup(currency, fx_rates, RATE), F.lit(FX_DEFAULT_RATE).cast(RATE)))
    lines = lines.withColumn("_unit_usd", to_usd(F.col("_item.price"), F.col("_rate")))
    rate, qty, unit = F.col("_rate"), F.col("_item.qty"), F.col("_unit_usd")
    out = lines.select(
        F.col("order_number").cast("string").alias("order_id"),
        (F.coalesce(F.col("_pos"), F.lit(0)) + 1).cast("int").alias("line_number"),
        parse_ts("created_at", TS_FORMAT_C).alias("order_timestamp"),
        F.col("_customer.email").alias("customer_email"),
        F.col("_item.sku").alias("product_sku"),
        qty.alias("quantity"),
        unit.alias("unit_price_usd"),
        to_usd(F.col("_payment.amount"), rate).alias("total_amount_usd"),
        F.lit(None).cast(MONEY).alias("discount_amt_usd"),
        F.col("_payment.method").alias("payment_method"),
        F.col("_customer.country").alias("country_code"),
        F.lit(None).cast("string").alias("promo_code"),
        F.lit(None).cast("int").alias("loyalty_points"),
        F.col("_source_vendor").alias("source_vendor"),
        F.col("_payment.currency").alias("source_currency"),
        rate.alias("exchange_rate"),
        F.lit(None).cast(MONEY).alias("vat_amount_usd"),
        "_ingestion_timestamp", "_source_file",
        normalized_status(F.col("_payment.status")).alias("payment_status"),
        _line_total(qty, unit).alias("line_total_usd"),
        "_source_row",
    )
    return canonical(out)


def map_sku(lines: DataFrame, sku_map: DataFrame, raw_col: str = "product_sku",
            code_col: str = "code", sku_col: str = "sku") -> DataFrame:
    """Replace raw product codes by canonical SKUs from a mapping table; unmapped
    codes pass through, and a code that maps to several SKUs takes the smallest.  A plain
    join: Spark broadcasts the map where it has measured it to be small, and splits a hot
    code's lines otherwise.
    """
    right = (sku_map.groupBy(F.col(code_col).alias("_code")).agg(F.min(sku_col).alias("_sku"))
             .filter(F.col("_code").isNotNull()))
    joined = lines.join(right, lines[raw_col] == right["_code"], "left")
    return joined.withColumn(raw_col, F.coalesce(F.col("_sku"), F.col(raw_col))).drop("_code", "_sku")


def unify(*frames: DataFrame) -> DataFrame:
    """UNION ALL of canonical frames by name (types are already identical)."""
    out = None
    for f in frames:
        f = f.select(*CANONICAL_COLUMNS)
        out = f if out is None else out.unionByName(f)
    return out
