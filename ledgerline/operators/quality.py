"""Data-quality counts that the tolerant parsers would otherwise hide.

Parsing never fails a job (bad dates and amounts become NULL, unknown currencies
convert at 1.0), so these counts are how a NULL is noticed.  One aggregate job each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import C_ITEM, FX_RATES


def _n(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def line_quality(lines: DataFrame) -> DataFrame:
    """Per vendor: lines, and lines with a missing timestamp / amount / SKU / e-mail,
    an unknown currency or a negative amount (canonical Silver lines in)."""
    known = F.upper(F.col("source_currency")).isin(list(FX_RATES))
    return lines.groupBy("source_vendor").agg(
        F.count(F.lit(1)).alias("lines"),
        _n(F.col("order_timestamp").isNull()).alias("null_order_timestamp"),
        _n(F.col("total_amount_usd").isNull()).alias("null_total_amount"),
        _n(F.col("product_sku").isNull()).alias("null_product_sku"),
        _n(F.col("customer_email").isNull()).alias("null_customer_email"),
        _n(F.col("source_currency").isNull() | ~known).alias("unknown_currency"),
        _n(F.col("total_amount_usd") < 0).alias("negative_amount"),
    )


def json_parse_failures(bronze_c: DataFrame) -> DataFrame:
    """Vendor C rows whose ``line_items`` text is present but is not a JSON item array."""
    parsed = F.from_json(F.col("line_items"), T.ArrayType(C_ITEM))
    return bronze_c.agg(
        F.count(F.lit(1)).alias("rows"),
        _n(F.col("line_items").isNotNull() & parsed.isNull()).alias("unparsed_line_items"),
    )
