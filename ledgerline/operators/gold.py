"""Gold business aggregates over Silver order lines.

All measures are plain ``sum``/``count``/``avg`` aggregates, so Spark runs them as a
partial aggregate inside every map task and a final aggregate after one hash
shuffle on the grouping key: a dimension value that holds a third of all rows
still sends only one partial row per map task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import MONEY

# Dimension name -> expression over a Silver line.
DIMENSIONS = {
    "order_date": lambda: F.to_date(F.col("order_timestamp")),
}


def _dim(name: str) -> Column:
    maker = DIMENSIONS.get(name)
    return (maker() if maker else F.col(name)).alias(name)


def _money_sum(c: str) -> Column:
    return F.sum(c).cast(MONEY)


def _ratio(num: str, den: str) -> Column:
    """round(num / den, 2) as money; NULL when den is 0."""
    return F.round(F.try_divide(F.col(num), F.col(den).cast("decimal(20,0)")), 2).cast(MONEY)


def in_period(silver: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Lines with ``start <= order_timestamp < end`` (dates or timestamps as text).

    A plain column comparison, so it is pushed into the Parquet scan: files and row
    groups whose min/max lie outside the period are skipped (see ``maintenance.compact``
    for clustering the table so that such skipping is effective).
    """
    ts = F.col("order_timestamp")
    if start is not None:
        silver = silver.filter(ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        silver = silver.filter(ts < F.lit(end).cast("timestamp"))
    return silver


def _with_status(df: DataFrame, statuses: Iterable[str] | None) -> DataFrame:
    if statuses is None:
        return df
    return df.filter(F.lower(F.col("payment_status")).isin([s.lower() for s in statuses]))


def _audit(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn("_updated_at", F.current_timestamp()) if audit else df


def revenue_by(silver: DataFrame, dims: Sequence[str], grain: str = "row",
               statuses: Iterable[str] | None = None, duplicate_count: bool = True,
               audit: bool = True) -> DataFrame:
    """Revenue, order count, discount and average order value per ``dims``.

    ``grain="row"`` sums every Silver line and counts lines with an order id.
    ``grain="order"`` counts each order once: an order's total is taken once per
    order (vendor C repeats the order total on each of its lines) and orders are
    counted distinct.  ``statuses`` optionally keeps only the given payment statuses.
    """
    df = _with_status(silver, statuses)
    if grain == "order":
        per_order = (df.groupBy(*[_dim(d) for d in dims], F.col("order_id"))
                     .agg(F.max("total_amount_usd").alias("total_amount_usd"),
                          F.sum("discount_amt_usd").alias("discount_amt_usd")))
        grouped = per_order.groupBy(*dims)
    elif grain == "row":
        grouped = df.groupBy(*[_dim(d) for d in dims])
    else:
        raise ValueError(f"grain must be 'row' or 'order', not {grain!r}")
    out = (grouped.agg(_money_sum("total_amount_usd").alias("total_amount_usd"),
                       F.count("order_id").alias("order_count"),
                       _money_sum("discount_amt_usd").alias("total_discount_usd"))
           .withColumn("avg_order_value_usd", _ratio("total_amount_usd", "order_count")))
    if duplicate_count:
        out = out.withColumn("duplicate_count", F.lit(0))
    return _audit(out, audit)


def daily_revenue_by_vendor(silver: DataFrame, **kw) -> DataFrame:
    return revenue_by(silver, ["source_vendor", "order_date"], **kw)


def daily_product_revenue(silver: DataFrame, **kw) -> DataFrame:
    return revenue_by(silver, ["product_sku", "order_date"], **kw)


def daily_revenue_by_country(silver: DataFrame, **kw) -> DataFrame:
    return revenue_by(silver, ["country_code", "order_date"], duplicate_count=False, **kw)


def customer_purchase_frequency(silver: DataFrame, audit: bool = True,
                                statuses: Iterable[str] | None = None) -> DataFrame:
    df = _with_status(silver, statuses)
    out = (df.groupBy("customer_email")
           .agg(F.count("order_id").alias("order_count"),
                _money_sum("total_amount_usd").alias("total_amount_usd"),
                _money_sum("discount_amt_usd").alias("total_discount_usd"))
           .withColumn("avg_order_value_usd", _ratio("total_amount_usd", "order_count")))
    return _audit(out, audit)


def top_products(silver: DataFrame, n: int = 10, audit: bool = True,
                 statuses: Iterable[str] | None = None) -> DataFrame:
    """The ``n`` products with the highest revenue (ties broken by SKU).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps its
    own top ``n`` after the aggregate, so only ``n`` rows per task reach the driver.
    """
    df = _with_status(silver, statuses)
    out = (df.groupBy("product_sku")
           .agg(_money_sum("total_amount_usd").alias("total_amount_usd"),
                _money_sum("discount_amt_usd").alias("total_discount_usd"))
           .orderBy(F.col("total_amount_usd").desc_nulls_last(), F.col("product_sku").asc_nulls_last())
           .limit(n))
    return _audit(out, audit)


def promo_analysis(silver: DataFrame, audit: bool = True) -> DataFrame:
    """Usage, discount given, revenue, average order and loyalty points per promo code."""
    out = (silver.filter(F.col("promo_code").isNotNull())
           .groupBy("promo_code")
           .agg(F.count("order_id").alias("usage_count"),
                _money_sum("discount_amt_usd").alias("total_discount_given_usd"),
                _money_sum("total_amount_usd").alias("total_revenue_with_promo_usd"),
                F.sum("total_amount_usd").alias("_sum_total"),
                F.count("total_amount_usd").alias("_n_total"),
                F.sum("loyalty_points").alias("total_loyalty_points_awarded"))
           .withColumn("avg_order_value_usd", _ratio("_sum_total", "_n_total"))
           .drop("_sum_total", "_n_total")
           .orderBy(F.col("usage_count").desc(), F.col("promo_code")))
    return _audit(out, audit)


def duplicate_report(marked: DataFrame, audit: bool = True) -> DataFrame:
    """Per vendor: rows received, duplicates marked and the revenue they would add."""
    dup = F.col("_is_duplicate")
    out = (marked.groupBy("source_vendor")
           .agg(F.count(F.lit(1)).alias("total_rows"),
                F.count(F.when(dup, F.lit(1))).alias("duplicate_count"),
                F.coalesce(F.sum(F.when(dup, F.col("total_amount_usd"))), F.lit(0)).cast(MONEY)
                .alias("revenue_impact_usd")))
    return _audit(out, audit)


def accuracy_metrics(marked: DataFrame) -> DataFrame:
    """Global duplicate rate and revenue inflation of the un-deduplicated data (one row)."""
    dup = F.col("_is_duplicate")
    agg = marked.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(dup, F.lit(1))).alias("duplicate_rows"),
        F.sum("total_amount_usd").cast(MONEY).alias("reported_revenue_usd"),
        F.sum(F.when(~dup, F.col("total_amount_usd"))).cast(MONEY).alias("actual_revenue_usd"),
    )
    return agg.select(
        "*",
        F.round(F.try_divide(F.col("duplicate_rows") * 100, F.col("total_rows").cast("decimal(20,0)")), 2)
        .cast(MONEY).alias("duplicate_rate_pct"),
        F.round(F.try_divide((F.col("reported_revenue_usd") - F.col("actual_revenue_usd")) * 100,
                             F.col("actual_revenue_usd")), 2).cast(MONEY).alias("revenue_inflation_pct"),
    )
