"""Gold table catalogue and the refresh from a complete Silver.

A refresh rebuilds a table from all of Silver and publishes it as the next version: a key whose
lines moved elsewhere disappears with the old version.  (Deltas of a batch go through
``streaming.delta``.)  Rows are sorted inside the files so that scans skip row groups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerline.operators import gold
from ledgerline.operators.dedup import IDENTITY, keep_best
from ledgerline.plans import tables
from ledgerline.schemas import ORDER_KEYS


@dataclass(frozen=True)
class GoldTable:
    name: str
    build: Callable[[DataFrame], DataFrame]   # silver (or marked silver) -> aggregate
    keys: tuple[str, ...]
    needs_marked: bool = False                # reads all lines incl. duplicates


GOLD_TABLES = [
    GoldTable("daily_revenue_by_vendor", gold.daily_revenue_by_vendor, ("source_vendor", "order_date")),
    GoldTable("daily_product_revenue", gold.daily_product_revenue, ("product_sku", "order_date")),
    GoldTable("daily_revenue_by_country", gold.daily_revenue_by_country, ("country_code", "order_date")),
    GoldTable("customer_purchase_frequency", gold.customer_purchase_frequency, ("customer_email",)),
    GoldTable("product_by_revenue", gold.top_products, ("product_sku",)),
    GoldTable("promo_analysis", gold.promo_analysis, ("promo_code",)),
    GoldTable("duplicate_analysis_report", gold.duplicate_report, ("source_vendor",), needs_marked=True),
]


#: columns of a line that rank it, and that the tables group by or sum
NEEDED = {*ORDER_KEYS, *IDENTITY, "payment_status", "order_timestamp", "_ingestion_timestamp", "product_sku", "quantity",
          "total_amount_usd", "discount_amt_usd", "loyalty_points", "source_vendor", "country_code", "customer_email", "promo_code"}


def refresh(spec: GoldTable, marked_silver: DataFrame, root: str) -> int:
    """Build ``spec`` from Silver and publish it; returns the new version."""
    src = marked_silver if spec.needs_marked else keep_best(marked_silver)
    order = ["order_date"] if "order_date" in spec.keys else []
    return tables.publish(spec.build(src), f"{root.rstrip('/')}/{spec.name}", note=spec.name,
                          sort_within=order + [k for k in spec.keys if k != "order_date"])


def refresh_all(marked_silver: DataFrame, root: str, parallel: int = 4) -> dict[str, int]:
    """Refresh every Gold table; the seven jobs are independent, so up to ``parallel``
    of them are submitted at once (Spark runs jobs from several driver threads
    concurrently; each table's publish stays atomic on its own)."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {spec.name: pool.submit(refresh, spec, marked_silver, root) for spec in GOLD_TABLES}
        return {name: f.result() for name, f in futures.items()}
