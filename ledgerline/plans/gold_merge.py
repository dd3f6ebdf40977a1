"""Stored Silver and Gold kept up to date by merging batches.

``<root>/silver`` holds the winning line of every order line, partitioned by the month (or day) of the order;
the Gold tables are stored beside it.  A batch of lines (any mix of new orders and late copies) goes through in three steps:

1. Its orders' present winners are looked up: the partitions they lie in from the key columns alone, the lines
   from these partitions only.  The best of a winner and the batch's copies is the new winner - losers are never
   needed again, because the order of copies is total.  The lines that won before or win now are stored.
2. They are merged into Silver: a line that lost goes, also where it lay in another partition.
3. Each Gold table is merged for the keys of these lines: their rows are aggregated anew from Silver (of
   the touched months, for tables by date), and a key without lines disappears.

A batch is known by its id.  One that died half-way is finished by calling again with the same id, from
the changes stored in step 1; a finished one changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import dedup, gold
from ledgerline.operators.joins import write_parts
from ledgerline.operators.merge import _null_safe_on
from ledgerline.plans import stored, tables
from ledgerline.plans.gold_jobs import GOLD_TABLES, NEEDED, GoldTable
from ledgerline.schemas import ORDER_KEYS
from ledgerline.session import stored_bytes
from ledgerline.streaming import watermark

DATE = "order_date"
#: partitions of the tables by date; a lake keeps the one it began with
GRAINS = {"day": lambda: F.col(DATE), "month": lambda: stored.month(DATE)}
#: a line's own identity: lines without an order id have no other
LINE = [*ORDER_KEYS, "_source_file", "_source_row"]


@dataclass(frozen=True)
class Merged:
    """A stored Gold table: its aggregate over lines, keys, and folders where it has no date."""

    table: GoldTable
    hashed: int = 64


def _product_totals(silver: DataFrame) -> DataFrame:
    return gold._audit(silver.groupBy("product_sku").agg(
        gold._money_sum("total_amount_usd").alias("total_amount_usd"),
        gold._money_sum("discount_amt_usd").alias("total_discount_usd")), True)


_BY_NAME = {t.name: t for t in GOLD_TABLES}
TOP = "product_by_revenue"
MERGED = [Merged(_BY_NAME[n]) for n in ("daily_revenue_by_vendor", "daily_product_revenue", "daily_revenue_by_country",
                                       "customer_purchase_frequency", "promo_analysis")] + \
    [Merged(GoldTable("product_totals", _product_totals, ("product_sku",)))]


def _by_date(lines: DataFrame) -> DataFrame:
    return lines.withColumn(DATE, F.to_date("order_timestamp"))


def changes(spark: SparkSession, root: str, batch: DataFrame, grain: str = "month", n: int = 1) -> list[DataFrame]:
    """Lines of the batch's orders that win now (``_wins``) and stored ones that lost to them, in ``n`` portions of the
    orders that are shuffled one after the other.  Of a stored line only the columns that rank it or that tables are keyed by."""
    lines = _by_date(batch)
    keyed = lines.filter(" AND ".join(f"{k} IS NOT NULL" for k in ORDER_KEYS))
    loose = lines.filter(" OR ".join(f"{k} IS NULL" for k in ORDER_KEYS)).withColumn("_wins", F.lit(True))
    won = None
    if stored.exists(spark, f"{root}/silver"):
        silver = stored.read(spark, f"{root}/silver")
        orders = keyed.select(*ORDER_KEYS).distinct()
        found = stored.parts_of(silver.select(*ORDER_KEYS, DATE).join(orders, list(ORDER_KEYS), "left_semi"), GRAINS[grain]())
        if found:
            won = stored.read(spark, f"{root}/silver", found).select(*[c for c in silver.columns if c in NEEDED or c in (*LINE, DATE)])
    own = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in ORDER_KEYS]), F.lit(n))
    out = []
    for k in range(n):
        mine, free, old = (df if n == 1 or df is None else df.filter(own == k) for df in (keyed, loose, won))
        best = dedup.keep_best(mine, whole_keys=True)
        if old is None:
            out.append(best.withColumn("_wins", F.lit(True)).unionByName(free))
            continue
        old = old.join(mine.select(*ORDER_KEYS).distinct(), list(ORDER_KEYS), "left_semi")
        # a replayed copy equals the stored winner, which stands for both; a winner that stays has changed nothing
        # (one without a source file or row cannot be told from a copy: as ever, it goes when a batch meets its order)
        out.append(dedup.changed_winners(best, old, untold=LINE).unionByName(free, allowMissingColumns=True))
    return out


def merge_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: str, hashed: int | None = None, grain: str = "month") -> dict[str, list[str]] | None:
    """Merge canonical lines into the stored Silver and all stored Gold tables under ``root``.

    Returns the touched partition folders of each table, or None for a batch that had been finished before."""
    root = root.rstrip("/")
    if batch_id in watermark.processed(spark, f"{root}/control", "gold_merge"):
        return None
    path = f"{root}/changes/{batch_id}"
    if not stored.exists(spark, path):
        held = stored_bytes(spark, f"{root}/silver") if stored.exists(spark, f"{root}/silver") else 0
        write_parts(changes(spark, root, batch, grain, max(1, -(-held // stored.GROUP_BYTES))), path)
    changed = spark.read.parquet(path)
    touched = {"silver": stored.create_or_merge(changed.filter("_wins").drop("_wins"), f"{root}/silver", [*LINE, DATE], GRAINS[grain](),
                                                touched=changed.select(*LINE, DATE), source_stored=True)}
    silver = stored.read(spark, f"{root}/silver")
    with ThreadPoolExecutor(max_workers=4) as pool:       # independent jobs, submitted at once
        done = {m.table.name: pool.submit(_merge_gold, m, silver, changed, f"{root}/{m.table.name}", hashed or m.hashed, grain) for m in MERGED}
        touched |= {name: d.result() for name, d in done.items()}
    top = gold.top_products(_totals_as_lines(stored.read(spark, f"{root}/product_totals")))
    held = stored.read(spark, f"{root}/{TOP}").select("product_sku") if stored.exists(spark, f"{root}/{TOP}") else None
    touched[TOP] = stored.create_or_merge(top, f"{root}/{TOP}", ["product_sku"], hashed=1, touched=held)   # ten rows
    watermark.advance(spark, f"{root}/control", "gold_merge", [batch_id])
    stored.delete(spark, path)       # a finished batch is never asked for its changes again
    return touched


def _totals_as_lines(totals: DataFrame) -> DataFrame:
    return totals.select("product_sku", "total_amount_usd", F.col("total_discount_usd").alias("discount_amt_usd"))


def _merge_gold(m: Merged, silver: DataFrame, changed: DataFrame, path: str, hashed: int, grain: str) -> list[str]:
    spark, keys = silver.sparkSession, list(m.table.keys)
    part = GRAINS[grain]() if DATE in keys else None
    if not stored.exists(spark, path):
        return stored.create_or_merge(m.table.build(silver), path, keys, part, hashed)
    touched = changed.select(*keys).distinct()
    if m.table.name == "promo_analysis":
        touched = touched.filter("promo_code IS NOT NULL")
    lines = silver if part is None else stored.read(spark, f"{path.rsplit('/', 1)[0]}/silver", stored.parts_of(touched, part))
    # aggregated first: sums, not lines, go to meet the keys
    rows = m.table.build(lines).alias("t").join(touched.alias("k"), _null_safe_on("t", "k", keys), "left_semi")
    return stored.create_or_merge(rows, path, keys, part, hashed, touched=touched)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return stored.read(spark, f"{root.rstrip('/')}/{name}")


def names() -> Sequence[str]:
    return [*(m.table.name for m in MERGED if m.table.name != "product_totals"), TOP]
