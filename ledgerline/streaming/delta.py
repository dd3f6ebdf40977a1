"""Gold kept up to date by the deltas of its batches.

Revenue, counts and discounts are sums, so a batch changes a Gold key by exactly
``aggregate(new winners of the touched orders) - aggregate(old winners of them)``.  A batch
appends its lines to Silver and, for every Gold table, its delta rows to that table's log;
the current table is the sum of the log.  Next to each sum the log keeps the number of values
summed (an all-NULL sum stays NULL) and the number of lines (a key whose lines are all gone
disappears).

* Silver is laid out in ``BUCKETS`` folders by the order id's hash.  A batch reads only the
  buckets of its own orders (at most ``BUCKETS`` numbers come to the driver), once, for the
  winners with and without it.
* Lines without a full order key are never duplicates: they only add, and are not read again.
* A batch is known by its source and number (``vendor_a-000001``).  Replaying a committed
  batch, the newest or an earlier one, changes nothing; a batch that died between its writes
  is finished by its replay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.operators import dedup, gold
from ledgerline.operators.joins import write_parts
from ledgerline.plans import stored, tables
from ledgerline.plans.gold_jobs import NEEDED
from ledgerline.schemas import MONEY, ORDER_KEYS
from ledgerline.session import scratch_path, stored_bytes

BUCKETS = 64
BUCKET_COL = "_bucket"
NO_BUCKET = -1     # lines without an order id

# measure -> (value expression, kind); "sum" keeps (sum, non-null count), "count" a count
REVENUE_MEASURES = {
    "total_amount_usd": (lambda: F.col("total_amount_usd"), "sum"),
    "total_discount_usd": (lambda: F.col("discount_amt_usd"), "sum"),
    "order_count": (lambda: F.col("order_id").isNotNull().cast("long"), "count"),
    "_lines": (lambda: F.lit(1).cast("long"), "count"),
}
PROMO_MEASURES = {
    **REVENUE_MEASURES,
    "total_loyalty_points_awarded": (lambda: F.col("loyalty_points").cast("long"), "sum"),
}
# of all lines received, for the duplicate report: the winners' share is subtracted
RECEIVED_MEASURES = {
    "received_amount_usd": (lambda: F.col("total_amount_usd"), "sum"),
    "received": (lambda: F.lit(1).cast("long"), "count"),
}


@dataclass(frozen=True)
class Log:
    """A Gold table's delta log: its keys and what it sums."""

    dims: tuple[str, ...]
    measures: dict


LOGS = {
    "vendor_day": Log(("source_vendor", "order_date"), REVENUE_MEASURES),
    "product_day": Log(("product_sku", "order_date"), REVENUE_MEASURES),
    "country_day": Log(("country_code", "order_date"), REVENUE_MEASURES),
    "customer": Log(("customer_email",), REVENUE_MEASURES),
    "promo": Log(("promo_code",), PROMO_MEASURES),
    "received": Log(("source_vendor",), RECEIVED_MEASURES),
}


def batch_name(source: str, number: int) -> str:
    return f"{source}-{number:06d}"


def _signed(measures: dict) -> list[Column]:
    """Measures of a row times its ``_sign``."""
    cols, sign = [], F.col("_sign")
    for name, (expr, kind) in measures.items():
        v = expr()
        if kind == "sum":
            cols += [F.when(sign < 0, v * F.lit(-1)).otherwise(v * F.lit(1)).alias(f"{name}__s"),
                     (v.isNotNull().cast("long") * sign).alias(f"{name}__n")]
        else:
            cols.append((v * sign).alias(f"{name}__c"))
    return cols


def _parts(lines: DataFrame, log: Log) -> DataFrame:
    return lines.select(*[gold._dim(d) for d in log.dims], *_signed(log.measures))


def _summed(rows: DataFrame, dims: Sequence[str]) -> DataFrame:
    return rows.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in dims])


def bucket(order_id: Column | str = "order_id") -> Column:
    c = F.col(order_id) if isinstance(order_id, str) else order_id
    return F.when(c.isNull(), F.lit(NO_BUCKET)).otherwise(F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int"))


def _has_key(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def append_batch(root: str, batch: DataFrame, batch_id: str, logs: dict[str, Log] | None = None,
                 keys: Sequence[str] = ORDER_KEYS) -> bool:
    """Append ``batch`` (canonical lines) to Silver at ``<root>/silver`` and its delta to every log
    ``<root>/log/<name>``.  Returns False where all of it had been committed before."""
    spark = batch.sparkSession
    logs = LOGS if logs is None else logs
    keys = list(keys)
    silver, paths = f"{root.rstrip('/')}/silver", {n: f"{root.rstrip('/')}/log/{n}" for n in logs}
    logged = {n: set(tables.committed(spark, paths[n])) for n in logs}
    open_logs = [n for n in logs if batch_id not in logged[n]]
    # deltas add up only in the order of their batches
    unfinished = {b for b in tables.committed(spark, silver) for n in logs if b not in logged[n]} - {batch_id}
    if open_logs and unfinished:
        raise RuntimeError(f"batches {sorted(unfinished)} are not finished: append them again first")
    fresh = tables.append(batch.withColumn(BUCKET_COL, bucket()), silver, batch_id, [BUCKET_COL]) is not None
    if not open_logs:
        return fresh
    mine = tables.read_appended(spark, silver, only=[batch_id])
    if mine is None:                                   # a batch without lines
        mine = batch.limit(0).withColumn(BUCKET_COL, F.lit(NO_BUCKET)).withColumn(tables.BATCH_COL, F.lit(batch_id))
    has_key = _has_key(keys)
    touched = mine.filter(has_key).select(*keys).distinct()
    numbers = [r[BUCKET_COL] for r in mine.filter(has_key).select(BUCKET_COL).distinct().collect()]
    # ranked once for all logs, with the columns they sum alone
    own = all(log.measures in (REVENUE_MEASURES, PROMO_MEASURES, RECEIVED_MEASURES) and {*log.dims} <= {*NEEDED, *gold.DIMENSIONS} for log in logs.values())
    columns = [c for c in mine.columns if c in keys or (c in NEEDED if own else c not in (BUCKET_COL, tables.BATCH_COL))]
    held = tables.read_appended(spark, silver, without=[batch_id]) if numbers else None
    # the buckets are gone through in groups, each shuffled alone, so the files of the shuffles do not grow with Silver
    n = min(len(numbers), max(1, -(-stored_bytes(spark, silver) // stored.GROUP_BYTES))) if "order_id" in keys else 1
    numbers.sort()
    parts = []
    for group in [numbers[k * len(numbers) // n:(k + 1) * len(numbers) // n] for k in range(n)] or [numbers]:
        own = has_key if n <= 1 else F.col(BUCKET_COL).isin(group) & has_key
        new = dedup.keep_best(mine.filter(own).select(*columns), keys, whole_keys=True)
        if held is None:
            changed = new.withColumn("_wins", F.lit(True))
        else:                                          # winners of the touched orders, from their buckets only
            old = held.filter(F.col(BUCKET_COL).isin(group) & has_key)
            old = old.select(*[F.col(c) if c in old.columns else F.lit(None).cast(mine.schema[c].dataType).alias(c) for c in columns])
            met = touched if n <= 1 else mine.filter(own).select(*keys).distinct()
            changed = dedup.changed_winners(new, dedup.keep_best(old, keys, whole_keys=True).join(met, keys, "left_semi"), keys)
        changed = changed.withColumn("_sign", F.when(F.col("_wins"), 1).otherwise(-1).cast("long")).select(*columns, "_sign")
        parts.append(changed if parts else changed.unionByName(mine.filter(~has_key).select(*columns, F.lit(1).cast("long").alias("_sign"))))
    path = scratch_path(spark, "changed")
    write_parts(parts, path)
    changed = spark.read.schema(StructType([*mine.select(*columns).schema, StructField("_sign", LongType())])).parquet(path)
    for name in open_logs:
        log = logs[name]
        rows = mine.withColumn("_sign", F.lit(1).cast("long")) if log.measures is RECEIVED_MEASURES else changed
        # AQE gathers the (small) sums into few files
        tables.append(_summed(_parts(rows, log), log.dims).hint("rebalance"), paths[name], batch_id)
    stored.delete(spark, path)
    return True


def state(spark: SparkSession, root: str, name: str, logs: dict[str, Log] | None = None) -> DataFrame:
    """Current sums of a Gold table: its log added up (keys without lines are gone)."""
    log = (LOGS if logs is None else logs)[name]
    rows = tables.read_appended(spark, f"{root.rstrip('/')}/log/{name}")
    if rows is None:
        raise FileNotFoundError(f"no batch has been appended under {root}")
    out = _summed(rows.drop(tables.BATCH_COL), log.dims)
    return out.filter(F.col("_lines__c") > 0) if "_lines" in log.measures else out


def fold(spark: SparkSession, root: str, name: str, logs: dict[str, Log] | None = None) -> int:
    """Add up a log's batches into one snapshot (run now and then, as a compaction)."""
    log = (LOGS if logs is None else logs)[name]
    path = f"{root.rstrip('/')}/log/{name}"
    batches = tables.committed(spark, path)
    rows = _summed(tables.read_appended(spark, path).drop(tables.BATCH_COL), log.dims)
    version = (tables.latest_version(spark, f"{path}/base") or 0) + 1
    spark.createDataFrame([(b,) for b in batches], tables.COVERED_SCHEMA).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/covered/v={version:06d}")
    return tables.publish(rows.withColumn(tables.BATCH_COL, F.lit("folded")), f"{path}/base")


# --- the Gold tables as a full rebuild would publish them ---------------------------


def _money(name: str) -> Column:
    return F.when(F.col(f"{name}__n") > 0, F.col(f"{name}__s")).cast(MONEY)


def present(st: DataFrame, dims: Sequence[str], duplicate_count: bool = True) -> DataFrame:
    """``revenue_by`` columns of a state."""
    out = st.select(*dims, _money("total_amount_usd").alias("total_amount_usd"),
                    F.col("order_count__c").cast("long").alias("order_count"),
                    _money("total_discount_usd").alias("total_discount_usd"))
    out = out.withColumn("avg_order_value_usd", gold._ratio("total_amount_usd", "order_count"))
    return out.withColumn("duplicate_count", F.lit(0)) if duplicate_count else out


def top_products(st: DataFrame, n: int = 10) -> DataFrame:
    """Top-``n`` products by revenue from a (product, day) state."""
    return (_summed(st.drop("order_date"), ["product_sku"])
            .select("product_sku", _money("total_amount_usd").alias("total_amount_usd"),
                    _money("total_discount_usd").alias("total_discount_usd"))
            .orderBy(F.col("total_amount_usd").desc_nulls_last(), F.col("product_sku").asc_nulls_last())
            .limit(n))


def present_promo(st: DataFrame) -> DataFrame:
    """Promo analysis (per non-NULL promo code)."""
    return (st.filter(F.col("promo_code").isNotNull())
            .select("promo_code",
                    F.col("order_count__c").cast("long").alias("usage_count"),
                    _money("total_discount_usd").alias("total_discount_given_usd"),
                    _money("total_amount_usd").alias("total_revenue_with_promo_usd"),
                    F.round(F.try_divide(F.col("total_amount_usd__s"),
                                         F.col("total_amount_usd__n").cast("decimal(20,0)")), 2)
                    .cast(MONEY).alias("avg_order_value_usd"),
                    F.when(F.col("total_loyalty_points_awarded__n") > 0, F.col("total_loyalty_points_awarded__s"))
                    .cast("long").alias("total_loyalty_points_awarded"))
            .orderBy(F.col("usage_count").desc(), F.col("promo_code")))


def present_duplicates(received: DataFrame, vendor_day: DataFrame) -> DataFrame:
    """Duplicate report: what was received less what won, per vendor."""
    won = _summed(vendor_day.drop("order_date"), ["source_vendor"])
    j = received.join(won.withColumnRenamed("source_vendor", "_v"), F.col("source_vendor").eqNullSafe(F.col("_v")), "left")

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0))
    return j.select("source_vendor", F.col("received__c").alias("total_rows"),
                    (F.col("received__c") - zero("_lines__c")).alias("duplicate_count"),
                    (zero("received_amount_usd__s") - zero("total_amount_usd__s")).cast(MONEY).alias("revenue_impact_usd"))


def gold_tables(spark: SparkSession, root: str, n: int = 10) -> dict[str, DataFrame]:
    """All seven Gold tables from the logs under ``root``."""
    vendor = state(spark, root, "vendor_day")
    product = state(spark, root, "product_day")
    return {
        "daily_revenue_by_vendor": present(vendor, LOGS["vendor_day"].dims),
        "daily_product_revenue": present(product, LOGS["product_day"].dims),
        "daily_revenue_by_country": present(state(spark, root, "country_day"), LOGS["country_day"].dims, duplicate_count=False),
        "customer_purchase_frequency": present(state(spark, root, "customer"), LOGS["customer"].dims, duplicate_count=False),
        "product_by_revenue": top_products(product, n),
        "promo_analysis": present_promo(state(spark, root, "promo")),
        "duplicate_analysis_report": present_duplicates(state(spark, root, "received"), vendor),
    }
