"""Catalog tables of order lines, bucketed and sorted by order.

A database is created where it is missing; the lines' files lie in the shared folder given.  Equal orders lie in one
bucket, so ranking copies needs no exchange of the stored lines, and a join with a batch shuffles the batch alone.

A line without an order id is no copy of any other.  So that such lines do not meet in one bucket, the bucket column
``_order_key`` is the order id or, without one, the line's own source file and row.  Copies of one hot order id do
share a bucket: where a single order may hold a large share of the lines, ``dedup.mark_duplicates`` over a plain table
(which splits such keys) is the better way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import dedup
from ledgerline.sources.files import ensure_schema

ORDER_KEY = "_order_key"


def order_key(df: DataFrame) -> DataFrame:
    """``df`` with ``_order_key``, which is never NULL."""
    own = F.concat_ws("\u0000", F.lit(""), F.col("_source_file"), F.col("_source_row").cast("string"))
    return df.withColumn(ORDER_KEY, F.coalesce("order_id", own))


def save_lines(df: DataFrame, database: str, name: str, path: str, buckets: int | None = None) -> str:
    """Write ``df`` as the bucketed table ``database.name`` with its files under ``path``; returns the full name.

    ``buckets`` defaults to the session's shuffle partitions; choose it so that a bucket is about a task's share."""
    spark = df.sparkSession
    ensure_schema(spark, database)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{database}.{name}"
    # one exchange now, by the bucket column: every bucket is one file
    (order_key(df).repartition(buckets, ORDER_KEY).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, ORDER_KEY).sortBy(ORDER_KEY).saveAsTable(table))
    return table


def best_lines(spark: SparkSession, table: str) -> DataFrame:
    """One line per order and line number, ranked inside the buckets."""
    return dedup.keep_best(spark.table(table), keys=[ORDER_KEY, "line_number"])


def lines_of_batch(spark: SparkSession, table: str, batch: DataFrame) -> DataFrame:
    """The stored lines of the orders that ``batch`` holds; only the batch's keys are shuffled."""
    keys = order_key(batch).filter(F.col("order_id").isNotNull()).select(ORDER_KEY).distinct()
    return spark.table(table).join(keys.hint("merge"), ORDER_KEY, "left_semi")


def drop_database(spark: SparkSession, database: str) -> None:
    """Take the database and its tables out of the catalog; the files, under their own paths, stay."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
