"""Control table: which batches of a source each pipeline has processed.

A clock value as a mark loses rows without an arrival time and rows whose job started before
the mark moved but committed after it.  The mark is therefore the set of processed batch ids:
``pending`` has every committed batch that is not in it, ``advance`` is called after the
batch's own writes have succeeded, so a failed run is simply repeated.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans import tables

SCHEMA = "pipeline string, done string, updated_at timestamp"


def processed(spark: SparkSession, control_root: str, pipeline: str) -> set[str]:
    """Batches that ``pipeline`` has processed."""
    rows = tables.read_appended(spark, control_root)
    if rows is None:
        return set()
    return {r["done"] for r in rows.filter(F.col("pipeline") == pipeline).select("done").distinct().collect()}


def pending(spark: SparkSession, source_root: str, control_root: str, pipeline: str, upto: str | None = None) -> list[str]:
    """Committed batches of the append-only table ``source_root`` that are still to do (``upto`` this id)."""
    done = processed(spark, control_root, pipeline)
    return [b for b in tables.committed(spark, source_root) if b not in done and (upto is None or b <= upto)]


def advance(spark: SparkSession, control_root: str, pipeline: str, batches: Iterable[str]) -> None:
    """Record ``batches`` as processed by ``pipeline``."""
    for b in batches:
        row: DataFrame = spark.createDataFrame([(pipeline, b, None)], SCHEMA).withColumn("updated_at", F.current_timestamp())
        tables.append(row.coalesce(1), control_root, f"{pipeline}.{b}")
