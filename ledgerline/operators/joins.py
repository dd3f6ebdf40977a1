"""Intermediate results that are computed once, into the shared folder, and what they leave on disk."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import delete, scratch_path, stored_bytes

METHOD_CONF = "spark.sql.codegen.hugeMethodLimit"
#: bytecode of a method above which the JVM never compiles it
METHOD_BYTES = "8000"
FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: codec of everything that is written to be read again
CODEC = "zstd"

_LOCK, _HELD = threading.Lock(), {}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes (and frames made and collected) inside remove their shuffle files when they end; else these stay until the driver's garbage collector
    happens to find them unused, and the files of all steps of a job pile up.  A write's plan is its own, so nobody reads
    its shuffles again.  Blocks may nest, and overlap from several threads."""
    key = spark.sparkContext.applicationId
    with _LOCK:
        depth, before = _HELD.get(key, (0, None))
        if depth == 0:
            before = spark.conf.get(FREE_CONF, None)
            spark.conf.set(FREE_CONF, "true")
        _HELD[key] = depth + 1, before
    try:
        yield
    finally:
        with _LOCK:
            depth, before = _HELD.pop(key)
            if depth > 1:
                _HELD[key] = depth - 1, before
            elif before is None:
                spark.conf.unset(FREE_CONF)
            else:
                spark.conf.set(FREE_CONF, before)


def write_parts(parts: DataFrame | Sequence[DataFrame], path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a frame, or the portions of one, to a folder of Parquet files of its own.

    Portions go one after the other, each without the shuffle files of those before.  Spark's marker comes with the last."""
    parts = [parts] if isinstance(parts, DataFrame) else list(parts)
    with freed_shuffles(parts[0].sparkSession):
        for k, df in enumerate(parts):
            # static: the folder is this frame's alone, and gets its marker also when partitioned
            writer = df.write.mode("append" if k else "overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
            if k < len(parts) - 1:
                writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)


def portions_of(df: DataFrame, portion_bytes: int) -> int:
    """Portions of about so many bytes of the files that ``df`` reads."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    return max(1, -(-sum(stored_bytes(df.sparkSession, f) for f in folders) // portion_bytes))


def _stage(df: DataFrame | Sequence[DataFrame], path: str) -> DataFrame:
    first = df if isinstance(df, DataFrame) else df[0]
    spark = first.sparkSession
    before = spark.conf.get(METHOD_CONF, None)
    spark.conf.set(METHOD_CONF, METHOD_BYTES)
    try:
        write_parts(df, path)
    finally:
        spark.conf.unset(METHOD_CONF) if before is None else spark.conf.set(METHOD_CONF, before)
    return spark.read.schema(first.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back, so that several uses
    scan the stored columns they need instead of computing the whole frame again.

    Projections too long for one compiled method run as many short ones, not interpreted."""
    return _stage(df, scratch_path(df.sparkSession, "staged", name))


@contextmanager
def staged_while(df: DataFrame | Sequence[DataFrame], name: str) -> Iterator[DataFrame]:
    """``staged`` (a frame, or its portions) for the jobs of the block alone; the files are removed after it."""
    spark = (df if isinstance(df, DataFrame) else df[0]).sparkSession
    path = scratch_path(spark, "staged", name)
    try:
        yield _stage(df, path)
    finally:
        delete(spark, path)
