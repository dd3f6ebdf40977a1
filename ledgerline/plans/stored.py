"""Stored tables that are merged in place, one partition folder at a time.

``create_or_merge`` is ``MERGE INTO`` for a plain partitioned Parquet folder: it finds the partitions
that the merge touches, reads only these, and replaces only these.  Other folders are neither read nor written.  The partition column ``_part`` is a function of
the key: its day, its month (where days would be many small files), or a hash of it.

A merge is first written beside the table (``<path>__merge``, committed by Spark's ``_SUCCESS``) and then
carried into it: its folders are moved to their places, so rows are written once.  A run that died in between is
finished by the next call, so that no partition is lost half-way.  One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import merge
from ledgerline.operators.joins import freed_shuffles, staged_while, write_parts
from ledgerline.plans.tables import _glob
from ledgerline.session import delete, stored_bytes

PART_COL = "_part"
#: stored bytes of partitions that are merged at once
GROUP_BYTES = 1 << 30
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_glob(spark, f"{path.rstrip('/')}/_SUCCESS"))


def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Columns and types of the table, kept beside it: a table may be without rows, or a partition column all NULL."""
    return spark.read.parquet(f"{path}__schema").schema


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}__schema")


def read(spark: SparkSession, path: str, parts: Sequence | None = None) -> DataFrame:
    """The table, or only its partitions ``parts``: a plain predicate on the partition column, so other folders are not read."""
    rows = spark.read.schema(_schema(spark, path)).parquet(path)
    if parts is not None:
        rows = rows.filter(_within(F.col(PART_COL), parts))
    return rows.drop(PART_COL)


def _within(part: Column, values: Sequence) -> Column:
    cond = part.isin([v for v in values if v is not None])
    return cond | part.isNull() if None in values else cond


def parts_of(keys: DataFrame, part: Column) -> list:
    """The partitions of these keys (at most as many as the table has)."""
    with freed_shuffles(keys.sparkSession):
        return [r[0] for r in keys.select(part.alias(PART_COL)).distinct().collect()]


def month(c: str) -> Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _folder(value) -> str:
    return f"{PART_COL}={_NULL_FOLDER if value is None else value}"


def _folders(spark: SparkSession, path: str) -> list[str]:
    return [p.rsplit("/", 1)[1] for p in _glob(spark, f"{path}/{PART_COL}=*")]


def _write(rows: Sequence[DataFrame], path: str, keys: Sequence[str]) -> None:
    write_parts([df.hint("rebalance", PART_COL).sortWithinPartitions(PART_COL, *keys) for df in rows], path, [PART_COL])


def _move(spark: SparkSession, source: str, target: str) -> None:
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = of(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(of(source), of(target)):
        raise OSError(f"{source} cannot be moved to {target}")


def _carry(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Bring a committed merge into the table: its partitions are replaced, those without rows left go."""
    waiting = f"{path}__merge"
    if not exists(spark, f"{waiting}/rows"):
        return
    touched = spark.read.parquet(f"{waiting}/folders").collect()     # one row a touched partition
    held = set(_folders(spark, f"{waiting}/rows"))
    if not exists(spark, f"{waiting}/held"):       # kept before the first folder moves: one that has moved is not one without rows
        spark.createDataFrame([(f,) for f in sorted(held)], "folder string").coalesce(1).write.mode("overwrite").parquet(f"{waiting}/held")
    filled = {r["folder"] for r in spark.read.parquet(f"{waiting}/held").collect()}
    for folder in (r["folder"] for r in touched):
        if folder in held or folder not in filled:
            delete(spark, f"{path}/{folder}")
        if folder in held:
            _move(spark, f"{waiting}/rows/{folder}", f"{path}/{folder}")
    delete(spark, waiting)


def _merged(target: DataFrame, source: DataFrame, every: DataFrame, schema: T.StructType, keys: Sequence[str],
            update_cols: Sequence[str] | None) -> DataFrame:
    whole = source.select(*[F.col(c) if c in source.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in target.columns])
    if update_cols is None:
        return merge.replace_keys(target, whole, every, keys)
    gone = every.alias("t").join(source.select(*keys).alias("s"), merge._null_safe_on("t", "s", keys), "left_anti")
    return merge.upsert(merge.replace_keys(target, whole.limit(0), gone, keys), whole, keys, update_cols)


def create_or_merge(source: DataFrame, path: str, keys: Sequence[str], part: Column | None = None, hashed: int = 64,
                    touched: DataFrame | None = None, update_cols: Sequence[str] | None = None, source_stored: bool = False) -> list[str]:
    """Create the table from ``source``, or merge it: update the keys that match, insert the others.

    ``part``: date or integer computed from the keys; without it rows are dealt to ``hashed`` folders by a hash of the
    keys.  It stays the same as long as the table lives.  ``touched``: keys the source speaks for; one that is touched
    but not in the source disappears.  Without it these are the keys of the source alone.  ``update_cols``: only these
    are updated on a match.  ``source_stored``: it comes straight from stored files and is read again instead of being kept.
    Keys match NULL-safely; the source has each key once.
    Returns the folders of the partitions that were touched (all, when created)."""
    spark, path, keys = source.sparkSession, path.rstrip("/"), list(keys)
    part = F.pmod(F.xxhash64(*keys), F.lit(hashed)).cast("int") if part is None else part
    source = source.withColumn(PART_COL, part)
    kind = source.schema[PART_COL].dataType
    if not isinstance(kind, (T.DateType, T.IntegerType, T.LongType)):
        raise ValueError(f"a partition is a date or an integer, not {kind.simpleString()}")
    _carry(spark, path, keys)
    if not exists(spark, path):
        _keep_schema(spark, path, source.schema)
        _write([source], path, keys)
        return sorted(_folders(spark, path))
    schema = _schema(spark, path)
    with ExitStack() as held:
        if not source_stored:
            untyped = {f.name: F.col(f.name).cast(schema[f.name].dataType) for f in source.schema.fields
                       if isinstance(f.dataType, T.NullType) and f.name in schema.names}
            source = held.enter_context(staged_while(source.withColumns(untyped) if untyped else source, "merge_rows"))
        every = source.select(*keys)
        if touched is not None:
            every = every.unionByName(touched.select(*keys))
        every = held.enter_context(staged_while(every.distinct(), "merge_keys"))
        values = parts_of(every, part)
        if not values:
            return []
        new = [f for f in source.schema.fields if f.name not in schema.names]
        if new:
            schema = T.StructType([*schema.fields, *new])
            _keep_schema(spark, path, schema)
        # the rows of a group of partitions are shuffled alone, so the files of the shuffles do not grow with the table
        n = min(len(values), max(1, -(-stored_bytes(spark, path) // GROUP_BYTES)))
        values.sort(key=lambda v: (v is None, v or 0))
        rows = []
        for k in range(n):
            group = values[k * len(values) // n:(k + 1) * len(values) // n]
            own, keyed = (df if n == 1 else df.filter(_within(part, group)) for df in (source, every))
            rows.append(_merged(read(spark, path, group), own, keyed, schema, keys, update_cols).withColumn(PART_COL, part))
        folders = sorted(_folder(v) for v in values)
        waiting = f"{path}__merge"
        spark.createDataFrame([(f,) for f in folders], "folder string").coalesce(1).write.mode("overwrite").parquet(f"{waiting}/folders")
        _write(rows, f"{waiting}/rows", keys)
        _carry(spark, path, keys)
        return folders
