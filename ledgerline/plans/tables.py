"""Tables on plain Parquet folders.

* A *snapshot* table is ``<root>/v=<n>/`` per published version; readers take the newest
  folder with Spark's ``_SUCCESS`` marker, so a job that dies half-way stays invisible.
* An *append-only* table is ``<root>/data/_batch=<id>/`` per batch, committed by the same
  marker.  A committed batch is never written again: replaying one, whichever it is, changes
  nothing.  Batches may differ in columns; a read has all of them.
* ``compact_appended`` rewrites the committed batches into right-sized files (a snapshot under
  ``<root>/base`` with the list of batches it holds); readers take it and the batches since.

One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.joins import write_parts

BATCH_COL = "_batch"
COVERED_SCHEMA = f"{BATCH_COL} string"
UNION_CONF = "spark.sql.unionOutputPartitioning"


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern``, from one listing call to the file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(st.getPath().toString() for st in found or [])


# --- snapshot tables -----------------------------------------------------------


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions, oldest first."""
    return sorted(int(p.split("/")[-2].removeprefix("v=")) for p in _glob(spark, f"{root.rstrip('/')}/v=*/_SUCCESS"))


def latest_version(spark: SparkSession, root: str) -> int | None:
    found = versions(spark, root)
    return found[-1] if found else None


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:06d}"


def exists(spark: SparkSession, root: str) -> bool:
    return latest_version(spark, root) is not None


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    v = latest_version(spark, root) if version is None else version
    if v is None:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(version_path(root, v))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of the files below ``path``, read off their folder names."""
    out: list[str] = []
    pattern = path.rstrip("/")
    while True:
        level = [p.split("/")[-1] for p in _glob(spark, pattern + "/*=*")]
        if not level:
            return out
        out.append(level[0].split("=")[0])
        pattern += f"/{out[-1]}=*"


def publish(df: DataFrame | Sequence[DataFrame], root: str, partition_by: list[str] | None = None,
            sort_within: list[str] | None = None, files: int | None = None,
            note: str = "", rebalance: bool = True, deal_by: Sequence[str] | None = None) -> int:
    """Write ``df`` as the next version; returns its number.

    ``df`` may be the portions of a frame, each laid out already: they are written one after the other.
    ``files`` optionally sets the number of output files (round-robin repartition), or
    with ``partition_by`` the number of writer tasks.  ``deal_by``: columns that tell rows apart; rows are dealt to
    the files by their hash, without the sort of all rows that precedes Spark's round robin.
    With ``partition_by`` the rows are *rebalanced* on the partition columns: each
    value's rows go to few writers, and AQE splits a value that holds a large share
    of the data over several tasks (no single task writes a hot date) while merging
    small ones (``rebalance=False`` for a frame the caller already laid out).
    ``sort_within`` sorts inside each file so Parquet row-group statistics can skip data.
    ``note`` names the job in Spark's event log.
    """
    parts = [df] if isinstance(df, DataFrame) else list(df)
    spark = parts[0].sparkSession
    prev = latest_version(spark, root)
    version = 1 if prev is None else prev + 1

    def laid_out(out: DataFrame) -> DataFrame:
        if partition_by and rebalance:
            out = (out.hint("rebalance", files, *partition_by) if files
                   else out.hint("rebalance", *partition_by))
        elif files:
            out = out.repartition(files, *deal_by) if deal_by else out.repartition(files)
        return out.sortWithinPartitions(*(partition_by or []), *sort_within) if sort_within else out

    if note:
        spark.sparkContext.setJobDescription(f"publish {note}")
    write_parts([laid_out(p) for p in parts], version_path(root, version), partition_by or ())
    if note:
        spark.sparkContext.setJobDescription(None)
    return version


def gather(spark: SparkSession, root: str, files: int, version: int | None = None) -> int:
    """Publish a version (without partitions) once more, its files gathered to ``files``; returns the new number.

    Whole files go together, each output file by a task of its own, so no row is shuffled.  A version of fewer files
    is dealt anew."""
    rows = read(spark, root, version)
    held = sorted(rows.inputFiles())
    if len(held) < files:
        return publish(rows, root, files=files)
    out = None
    for k in range(files):
        part = spark.read.schema(rows.schema).parquet(*held[k * len(held) // files:(k + 1) * len(held) // files]).coalesce(1)
        out = part if out is None else out.unionByName(part)
    # parts of one partition each would be joined into a single one
    before = spark.conf.get(UNION_CONF, None)
    spark.conf.set(UNION_CONF, "false")
    try:
        return publish(out, root)
    finally:
        spark.conf.unset(UNION_CONF) if before is None else spark.conf.set(UNION_CONF, before)


# --- append-only tables ----------------------------------------------------------


def committed(spark: SparkSession, root: str) -> list[str]:
    """Ids of the committed batches."""
    return sorted(p.split("/")[-2].removeprefix(f"{BATCH_COL}=") for p in _glob(spark, f"{root.rstrip('/')}/data/{BATCH_COL}=*/_SUCCESS"))


def append(df: DataFrame, root: str, batch_id: str | int, partition_by: Sequence[str] = ()) -> int | None:
    """Append ``df`` as batch ``batch_id``; returns its rows, or None for a batch that is committed already."""
    spark, batch_id = df.sparkSession, str(batch_id)
    if batch_id in committed(spark, root):
        return None
    obs = Observation(f"append_{batch_id}")
    if partition_by:       # few files a folder; AQE splits a folder with many rows over several writers
        df = df.hint("rebalance", *partition_by)
    write_parts(df.drop(BATCH_COL).observe(obs, F.count(F.lit(1)).alias("rows")), f"{root.rstrip('/')}/data/{BATCH_COL}={batch_id}", partition_by)
    return int(obs.get.get("rows", 0))


def _covered(spark: SparkSession, root: str) -> tuple[int | None, set[str]]:
    version = latest_version(spark, f"{root.rstrip('/')}/base")
    if version is None:
        return None, set()
    rows = spark.read.schema(COVERED_SCHEMA).parquet(f"{root.rstrip('/')}/covered/v={version:06d}").collect()
    return version, {r[BATCH_COL] for r in rows}


def read_appended(spark: SparkSession, root: str, only: Iterable[str] | None = None,
                  without: Iterable[str] = ()) -> DataFrame | None:
    """Rows of the committed batches (of ``only`` these, ``without`` those) with the column ``_batch``.

    Columns are those of all batches together (a batch without one has NULLs in it).  None where no such
    batch has a row."""
    root = root.rstrip("/")
    without = {str(b) for b in without}
    wanted = [b for b in committed(spark, root) if b not in without and (only is None or b in {str(x) for x in only})]
    version, covered = _covered(spark, root)
    parts = []
    if version is not None and covered & set(wanted):
        base = spark.read.parquet(version_path(f"{root}/base", version)).withColumn(BATCH_COL, F.col(BATCH_COL).cast("string"))
        parts.append(base if covered <= set(wanted) else base.filter(F.col(BATCH_COL).isin(sorted(covered & set(wanted)))))
    # a partitioned batch without rows has no files
    held = {p.split(f"/{BATCH_COL}=")[1].split("/")[0] for p in
            _glob(spark, f"{root}/data/{BATCH_COL}=*/part-*") + _glob(spark, f"{root}/data/{BATCH_COL}=*/*=*")}
    paths = [f"{root}/data/{BATCH_COL}={b}" for b in wanted if b not in covered and b in held]
    if paths:
        parts.append(spark.read.option("basePath", f"{root}/data").option("mergeSchema", True).parquet(*paths)
                     .withColumn(BATCH_COL, F.col(BATCH_COL).cast("string")))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def compact_appended(spark: SparkSession, root: str, sort_within: Sequence[str] = (), files: int | None = None) -> int | None:
    """Rewrite all committed batches into the files of one snapshot, in the table's own partition layout.

    Readers see the old batches until the snapshot is complete and the snapshot from then on."""
    root = root.rstrip("/")
    batches = committed(spark, root)
    rows = read_appended(spark, root)
    if rows is None:
        return None
    layout = [c for c in partition_columns(spark, f"{root}/data") if c != BATCH_COL]
    version = (latest_version(spark, f"{root}/base") or 0) + 1
    spark.createDataFrame([(b,) for b in batches], COVERED_SCHEMA).coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/covered/v={version:06d}")
    return publish(rows, f"{root}/base", partition_by=layout or None, sort_within=list(sort_within) or None, files=files)
