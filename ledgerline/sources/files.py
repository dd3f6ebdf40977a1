"""Landing-file readers for the three vendor formats, and the Bronze ingest.

Header drift: a vendor changes its layout mid-stream (columns renamed, added, moved), and old and
new files share one folder.  A CSV reader maps columns by *position*, so one schema for both shifts
values into the wrong columns.  Here a file's first line is its header:

1. the files are listed; those that the manifest of Bronze has, unchanged, leave the listing (no content is read);
2. the first line of each new file is found by one aggregate over the text (one row a file);
   only the distinct header lines and the new paths come to the driver;
3. every layout is read once, with its own all-text schema, over its own files, and the layouts are
   unioned by name.  Names are compared trimmed and without regard to case.

A file without the vendor's key column in its header is never dropped silently: the read fails and
names it.  Lines that repeat the header inside a file are skipped.

Every value stays text in Bronze (``infer=True`` lets Spark guess types instead); Silver parses.
Lineage columns: source file, ingestion time, vendor and a row id unique within the ingest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import VENDOR_A_V1, VENDOR_A_V2, VENDOR_B_COLUMNS, VENDOR_C_COLUMNS

# vendor -> key column, separator, CSV options and the column names of its layouts
VENDORS = {
    "vendor_a": ("order_id", ",", {"quote": '"'}, (*VENDOR_A_V1, *VENDOR_A_V2, "payment_status")),
    "vendor_b": ("order_id", "|", {"quote": '"'}, (*VENDOR_B_COLUMNS, "payment_status")),
    "vendor_c": ("order_number", "\t", {"quote": '"', "escape": '"'}, tuple(VENDOR_C_COLUMNS)),
}


class UnknownLayoutError(ValueError):
    """Landing files whose first line is not a header of the vendor."""


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of every file under ``path`` (a file, folder or glob), without reading any."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``_source_file``, ``_header``: the first line of each file."""
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("_source_file"),
        F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("_at"))
    return lines.groupBy("_source_file").agg(F.min_by("value", "_at").alias("_header"))


def _names(header: str, sep: str, quote: str | None, known: Sequence[str]) -> list[str]:
    by_lower = {k.lower(): k for k in known}
    names = [p.strip().strip("﻿") for p in header.rstrip("\r").split(sep)]
    if quote:
        names = [n[1:-1].strip() if len(n) >= 2 and n[0] == quote and n[-1] == quote else n for n in names]
    return [by_lower.get(n.lower(), n) for n in names]


def read_files(spark: SparkSession, paths: Sequence[str], vendor: str, infer: bool = False) -> DataFrame:
    """Bronze rows of these landing files of ``vendor``, whatever mix of layouts they have."""
    key, sep, csv, known = VENDORS[vendor]
    layouts: dict[tuple, list[str]] = {}
    unknown = []
    for r in headers(spark, paths).collect():              # one row a file
        names = tuple(_names(r["_header"] or "", sep, csv.get("quote"), known))
        if key in names and len(set(names)) == len(names):
            layouts.setdefault(names, []).append(r["_source_file"])
        else:
            unknown.append(r["_source_file"])
    if unknown:
        raise UnknownLayoutError(f"{len(unknown)} {vendor} file(s) without a header with '{key}', e.g. {sorted(unknown)[:5]}")
    if not layouts:
        raise FileNotFoundError(f"no {vendor} file with a header among {len(paths)} path(s)")
    out = None
    for names, files in sorted(layouts.items()):
        reader = spark.read.option("header", True).option("sep", sep).options(**csv)
        if infer:
            part = reader.option("inferSchema", True).csv(sorted(files)).toDF(*names)
        else:
            part = reader.schema(", ".join("`{}` STRING".format(n.replace("`", "``")) for n in names)).csv(sorted(files))
        part = part.withColumn("_source_file", F.col("_metadata.file_path"))
        again = F.lower(F.trim(F.col(f"`{key}`").cast("string"))) == key.lower()
        part = part.filter(~F.coalesce(again, F.lit(False)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return add_lineage(out, vendor)


def read_vendor(spark: SparkSession, path: str, vendor: str, infer: bool = False) -> DataFrame:
    """Bronze rows of every file under ``path``."""
    return read_files(spark, [r["path"] for r in list_files(spark, path).collect()], vendor, infer)


def parse_vendor_lines(batch: DataFrame, vendor: str) -> DataFrame:
    """Bronze rows of the files of a streaming micro-batch (as many as its trigger allows)."""
    found = [r["_source_file"] for r in batch.select("_source_file").distinct().collect()]
    return read_files(batch.sparkSession, found, vendor)


def add_lineage(df: DataFrame, vendor: str) -> DataFrame:
    """Ingestion time, vendor tag and a row id (unique within this ingest job).

    Written to Bronze once, so later reads see stable values.
    """
    cols = {"_ingestion_timestamp": F.current_timestamp(), "_source_vendor": F.lit(vendor),
            "_source_row": F.monotonically_increasing_id()}
    if "_source_file" not in df.columns:
        cols["_source_file"] = F.col("_metadata.file_path")
    return df.withColumns(cols)


def read_vendor_a(spark: SparkSession, path: str) -> DataFrame:
    return read_vendor(spark, path, "vendor_a")


def read_vendor_b(spark: SparkSession, path: str) -> DataFrame:
    return read_vendor(spark, path, "vendor_b")


def read_vendor_c(spark: SparkSession, path: str) -> DataFrame:
    return read_vendor(spark, path, "vendor_c")


class Ingested(int):
    """Rows appended by an ingest; ``files`` read for them, and how many of these (``changed``) had been loaded before
    under the same path with another size or modification time."""

    files: int
    changed: int

    def __new__(cls, rows: int, files: int = 0, changed: int = 0):
        out = super().__new__(cls, rows)
        out.files, out.changed = files, changed
        return out


MANIFEST = ("path", "length", "modificationTime")


def _to_load(listing: DataFrame, held: DataFrame | None) -> DataFrame:
    """The listed files that are not in the manifest with their size and time; ``changed`` where the path is."""
    if held is None:
        return listing.withColumn("changed", F.lit(False))
    todo = listing.join(held.select(*MANIFEST), list(MANIFEST), "left_anti")
    paths = held.select(F.col("path").alias("_held")).distinct()
    return todo.join(paths, F.col("path") == F.col("_held"), "left").withColumn("changed", F.col("_held").isNotNull()).drop("_held")


def ingest(spark: SparkSession, landing: str, vendor: str, bronze: str) -> Ingested:
    """Append the landing folder's new and changed files to the append-only Bronze table.

    What has been loaded is known from a manifest beside Bronze (path, size and modification time of each file,
    by batch); Bronze itself is never read.  A file delivered again under its old name is loaded again, once, and
    counted as ``changed``: its lines are further copies, which Silver ranks.  A batch enters the manifest before
    Bronze, so one that died in between is finished, with the same files, by the next ingest.  A new column of a
    later layout is NULL in the earlier batches."""
    from ledgerline.plans import tables
    bronze = bronze.rstrip("/")
    manifest, rows = f"{bronze}/manifest", 0
    held = tables.read_appended(spark, manifest)
    done = set(tables.committed(spark, bronze))
    listed = tables.committed(spark, manifest)
    for batch in listed:
        if batch not in done:
            paths = [r["path"] for r in held.filter(F.col(tables.BATCH_COL) == batch).select("path").collect()]
            rows += tables.append(read_files(spark, paths, vendor), bronze, batch) or 0
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing).select(*MANIFEST)
    todo = _to_load(listing, held)
    batch = f"{vendor}-{len(listed) + 1:06d}"
    found = todo.collect()                       # one row a file of this batch
    if not found:
        return Ingested(rows)
    tables.append(spark.createDataFrame(found, todo.schema).coalesce(1), manifest, batch)
    rows += tables.append(read_files(spark, [r["path"] for r in found], vendor), bronze, batch) or 0
    return Ingested(rows, len(found), sum(r["changed"] for r in found))


def write_vendor_files(df: DataFrame, path: str, columns: Sequence[str], sep: str = ",",
                       quote: str | None = '"', escape: str | None = None,
                       files: int | None = None) -> str:
    """Write landing files (header on every file) in a vendor's delimited format."""
    out = df.select(*columns)
    if files:
        out = out.repartition(files)
    writer = out.write.mode("overwrite").option("header", True).option("sep", sep)
    if quote is not None:
        writer = writer.option("quote", quote)
    if escape is not None:
        writer = writer.option("escape", escape)
    writer.csv(path)
    return path


def ensure_schema(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for catalog-managed layers (bronze/silver/gold)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.replace('`', '')}`")
