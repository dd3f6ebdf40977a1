"""Column types of all-text landing rows, found by one aggregate and merged over layouts and ingests.

Types form a lattice: an empty column is below everything, whole numbers are below decimals, and numbers and
timestamps meet only in text.  What is kept for a column is not its type but counts: how many values it has, and how
many of them read as a whole number, as a decimal and as a timestamp.  Counts of two layouts add up, so the types of
several layouts, or of a new batch and the table so far, are reconciled by a sum, in any order, without reading the
old rows again; a type is what all values read as.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: counts and widths kept for a column
SCHEMA = "column string, n_values long, n_int long, n_decimal long, n_timestamp long, int_digits int, scale int"
INTEGER, DECIMAL = r"^[+-]?[0-9]{1,38}$", r"^[+-]?[0-9]{1,38}(\.[0-9]{1,38})?$"
TIMESTAMP_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssX")


def _timestamp(value: Column, formats: Sequence[str]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats])


def profile(df: DataFrame, columns: Sequence[str] | None = None, formats: Sequence[str] = TIMESTAMP_FORMATS) -> DataFrame:
    """One row of counts (``SCHEMA``) for each text column of ``df`` (names with a leading ``_`` are lineage).

    One pass, partial counts in every task, one row in the end.  Blank and NULL cells are no values; an empty table
    has columns without values."""
    columns = [c for c in df.columns if not c.startswith("_")] if columns is None else list(columns)
    out = []
    for c in columns:
        v = F.trim(F.col(f"`{c}`").cast("string"))
        v = F.when(v != "", v)
        # leading zeros carry meaning (codes), so such a value is text
        code = v.rlike(r"^[+-]?0[0-9]")
        whole, dec = v.rlike(INTEGER) & ~code, v.rlike(DECIMAL) & ~code
        digits = F.when(dec, F.length(F.regexp_extract(v, r"([0-9]+)", 1)))
        scale = F.when(dec, F.length(F.regexp_extract(v, r"\.([0-9]+)$", 1)))
        out.append(F.struct(F.lit(c).alias("column"), F.count(v).alias("n_values"), F.count_if(whole).alias("n_int"),
                            F.count_if(dec).alias("n_decimal"), F.count(_timestamp(v, formats)).alias("n_timestamp"),
                            F.coalesce(F.max(digits), F.lit(0)).alias("int_digits"),
                            F.coalesce(F.max(scale), F.lit(0)).alias("scale")))
    if not out:
        return df.sparkSession.createDataFrame([], SCHEMA)
    return df.agg(F.array(*out).alias("p")).select(F.inline("p"))


def merge(*profiles: DataFrame) -> DataFrame:
    """The counts of several layouts or batches together; a column that one of them lacks counts as empty there."""
    rows = profiles[0]
    for p in profiles[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("column").agg(*[F.sum(c).alias(c) for c in ("n_values", "n_int", "n_decimal", "n_timestamp")],
                                      F.max("int_digits").alias("int_digits"), F.max("scale").alias("scale"))


def with_types(profiled: DataFrame) -> DataFrame:
    """``profiled`` with ``type``: ``void`` (no values), ``int``, ``bigint``, ``decimal(p,s)``, ``timestamp`` or ``string``.

    Numbers of more than 38 digits stay text."""
    n, digits = F.col("n_values"), F.col("int_digits") + F.col("scale")
    kind = (F.when(n == 0, "void")
            .when((F.col("n_int") == n) & (F.col("int_digits") <= 9), "int")
            .when((F.col("n_int") == n) & (F.col("int_digits") <= 18), "bigint")
            .when((F.col("n_decimal") == n) & (digits <= 38), F.format_string("decimal(%d,%d)", digits, F.col("scale")))
            .when(F.col("n_timestamp") == n, "timestamp").otherwise("string"))
    return profiled.withColumn("type", kind)


def typed(df: DataFrame, types: dict[str, str], formats: Sequence[str] = TIMESTAMP_FORMATS) -> DataFrame:
    """``df`` with its text columns read as ``types`` (``void`` and unnamed columns stay as they are)."""
    casts = {}
    for c, kind in types.items():
        if c in df.columns and kind not in ("void", "string"):
            v = F.trim(F.col(f"`{c}`"))
            casts[c] = _timestamp(v, formats) if kind == "timestamp" else v.try_cast(kind)
    return df.withColumns(casts) if casts else df
