"""Inspection helpers: bounded previews and observed row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows (``SELECT * ... LIMIT n``), in the order of ``order_by`` where given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` plus an Observation that counts its rows and duplicates as a side effect of
    whatever action runs next (e.g. the Silver write), instead of extra count jobs."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "_is_duplicate" in df.columns:
        metrics.append(F.count(F.when(F.col("_is_duplicate"), F.lit(1))).alias("duplicates"))
    return df.observe(obs, *metrics), obs
