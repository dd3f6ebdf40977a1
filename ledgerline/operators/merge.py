"""Keyed upsert (MERGE) as a DataFrame -> DataFrame join.

``upsert(target, source, keys)`` returns the table after
``MERGE INTO target USING source ON keys WHEN MATCHED THEN UPDATE SET <update_cols>
WHEN NOT MATCHED THEN INSERT *``.  Keys match NULL-safely (``<=>``): a NULL business
key is one key, so re-running a merge never re-inserts NULL-key rows.  The result is
published as a new snapshot by the caller, which makes the step idempotent:
``upsert(upsert(t, s), s) == upsert(t, s)``.

Plan: one full outer sort-merge join on the keys (both sides hash-partitioned once);
AQE may turn it into a broadcast join when it measures one side as small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """The source has more than one row for a key (MERGE would be ambiguous)."""


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Fail if any key occurs twice in ``source`` (one distributed aggregate job)."""
    dup = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"source has duplicate keys, e.g. {dup[0].asDict()}")


def _null_safe_on(t: str, s: str, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(f"{t}.{k}").eqNullSafe(F.col(f"{s}.{k}"))
        cond = c if cond is None else (cond & c)
    return cond


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, check_unique: bool = False) -> DataFrame:
    """Merged table with ``target``'s schema (plus any new source columns).

    ``update_cols=None`` updates every non-key column on a match; a list updates only
    those (the others keep the target's values).  Unmatched source rows are inserted.
    """
    keys = list(keys)
    if check_unique:
        assert_unique_keys(source, keys)
    tcols = target.columns
    extra = [c for c in source.columns if c not in tcols]
    out_cols = tcols + extra
    tgt_types = {f.name: f.dataType for f in target.schema.fields}
    if update_cols is None:
        update_cols = [c for c in source.columns if c not in keys]
    update = set(update_cols)

    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.withColumn("__s", F.lit(True)).alias("s")
    j = t.join(s, _null_safe_on("t", "s", keys), "full_outer")
    matched_s = F.col("s.__s").isNotNull()
    matched_t = F.col("t.__t").isNotNull()

    def pick(c: str) -> Column:
        sc = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        if c in tgt_types:
            sc = sc.cast(tgt_types[c])
        tc = F.col(f"t.{c}") if c in tcols else F.lit(None)
        if c in keys:
            return F.when(matched_t, tc).otherwise(sc).alias(c)
        if c in update or c not in tcols:
            # updated on match, inserted when new
            return F.when(matched_s, sc).otherwise(tc).alias(c)
        # not updated on match: keep target, but new rows still insert the source value
        return F.when(matched_t, tc).otherwise(sc).alias(c)

    return j.select(*[pick(c) for c in out_cols])


def replace_keys(target: DataFrame, recomputed: DataFrame, touched: DataFrame,
                 keys: Sequence[str]) -> DataFrame:
    """Replace every ``touched`` key of ``target`` with the rows of ``recomputed``.

    Keys that are touched but absent from ``recomputed`` disappear (their source rows
    are gone).  Used by the incremental Gold refresh; NULL-safe on keys.
    """
    keys = list(keys)
    kept = target.alias("t").join(touched.select(*keys).distinct().alias("k"),
                                  _null_safe_on("t", "k", keys), "left_anti")
    return kept.unionByName(recomputed.select(*target.columns))
